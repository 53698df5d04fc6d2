"""Evidence verification, document selection and bounded review payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.functions import paths
from gleanwork.functions.labels import excerpt
from gleanwork.operators.ordering import running
from gleanwork.operators.skew import attach, heavy_keys
from gleanwork.session import materialize

REPOSITORY_KEY = ["repository", "revision"]
EVIDENCE_ITEM = "array<struct<path:string,quote:string>>"


def evidence_items(results: DataFrame, column: str = "evidence_json") -> DataFrame:
    """Explode the nested evidence list of each repository; ``item_index`` starts at one."""
    return results.select(
        *REPOSITORY_KEY, F.posexplode(F.from_json(column, EVIDENCE_ITEM)).alias("__pos", "__item")
    ).select(
        *REPOSITORY_KEY,
        (F.col("__pos") + 1).alias("item_index"),
        F.coalesce("__item.path", F.lit("")).alias("path"),
        F.coalesce("__item.quote", F.lit("")).alias("quote"),
    )


def quotes_found(asked: DataFrame, store: DataFrame) -> DataFrame:
    """``sha, quote_id, quote_found`` for every distinct (``sha``, ``quote``) asked.

    ``store`` is a content store: only quotes move, to the bucket of their body. A quote asked of
    one body by many repositories is looked for once. Bodies that aren't stored have no rows.
    """
    once = asked.groupBy("sha", "quote_id").agg(F.first("quote").alias("quote"))
    checked = store.select("sha", "content").join(once, "sha")
    return checked.select("sha", "quote_id", F.col("content").contains(F.col("quote")).alias("quote_found"))


def verify_evidence(items: DataFrame, files: DataFrame, store: DataFrame) -> DataFrame:
    """Check each (path, quote) against the file body; ``reason`` is null for a verified item.

    ``files``: ``repository, revision, path, sha``; ``store``: see
    :mod:`gleanwork.sources.content_store`. A file whose body isn't stored is no file. The first
    item that checks out wins its path; later items on the same path are duplicates.
    """
    located = items.withColumn("normalized_path", paths.normalized_path("path")).withColumn("quote_id", F.sha2("quote", 256))
    listed = files.select(*REPOSITORY_KEY, F.col("path").alias("normalized_path"), "sha").where("sha IS NOT NULL")
    named = materialize(attach(located, listed, [*REPOSITORY_KEY, "normalized_path"], salts=64))
    known = store.select("sha", F.lit(True).alias("is_file"))
    found = quotes_found(named.where((F.col("quote") != "") & F.col("sha").isNotNull()), store)
    looked_up = attach(attach(named, known, ["sha"]), materialize(found), ["sha", "quote_id"])
    checked = looked_up.withColumns(
        {"is_file": F.coalesce("is_file", F.lit(False)), "quote_found": F.coalesce("quote_found", F.lit(False))}
    ).drop("sha", "quote_id")
    sound = (F.col("path") != "") & (F.col("quote") != "") & F.col("is_file") & F.col("quote_found")
    # Written once: the lookups are not repeated for the first-per-path lookup.
    checked = materialize(checked.withColumn("sound", sound))
    firsts = (
        checked.where("sound")
        .groupBy(*REPOSITORY_KEY, "normalized_path")
        .agg(F.min("item_index").alias("first_index"))
    )
    joined = attach(checked, firsts, [*REPOSITORY_KEY, "normalized_path"])
    reason = (
        F.when(F.col("path") == "", "path is empty")
        .when(F.col("quote") == "", "quote is empty")
        .when(F.col("normalized_path").isNull(), "path resolves outside repository")
        .when(F.col("item_index") > F.col("first_index"), "path duplicates another verified evidence item")
        .when(~F.col("is_file"), "path is not a file")
        .when(~F.col("quote_found"), "quote is not an exact substring of the file")
    )
    return joined.select(*REPOSITORY_KEY, "item_index", "path", "quote", "normalized_path", reason.alias("reason"))


def evidence_verdict(responses: DataFrame, verified: DataFrame) -> DataFrame:
    """Repository status after verification: a claim stands only when every item checks out."""
    counts = verified.groupBy(*REPOSITORY_KEY).agg(
        F.count_if(F.col("reason").isNull()).alias("verified_items"),
        F.count_if(F.col("reason").isNotNull()).alias("unverified_items"),
    )
    good, bad = F.coalesce("verified_items", F.lit(0)), F.coalesce("unverified_items", F.lit(0))
    not_found = F.col("status") == "not_found"
    return responses.join(counts, REPOSITORY_KEY, "left").select(
        *REPOSITORY_KEY,
        F.when(not_found & (good + bad == 0), "not_found")
        .when(not_found | (good == 0) | (bad > 0), "review")
        .otherwise(F.col("status"))
        .alias("status"),
        F.when(not_found & (good + bad > 0), "Model returned evidence for a not_found classification")
        .when(not_found, "Model reported no project guideline")
        .when(good == 0, "Model pass evidence could not be verified against the repository snapshot")
        .when(
            bad > 0,
            F.format_string(
                "Model returned %d evidence items: %d verified and %d unverified", good + bad, good, bad
            ),
        )
        .otherwise("Verified project guideline evidence")
        .alias("reason"),
        good.alias("verified_items"),
        bad.alias("unverified_items"),
    )


def top_documents(entries: DataFrame, limit: int = 12) -> DataFrame:
    """The ``limit`` most relevant candidate documents of every repository.

    ``row_number() <= limit`` lets Spark cut every map task to ``limit`` rows per repository
    before the shuffle.
    """
    ranked = entries.where(paths.is_candidate_document("path", "size")).withColumn("score", paths.relevance("path"))
    order = Window.partitionBy(*REPOSITORY_KEY).orderBy(F.desc("score"), F.lower("path"), "path")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def payload_limits(documents: DataFrame, store: DataFrame, max_document: int = 30_000, max_repository: int = 120_000) -> DataFrame:
    """Documents within their repository's budget, with the characters each may take in ``limit``.

    Used so far is a running sum of capped lengths, so the remainder needs no loop. Lengths come
    from the store; no body is read.
    """
    lengths = store.select("sha", "n_chars")
    sized = attach(documents, lengths, ["sha"], how="inner")
    # A document that does not fit takes exactly what is left, and an empty one ends the list.
    capped = F.least(F.col("n_chars"), F.lit(max_document)).cast("bigint")
    keyed = materialize(sized.withColumns({"__capped": capped, "__empty": (F.col("n_chars") == 0).cast("bigint")}))
    summed = running(
        keyed.select(*REPOSITORY_KEY, "rank", "__capped", "__empty"),
        REPOSITORY_KEY, ["rank"], {"__used": F.col("__capped"), "__stops": F.col("__empty")},
    ).select(*REPOSITORY_KEY, "rank", "__used", "__stops")
    remaining = F.lit(max_repository) - (F.col("__used") - F.col("__capped"))
    return (
        keyed.join(summed, [*REPOSITORY_KEY, "rank"])
        .where((F.col("__stops") == 0) & (remaining > 0))
        .withColumn("limit", F.least(F.lit(max_document).cast("bigint"), remaining).cast("int"))
        .drop("n_chars", "__capped", "__empty", "__used", "__stops")
    )


def budgeted_payload(
    documents: DataFrame, store: DataFrame, max_document: int = 30_000, max_repository: int = 120_000, min_rows: int | None = None
) -> DataFrame:
    """Cut each repository's documents, in ``rank`` order, to the character budgets; adds ``content``.

    ``documents``: ``repository, revision, rank, sha`` and more; ``store``: see
    :mod:`gleanwork.sources.content_store`. Limits move to the bodies, which are cut where they
    lie. A body that very many documents share is cut once per limit, and the cuts are dealt to
    the documents by salted keys.
    """
    limits = materialize(payload_limits(documents, store, max_document, max_repository))
    bodies = store.select("sha", "content")
    heavy = materialize(heavy_keys(limits, ["sha"], min_rows)).select(F.col("__key").alias("sha"))
    shared = limits.join(F.broadcast(heavy), "sha", "left_semi")
    rest = limits.join(F.broadcast(heavy), "sha", "left_anti")
    own = bodies.join(rest, "sha").withColumn("content", excerpt("content", F.col("limit")))
    pairs = shared.select("sha", "limit").distinct()
    cuts = bodies.join(pairs, "sha").select("sha", "limit", excerpt("content", F.col("limit")).alias("cut"))
    dealt = attach(shared, cuts, ["sha", "limit"], how="inner", min_rows=min_rows).withColumnRenamed("cut", "content")
    columns = [*documents.columns, "content"]
    return own.select(*columns).unionByName(dealt.select(*columns))


def payload_documents(documents: DataFrame) -> DataFrame:
    """One label-free JSON document per budgeted file, for blind review."""
    return documents.select(
        *REPOSITORY_KEY, "rank", F.to_json(F.struct("path", "content")).alias("document")
    )
