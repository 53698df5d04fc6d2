"""Final tables, digests, provenance and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.bindings.attempts import log_folder
from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import SCHEDULED_SQL, UNITS_SQL, Tables
from gleanwork.functions import paths
from gleanwork.operators import dedup, gates, publish, quota
from gleanwork.session import materialize
from gleanwork.sources import digest_record, readers, sinks

# The bundle: repositories are customers; accepted files are their orders, one per order.
BUNDLE_SQL = """selected AS (SELECT c_custkey, 'Cust/' || replace(c_name, '#', '-') AS repository, substr(sha256(c_name), 1, 40) AS revision, c_mktsegment AS sampling_language,
    CAST(c_nationkey AS VARCHAR) AS license_name, CASE WHEN c_nationkey < 8 THEN 'baseline' WHEN c_nationkey < 16 THEN 'new_pending' ELSE 'new_confirmed' END AS origin
    FROM customer),
  files AS (SELECT o_orderkey, 'Cust/' || replace(c_name, '#', '-') AS repository, 'f' || o_orderkey AS file, o_orderstatus, CASE WHEN c_nationkey < 8 THEN 'baseline' ELSE 'new' END AS origin,
    CASE WHEN o_orderkey % 101 = 0 THEN 'bad' ELSE substr(sha256(c_name), 1, 40) END AS pinned, o_orderpriority AS review_origin, c_custkey
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus <> 'P')"""


def owner_name():
    return F.concat(F.lit("Cust/"), F.replace("c_name", F.lit("#"), F.lit("-")))


def selected(t: Tables):
    nation = F.col("c_nationkey")
    return t.customer.select(
        owner_name().alias("repository"),
        F.substring(F.sha2("c_name", 256), 1, 40).alias("revision"),
        F.col("c_mktsegment").alias("sampling_language"),
        F.col("c_nationkey").cast("string").alias("license_name"),
        F.when(nation < 8, "baseline").when(nation < 16, "new_pending").otherwise("new_confirmed").alias("origin"),
        F.col("c_custkey").alias("sample_order"),
    )


def review_rows(t: Tables):
    joined = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    repository = owner_name()
    pinned = F.when(F.col("o_orderkey") % 101 == 0, "bad").otherwise(F.substring(F.sha2("c_name", 256), 1, 40))
    return joined.select(
        F.lower(repository).alias("repository"),
        F.concat(F.lit("f"), "o_orderkey").alias("file"),
        F.concat(F.lit("https://github.com/"), repository, F.lit("/blob/"), pinned, F.lit("/f"), "o_orderkey").alias("github_url"),
        F.when(F.col("o_orderstatus") == "P", "not_found").otherwise("pass").alias("human_decision"),
        F.col("o_orderpriority").alias("review_origin"),
        F.lit("").alias("duplicate_of"),
        "c_nationkey",
    )


def accepted(t: Tables):
    rows = review_rows(t)
    return publish.accepted_files(
        {"baseline": rows.where("c_nationkey < 8"), "new": rows.where("c_nationkey >= 8")},
        t.customer.where("c_nationkey = 4").select(F.upper(owner_name()).alias("repository")),
    )


ACCEPTED_SQL = f"""{BUNDLE_SQL}, accepted AS (SELECT f.* FROM files f JOIN customer c ON c.c_custkey = f.c_custkey WHERE c_nationkey <> 4)"""


@query(
    "j14_published_files",
    f"""WITH {ACCEPTED_SQL} SELECT a.repository, a.file, a.origin, s.sampling_language, s.c_custkey AS sample_order FROM accepted a
       JOIN selected s ON s.repository = a.repository WHERE a.pinned = s.revision""",
)
def j14(t: Tables):
    return publish.guideline_rows(accepted(t), selected(t)).select(
        "repository", "file", "origin", "sampling_language", "sample_order"
    )


@query(
    "j14_revision_mismatch",
    f"""WITH {ACCEPTED_SQL} SELECT 'revision_mismatch' AS rule, lower(repository) AS key, 'https://github.com/' || repository || '/blob/bad/' || file AS detail
       FROM accepted WHERE pinned = 'bad'""",
)
def j14_gate(t: Tables):
    return gates.review_revisions(accepted(t), selected(t))


@query(
    "a15_published_repositories",
    f"""WITH {ACCEPTED_SQL}, n AS (SELECT repository, count(*) AS n FROM accepted WHERE pinned <> 'bad' GROUP BY 1)
       SELECT s.repository, CASE s.origin WHEN 'baseline' THEN 'baseline' ELSE 'new' END AS origin, coalesce(n, 0) AS guideline_file_count
       FROM selected s LEFT JOIN n USING (repository)""",
)
def a15_repositories(t: Tables):
    files = publish.guideline_rows(accepted(t), selected(t))
    return publish.repository_rows(selected(t), files).select("repository", "origin", "guideline_file_count")


@query(
    "a15_final_totals",
    f"""WITH {ACCEPTED_SQL}, ok AS (SELECT * FROM accepted WHERE pinned <> 'bad')
       SELECT 'repositories_by_origin' AS section, CASE origin WHEN 'baseline' THEN 'baseline' ELSE 'new' END AS name, count(*) AS value FROM selected GROUP BY 2
       UNION ALL SELECT 'repositories_by_language', sampling_language, count(*) FROM selected GROUP BY 2
       UNION ALL SELECT 'files_by_origin', origin, count(*) FROM ok GROUP BY 2
       UNION ALL SELECT 'files_by_review_origin', review_origin, count(*) FROM ok GROUP BY 2""",
)
def a15_totals(t: Tables):
    return publish.final_totals(selected(t), publish.guideline_rows(accepted(t), selected(t)))


@query(
    "v7_final_bundle",
    f"""WITH {ACCEPTED_SQL}, got AS (SELECT DISTINCT lower(repository) AS name, origin FROM accepted),
       want AS (SELECT lower(repository) AS name, CASE origin WHEN 'baseline' THEN 'baseline' ELSE 'new' END AS origin, license_name FROM selected)
       SELECT 'repository_count' AS rule, 'total' AS key, CAST(count(*) AS VARCHAR) AS detail FROM selected
       UNION ALL SELECT 'quota_mismatch', sampling_language, CAST(count(*) AS VARCHAR) FROM selected WHERE sampling_language = 'BUILDING' GROUP BY 2
       UNION ALL SELECT 'license_not_allowed', name, license_name FROM want WHERE license_name IN ('5', '6')
       UNION ALL SELECT 'accepted_set', coalesce(w.name, g.name) || '@' || coalesce(w.origin, g.origin), CASE WHEN g.name IS NULL THEN 'left_only' ELSE 'right_only' END
         FROM want w FULL JOIN got g ON g.name = w.name AND g.origin = w.origin WHERE w.name IS NULL OR g.name IS NULL
       UNION ALL SELECT 'baseline_set', name, 'left_only' FROM want WHERE origin = 'baseline' AND license_name = '7'
       UNION ALL SELECT 'revision_mismatch', lower(repository), 'https://github.com/' || repository || '/blob/bad/' || file FROM accepted WHERE pinned = 'bad'""",
)
def v7(t: Tables):
    rows = selected(t)
    wrong = F.when(F.col("sampling_language") == "BUILDING", F.col("target") + 1).otherwise(F.col("target"))
    goals = rows.groupBy("sampling_language").agg(F.count("*").alias("target"))
    goals = goals.select(F.col("sampling_language").alias("language"), wrong.alias("target"))
    allow = rows.where("license_name not in ('5', '6')").select("license_name")
    baseline = rows.where("origin = 'baseline' and license_name <> '7'")
    # The gates read a published table many times; so does this.
    files = materialize(accepted(t))
    return gates.final_bundle(rows, files, files, goals, allow, baseline)


# ---------------------------------------------------------------- digests and sinks


DIGESTED = ("documents", "labels", "orders", "lineitem", "nation")


def dealt_anew(df: DataFrame, times: int, *keys: str) -> DataFrame:
    """``df`` in ``times`` partitions for each one its scan has, so that none grows with the table."""
    return df.repartition(times * df.rdd.getNumPartitions(), *keys)


@query(
    "f24_table_digests",
    " UNION ALL ".join(f"SELECT '{name}' AS role, count(*) AS rows, true AS same_digest FROM {name}" for name in DIGESTED),
)
def f24(t: Tables):
    """Digests of the tables against those of copies written in another partitioning and read again."""
    tables = {name: t.read(name) for name in DIGESTED}
    copies = publish.provenance({name: materialize(dealt_anew(df, 5)) for name, df in tables.items()})
    again = copies.select("role", F.col("digest").alias("copied"))
    return publish.provenance(tables).join(again, "role").select(
        "role", "rows", (F.col("digest") == F.col("copied")).alias("same_digest")
    )


@query(
    "f24_digest_is_order_free",
    """SELECT 'lineitem' AS role, count(*) AS rows, true AS same_digest, false AS same_after_edit FROM lineitem""",
)
def f24_order(t: Tables):
    base = publish.table_digest(t.lineitem, "lineitem")
    moved = dealt_anew(t.lineitem, 7, "l_partkey")
    shuffled = publish.table_digest(moved.select(*reversed(t.lineitem.columns)), "lineitem")
    edited = publish.table_digest(
        t.lineitem.withColumn("l_tax", F.when(F.col("l_orderkey") == 1, F.col("l_tax") + 1).otherwise(F.col("l_tax"))), "lineitem"
    )
    return base.join(shuffled.select("role", F.col("digest").alias("d2")), "role").join(
        edited.select("role", F.col("digest").alias("d3")), "role"
    ).select("role", "rows", (F.col("digest") == F.col("d2")).alias("same_digest"), (F.col("digest") == F.col("d3")).alias("same_after_edit"))


@query(
    "f24_recorded_digests",
    """SELECT 'lineitem' AS role, count(*) AS rows, true AS same_digest, true AS only_new_read, false AS changed FROM lineitem UNION ALL
       SELECT 'orders', CAST(count(*) + count_if(o_orderstatus = 'P') AS BIGINT), true, true, true FROM orders""",
)
def f24_recorded(t: Tables):
    """Two tables recorded file by file, then again after rows were added to one: only the added files are read."""
    root = log_folder(t, "recorded")
    roles = {name: f"{root}/{name}" for name in ("lineitem", "orders")}
    for name, path in roles.items():
        dealt_anew(t.read(name), 6).write.parquet(path)
    before = materialize(digest_record.recorded_digests(t.spark, roles, f"{root}/record"))
    t.orders.where("o_orderstatus = 'P'").write.mode("append").parquet(roles["orders"])
    after = digest_record.recorded_digests(t.spark, roles, f"{root}/record")
    whole = publish.provenance({name: t.spark.read.parquet(path) for name, path in roles.items()})
    changed = gates.changed_inputs(before, after).select(F.col("key").alias("role"), F.lit(True).alias("changed"))
    old = before.select("role", F.col("files").alias("old_files"))
    return after.join(whole.select("role", F.col("digest").alias("full")), "role").join(old, "role").join(changed, "role", "left").select(
        "role", "rows", (F.col("digest") == F.col("full")).alias("same_digest"),
        (F.col("files_read") == F.col("files") - F.col("old_files")).alias("only_new_read"),
        F.coalesce("changed", F.lit(False)).alias("changed"),
    )


@query("v8_changed_inputs", "SELECT 'input_changed' AS rule, role AS key FROM (VALUES ('orders'), ('region')) v(role)")
def v8(t: Tables):
    recorded = publish.provenance({name: t.read(name) for name in ("orders", "nation", "labels")})
    current = publish.provenance(
        {"orders": t.orders.where("o_orderkey > 0"), "nation": t.nation.orderBy("n_name"), "labels": t.labels, "region": t.region}
    )
    return gates.changed_inputs(recorded, current).select("rule", "key")


@query(
    "k1_ordered_report",
    f"WITH {UNITS_SQL} SELECT name, license, input_index FROM units ORDER BY lower(name)",
)
def k1(t: Tables):
    folder = log_folder(t, "report")
    sinks.write_report(t.units, folder, ["name", "license", "input_index"], [F.lower("name")])
    return t.spark.read.schema("name string, license string, input_index bigint").parquet(folder).orderBy(F.lower("name"))


@query(
    "k3_attempt_records",
    "SELECT 'candidate-' || user_id AS custom_id, event_id AS seq FROM events",
)
def k3(t: Tables):
    folder = log_folder(t, "records")
    sinks.write_attempt_records(t.attempts, folder, ["custom_id", "seq"])
    return t.spark.read.schema("custom_id string, seq bigint").json(folder)


@query(
    "k4_json_summary",
    """SELECT count(*) AS input_files, count(DISTINCT sha256(text)) AS unique_contents FROM documents""",
)
def k4(t: Tables):
    folder = log_folder(t, "summary")
    rows = t.documents.select(
        F.col("source").alias("name"), F.lit("").alias("lastCommitSHA"), F.col("doc_id").cast("string").alias("markdown_path"),
        paths.content_sha256("text").alias("content_sha256"),
    )
    sinks.write_summary(dedup.dedup_summary(rows), folder)
    return t.spark.read.schema("input_files bigint, unique_contents bigint").json(folder)


@query(
    "k6_published_bundle",
    "SELECT 'orders' AS role, count(*) AS rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'nation', count(*) FROM nation",
)
def k6(t: Tables):
    record = sinks.publish({"orders": t.orders, "customer": t.customer}, {"nation": t.nation}, log_folder(t, "bundle"))
    return record.select("role", "rows")


@query(
    "s5_file_tree",
    "SELECT strlen(text) + 1 AS size, sha256(text || chr(10)) AS digest FROM benchmark",
)
def s5(t: Tables):
    """Passages written as one text file each, then scanned back as binary files."""
    folder = log_folder(t, "tree")
    t.benchmark.select(F.col("text").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    tree = readers.scan_file_tree(t.spark, folder, ".txt")
    return tree.select("size", paths.content_sha256("content").alias("digest"))


@query(
    "p14_needs_review_files",
    f"""WITH {SCHEDULED_SQL} SELECT sample_order, repository FROM scheduled WHERE status = 'unresolved'""",
)
def p14_unresolved(t: Tables):
    return quota.needs_review(t.scheduled).select("sample_order", "repository")
