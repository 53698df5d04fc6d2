"""The operators of this subpackage bound to the driver tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import (
    contamination,
    credentials,
    language_model,
    mixing,
    near_duplicates,
    neighbours,
    quality,
    quality_rules,
    quotations,
    sql,
    url_filters,
    variants,
    whitening,
    wrappers,
)

# Event types serve as list names; this one allows.
ALLOWING = ("signup",)


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def in_remainder(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


def captures(pages: DataFrame) -> DataFrame:
    """Every page as a capture; the minute of its fetch comes from its id."""
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    minutes = F.make_dt_interval(mins=(F.col("page_id") % 43_200).cast("int"))
    return pages.select(F.col("page_id").alias("capture_id"), "url", (start + minutes).alias("fetched_at"))


def dated_entries(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Every event as an entry of the list named by its type, about the page its user number names."""
    host, path = url_filters.host_of("url"), url_filters.path_of("url")
    rule = (
        F.when(F.col("event_id") % 3 == 0, F.when(path != "", F.concat(host, F.lit("/"), path)).otherwise(host))
        .when(F.col("event_id") % 3 == 1, host)
        .otherwise(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
    )
    return events.join(pages.select("page_id", "url"), F.col("user_id") == F.col("page_id")).select(
        F.col("event_type").alias("list"),
        rule.alias("rule"),
        F.when(F.col("event_id") % 4 == 0, "remove").otherwise("add").alias("action"),
        F.col("ts").cast("timestamp").alias("dated"),
    )


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _read(spark, folder, "pages")
    found = url_filters.filter_captures(captures(pages), dated_entries(_read(spark, folder, "events"), pages), ALLOWING)
    return found.select(F.col("capture_id").alias("page_id"), "url", "n_active", "lists", "rule", "blocked")


def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    return credentials.digest(credentials.find_secrets(docs, credentials.word_ranks(docs)))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(_read(spark, folder, "documents"), width=3, numerator=85)


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = wrappers.extract_pages(_read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def learned_quality(docs: DataFrame, labels: DataFrame) -> quality.Classifier:
    """The quality classifier, learned from the labels outside the held-out third."""
    shown = labels.where(~in_remainder("doc_id", 3, 1)).select("doc_id", F.col("quality").alias("label"))
    return quality.train(docs, shown)


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    model = learned_quality(docs, _read(spark, folder, "labels"))
    return quality.score_documents(
        docs, model, [F.col("doc_id"), in_remainder("doc_id", 3, 1).alias("held_out")]
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def mail(conversations: DataFrame) -> DataFrame:
    """Turns as messages that quote the turn before, and the one before that a level deeper.

    Ids are conv_id * 1000 + turn, with a larger factor where turns lie 1,000 or more apart.
    """
    spread = conversations.agg(F.max("turn").cast("bigint") - F.min("turn").cast("bigint")).first()[0] or 0
    factor = F.lit(max(1000, spread + 1)).cast("bigint")
    turns = conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))

    def quoted(text: str, marks: str) -> Column:
        return F.concat(F.lit("\n" + marks), F.regexp_replace(F.col(text), "\n", "\n" + marks))

    last = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("last"))
    older = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("older"))
    joined = conversations.join(last, ["conv_id", "turn"], "left").join(older, ["conv_id", "turn"], "left")
    number = F.col("conv_id") * factor + F.col("turn")
    parts = (F.coalesce("text", F.lit("")), F.coalesce(quoted("older", ">> "), F.lit("")), F.coalesce(quoted("last", "> "), F.lit("")))
    return joined.select(number.alias("message_id"), number.alias("sent"), "role", F.concat(*parts).alias("text"))


def op6_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotations.link_quotations(mail(_read(spark, folder, "conversations")))


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, folder, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return contamination.digest(found)


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return neighbours.nearest_neighbours(rows, rows.where("vec_id % 100 = 0"))


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    held_out = in_remainder("doc_id", 7, 2)
    model = language_model.train(docs.where(~held_out))
    return language_model.score_texts(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(_read(spark, folder, "embeddings"), vector="embedding")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(_read(spark, folder, "documents"))


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judge(_read(spark, folder, "documents"), [F.col("doc_id")])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_secret_scans,
        op3_near_duplicates,
        op4_html_extraction,
        op5_quality_classifier,
        op6_quotation_linking,
        op7_source_mixing,
        op8_benchmark_decontamination,
        op9_nearest_neighbours,
        op10_lm_scoring,
        op11_embedding_whitening,
        op12_spelling_variants,
        op13_quality_rules,
    )
}

ORACLE: dict[str, str] = {
    "op1_url_filters": sql.URL_FILTERS,
    "op3_near_duplicates": sql.NEAR_DUPLICATES,
    "op6_quotation_linking": sql.QUOTATION_LINKING,
    "op7_source_mixing": sql.SOURCE_MIXING,
    "op8_benchmark_decontamination": sql.BENCHMARK_DECONTAMINATION,
    "op12_spelling_variants": sql.SPELLING_VARIANTS,
    "op13_quality_rules": sql.QUALITY_RULES,
}
