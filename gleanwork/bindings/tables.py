"""Roles the driver tables play, as DataFrames and as SQL with the same rows."""

from __future__ import annotations

from functools import cached_property
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions import paths
from gleanwork.functions.terms import word_terms
from gleanwork.operators.ordering import bucketed_rank
from gleanwork.session import materialize, shared_dir
from gleanwork.sources import content_store

# Word terms that occur in the driver's prose; the default lists name words it never uses.
PROSE_TERMS = word_terms(("license", "s?"), ("the", ""), ("de", ""), ("rest", "[a-z]*"), ("le", "s?"))
LANGS = ("de", "en", "es", "fr")


class Tables:
    """Lazy readers of one scale-factor folder and the roles built on them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def files(self) -> DataFrame:
        """File tree of `documents`: one repository per (lang, source), several path shapes."""
        d = self.documents
        name = F.concat("lang", F.lit("-org/"), "source")
        doc = F.col("doc_id").cast("string")
        shapes = [
            F.concat(F.lit("README_"), doc, F.lit(".md")),
            F.concat(F.lit("docs/CONTRIBUTING "), doc, F.lit(".MD")),
            F.concat(F.lit("docs/style_guide/"), doc, F.lit(".txt")),
            F.concat(F.lit("guidelines-"), doc, F.lit(".md")),
            F.concat(F.lit("vendor/readme"), doc, F.lit(".md")),
            F.concat(F.lit("development/"), doc, F.lit("/coding-style.md")),
            F.concat(F.lit("src/notes"), doc, F.lit(".md")),
            F.concat(F.lit("AGENTS-"), doc, F.lit(".rst")),
        ]
        path = shapes[-1]
        for index, shape in enumerate(shapes[:-1]):
            path = F.when(F.col("doc_id") % 8 == index, shape).otherwise(path)
        return d.select(
            "doc_id",
            "lang",
            name.alias("repository"),
            F.substring(F.sha2(name, 256), 1, 40).alias("revision"),
            path.alias("path"),
            F.when(F.col("doc_id") % 25 == 0, "120000").otherwise("100644").alias("mode"),
            F.substring(F.sha2("text", 256), 1, 40).alias("sha"),
            F.octet_length("text").cast("bigint").alias("size"),
            F.col("text").alias("content"),
        )

    @cached_property
    def entries(self) -> DataFrame:
        """The file tree without bodies: a stored narrow table."""
        return materialize(self.files.drop("content"))

    @cached_property
    def contents(self) -> DataFrame:
        """One body per blob."""
        return self.documents.groupBy(F.substring(F.sha2("text", 256), 1, 40).alias("sha")).agg(
            F.any_value("text").alias("content")
        )

    @cached_property
    def content_store(self) -> DataFrame:
        """The bodies as a content store, written once per application."""
        path = f"{shared_dir(self.spark).rstrip('/')}/gleanwork/{self.spark.sparkContext.applicationId}/contents-{crc32(self.folder.encode())}"
        if content_store.bucket_count(self.spark, path):
            return content_store.open_contents(self.spark, path)
        return content_store.write_contents(self.files.select("sha", "content"), path)

    @cached_property
    def candidates(self) -> DataFrame:
        """Candidate rows of every Markdown file, without bodies."""
        return self.files.where(paths.is_regular("mode") & paths.is_markdown("path")).select(
            F.col("repository").alias("name"),
            F.col("revision").alias("lastCommitSHA"),
            F.col("path").alias("markdown_path"),
            F.col("sha").alias("blob_sha"),
            F.sha2("content", 256).alias("content_sha256"),
            F.col("size").alias("size_bytes"),
            F.col("doc_id").alias("input_index"),
        )

    @cached_property
    def units(self) -> DataFrame:
        """Population of sampling units: one per document, stratum = lang."""
        name = F.concat("lang", F.lit("/Doc"), "doc_id")
        return self.documents.select(
            name.alias("name"),
            F.substring(F.sha2(name, 256), 1, 40).alias("lastCommitSHA"),
            F.col("lang").alias("mainLanguage"),
            F.col("source").alias("license"),
            F.concat("lang", F.lit(".csv")).alias("source_file"),
            F.col("doc_id").alias("input_index"),
            F.col("doc_id"),
        )

    @cached_property
    def excluded(self) -> DataFrame:
        """Units already used: those with a toxic label."""
        return self.units.join(self.labels.where("toxic = 1"), "doc_id", "left_semi").select(F.upper("name").alias("name"))

    @cached_property
    def attempts(self) -> DataFrame:
        """Attempt log of `events`: key = user, append order = event id, tokens from the JSON."""
        e = self.events
        k = F.get_json_object("props", "$.k").cast("bigint")
        status = (
            F.when(F.col("event_type") == "click", "model_error")
            .when(F.col("event_type") == "view", "not_found")
            .when(F.col("event_type") == "error", "retrieval_error")
            .when(F.col("event_type") == "purchase", "pass")
            .otherwise("review")
        )
        return e.select(
            F.concat(F.lit("candidate-"), "user_id").alias("custom_id"),
            "user_id",
            F.col("event_id").alias("seq"),
            status.alias("status"),
            (k * 5000).alias("input_tokens"),
            (k * 1000).alias("cached_input_tokens"),
            (k * 500).alias("cache_write_input_tokens"),
            (k * 3500).alias("uncached_input_tokens"),
            (k * 20).alias("output_tokens"),
            F.col("value").cast("decimal(18,2)").cast("decimal(18,9)").alias("cost_usd"),
        )

    @cached_property
    def scheduled(self) -> DataFrame:
        """Schedule in document order with an outcome from `labels`: quality 1 passes."""
        # One row per (stratum, round): the position within the stratum in document order.
        d = bucketed_rank(
            self.documents.select("doc_id", "lang", "source"),
            ["lang"],
            F.floor(F.col("doc_id") / 65_536),
            ["doc_id"],
            "round_number",
        ).join(self.labels, "doc_id", "left")
        # A schedule is a stored table, read many times.
        return materialize(d.select(
            (F.col("doc_id") + 1).alias("sample_order"),
            "round_number",
            F.col("lang").alias("language"),
            F.concat("lang", F.lit("/Doc"), "doc_id").alias("repository"),
            F.substring(F.sha2(F.concat("lang", F.lit("/Doc"), "doc_id"), 256), 1, 40).alias("revision"),
            F.col("source").alias("license_name"),
            F.when(F.col("quality") == 1, "pass")
            .when(F.col("quality") == 0, "not_found")
            .otherwise("unresolved")
            .alias("status"),
            "doc_id",
        ))


FILES_SQL = """files AS (
  SELECT doc_id, lang, lang || '-org/' || source AS repository,
    substr(sha256(lang || '-org/' || source), 1, 40) AS revision,
    CASE doc_id % 8 WHEN 0 THEN 'README_' || doc_id || '.md'
      WHEN 1 THEN 'docs/CONTRIBUTING ' || doc_id || '.MD'
      WHEN 2 THEN 'docs/style_guide/' || doc_id || '.txt'
      WHEN 3 THEN 'guidelines-' || doc_id || '.md'
      WHEN 4 THEN 'vendor/readme' || doc_id || '.md'
      WHEN 5 THEN 'development/' || doc_id || '/coding-style.md'
      WHEN 6 THEN 'src/notes' || doc_id || '.md'
      ELSE 'AGENTS-' || doc_id || '.rst' END AS path,
    CASE WHEN doc_id % 25 = 0 THEN '120000' ELSE '100644' END AS mode,
    substr(sha256(text), 1, 40) AS sha, CAST(strlen(text) AS BIGINT) AS size, text AS content
  FROM documents)"""
CANDIDATES_SQL = (
    FILES_SQL
    + """, candidates AS (
  SELECT repository AS name, revision AS lastCommitSHA, path AS markdown_path, sha AS blob_sha,
    sha256(content) AS content_sha256, size AS size_bytes, doc_id AS input_index
  FROM files WHERE mode <> '120000' AND lower(path) LIKE '%.md')"""
)
UNITS_SQL = """units AS (
  SELECT lang || '/Doc' || doc_id AS name, substr(sha256(lang || '/Doc' || doc_id), 1, 40) AS lastCommitSHA,
    lang AS mainLanguage, source AS license, lang || '.csv' AS source_file, doc_id AS input_index, doc_id
  FROM documents),
excluded AS (
  SELECT DISTINCT lower(name) AS unit FROM units WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))"""
ATTEMPTS_SQL = """attempts AS (
  SELECT 'candidate-' || user_id AS custom_id, user_id, event_id AS seq,
    CASE event_type WHEN 'click' THEN 'model_error' WHEN 'view' THEN 'not_found' WHEN 'error' THEN 'retrieval_error'
      WHEN 'purchase' THEN 'pass' ELSE 'review' END AS status,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 5000 AS input_tokens,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS cached_input_tokens,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 500 AS cache_write_input_tokens,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 3500 AS uncached_input_tokens,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 20 AS output_tokens,
    CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,9)) AS cost_usd
  FROM events)"""
SCHEDULED_SQL = """scheduled AS (
  SELECT d.doc_id + 1 AS sample_order, row_number() OVER (PARTITION BY lang ORDER BY d.doc_id) AS round_number,
    lang AS language, lang || '/Doc' || d.doc_id AS repository,
    substr(sha256(lang || '/Doc' || d.doc_id), 1, 40) AS revision, source AS license_name,
    CASE quality WHEN 1 THEN 'pass' WHEN 0 THEN 'not_found' ELSE 'unresolved' END AS status, d.doc_id
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def word_sql(column: str, pattern: str) -> str:
    """DuckDB whole-word test with the same word characters as the term lists."""
    return rf"regexp_matches({column}, '(^|[^\p{{L}}\p{{N}}_])({pattern})($|[^\p{{L}}\p{{N}}_])', 'i')"


def terms_sql(column: str) -> str:
    """Joined names of the prose terms found in ``column``."""
    parts = ", ".join(
        f"CASE WHEN {word_sql(column, t.stem + t.tail)} THEN '{t.name}' END" for t in PROSE_TERMS
    )
    return f"concat_ws('|', {parts})"
