"""A training corpus from ``documents``: quality, near-duplicates, contamination, secrets, mix.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns documents with
the same columns; the last returns the documents the mix takes, with how often each is repeated.
Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import contamination, credentials, mixing, near_duplicates, quality
from gleanwork.llm.queries import learned_quality
from gleanwork.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; it learns from the labelled ones outside its held-out third."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.accepted(docs, learned_quality(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8: the one with the smallest id."""
    return near_duplicates.one_of_each(docs, near_duplicates.near_duplicates(docs, width=5, numerator=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 % of the words stand in passages of the benchmark."""
    return contamination.uncontaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and ``n_chars`` (if there is one) counted again."""
    clean = credentials.redact(docs, credentials.word_ranks(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with their copies; sources are weighed 1, 2, 3 in turn."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
]

# SQL can express neither the classifier nor the secrets; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
