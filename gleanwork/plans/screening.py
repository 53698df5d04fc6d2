"""Screening plans: terms, exact dedup and per-source counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.paths import content_sha256
from gleanwork.functions.terms import Term, any_term
from gleanwork.session import materialize


def dedup_by_source(documents: DataFrame, terms: Sequence[Term]) -> DataFrame:
    """Files, canonical files and redundant files per source among documents with any term.

    Bodies are matched and hashed in the scan stage. The first aggregate, on (hash, source),
    collapses copies map-side, so a hot content group never meets in one task. Its narrow result is
    written once: totals and owners both read it, and the bodies are scanned a single time.
    """
    hits = documents.where(any_term("text", terms)).select("doc_id", "source", content_sha256("text").alias("hash"))
    per_source = materialize(
        hits.groupBy("hash", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    )
    owners = per_source.groupBy("hash").agg(
        F.min_by("source", F.struct(F.lower("source"), "doc_id")).alias("owner")
    )
    canonical = owners.groupBy(F.col("owner").alias("source")).agg(F.count("*").alias("canonical_files"))
    totals = per_source.groupBy("source").agg(F.sum("n").alias("files"))
    return (
        totals.join(canonical, "source", "left")
        .fillna(0, ["canonical_files"])
        .select("source", "files", "canonical_files", (F.col("files") - F.col("canonical_files")).alias("redundant_files"))
    )
