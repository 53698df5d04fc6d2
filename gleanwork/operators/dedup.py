"""Exact-content deduplication of candidate files.

Rows carry ``name, lastCommitSHA, markdown_path`` and ``content_sha256`` and/or ``blob_sha``;
an optional ``status`` feeds the conflict report. File bodies never take part in a shuffle here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.paths import content_identity
from gleanwork.operators.ordering import first_rows
from gleanwork.operators.skew import attach

GROUP = "exact_group_id"


def representative_order() -> list[Column]:
    """Order that picks a group's representative; the raw name only breaks case-only ties."""
    return [
        F.lower("name"),
        F.col("lastCommitSHA"),
        F.lower("markdown_path"),
        F.col("markdown_path"),
        F.col("name"),
    ]


def with_group(rows: DataFrame) -> DataFrame:
    """Add the content identity; a missing hash column counts as blank."""
    def column(name: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit("")

    if not {"content_sha256", "blob_sha"} & set(rows.columns):
        raise ValueError("rows need content_sha256 or blob_sha")
    return rows.withColumn(GROUP, content_identity(column("content_sha256"), column("blob_sha")))


def exact_groups(rows: DataFrame) -> DataFrame:
    """One row per content: representative, size and number of distinct non-blank statuses."""
    grouped = with_group(rows)
    statuses = (
        F.count_distinct(F.nullif(F.col("status"), F.lit(""))) if "status" in rows.columns else F.lit(0).cast("bigint")
    )
    return grouped.groupBy(GROUP).agg(
        F.min(F.struct(*(c.alias(f"o{i}") for i, c in enumerate(representative_order())))).alias("representative"),
        F.count("*").alias("group_size"),
        statuses.alias("distinct_statuses"),
    )


def canonical_rows(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One deterministic row per exact content (rows without any hash are left out)."""
    grouped = with_group(rows).where(F.col(GROUP).isNotNull())
    return first_rows(grouped, [GROUP], representative_order(), columns)


def occurrences(rows: DataFrame, conflicts_only: bool = False) -> DataFrame:
    """Every row with its group, size and ``is_canonical``; optionally only conflicting groups.

    ``rows`` is read three times (heavy groups, groups, join): pass a stored table.
    """
    groups = exact_groups(rows)
    if conflicts_only:
        groups = groups.where(F.col("distinct_statuses") > 1)
    facts = groups.select(GROUP, "representative", "group_size")
    joined = attach(with_group(rows), facts, [GROUP], how="inner")
    own = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(representative_order())))
    return joined.withColumn("is_canonical", own == F.col("representative"))


def conflicting_groups(rows: DataFrame) -> DataFrame:
    """Contents whose copies carry more than one distinct non-blank status."""
    return exact_groups(rows).where(F.col("distinct_statuses") > 1)


def dedup_summary(rows: DataFrame) -> DataFrame:
    """One row of counts."""
    return exact_groups(rows).agg(
        F.coalesce(F.sum("group_size"), F.lit(0)).alias("input_files"),
        F.count("*").alias("unique_contents"),
        F.count_if(F.col("group_size") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("group_size") - 1), F.lit(0)).alias("redundant_files"),
        F.count_if(F.col("distinct_statuses") > 1).alias("decision_conflict_groups"),
    )
