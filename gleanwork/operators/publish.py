"""Final tables, digests and provenance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions import labels, paths
from gleanwork.functions.text import strip
from gleanwork.operators.review import is_accepted
from gleanwork.operators.skew import attach


def accepted_files(checklists: Mapping[str, DataFrame], ineligible: DataFrame | None = None) -> DataFrame:
    """Accepted rows of all checklists with their ``origin``; ineligible repositories are dropped.

    ``checklists`` maps an origin (``baseline`` or ``new``) to a checklist; a missing
    ``duplicate_of`` column counts as blank.
    """
    merged = None
    for origin, rows in checklists.items():
        if "duplicate_of" not in rows.columns:
            rows = rows.withColumn("duplicate_of", F.lit(""))
        part = rows.where(is_accepted()).withColumn("origin", F.lit(origin))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    if ineligible is None:
        return merged
    names = ineligible.select(F.lower(strip("repository")).alias("__name")).distinct()
    return (
        merged.withColumn("__name", F.lower(strip("repository"))).join(names, "__name", "left_anti").drop("__name")
    )


def guideline_rows(accepted: DataFrame, selected: DataFrame) -> DataFrame:
    """Accepted files joined to their selected repository at the pinned revision."""
    chosen = selected.select(
        F.lower(strip("repository")).alias("__name"),
        F.col("repository").alias("__repository"),
        "revision",
        "sampling_language",
        "sample_order",
    )
    joined = attach(accepted.withColumn("__name", F.lower(strip("repository"))), chosen, ["__name"], how="inner")
    kept = [c for c in accepted.columns if c not in ("repository",)]
    return joined.where(paths.url_revision("github_url", strip("repository")) == F.col("revision")).select(
        F.col("__repository").alias("repository"), "revision", "sampling_language", "sample_order", *kept
    )


def repository_rows(selected: DataFrame, files: DataFrame) -> DataFrame:
    """Selected repositories with their number of accepted files."""
    counts = files.groupBy(F.lower("repository").alias("__name")).agg(F.count("*").alias("guideline_file_count"))
    return (
        selected.withColumn("__name", F.lower("repository"))
        .join(counts, "__name", "left")
        .fillna(0, ["guideline_file_count"])
        .withColumn("origin", labels.final_origin("origin"))
        .drop("__name")
    )


def final_totals(selected: DataFrame, files: DataFrame) -> DataFrame:
    """Long-form totals: ``section, name, value``."""
    def section(rows: DataFrame, name: str, key: Column) -> DataFrame:
        return rows.groupBy(key.alias("name")).agg(F.count("*").alias("value")).select(
            F.lit(name).alias("section"), "name", "value"
        )

    return (
        section(selected, "repositories_by_origin", labels.final_origin("origin"))
        .unionByName(section(selected, "repositories_by_language", F.col("sampling_language")))
        .unionByName(section(files, "files_by_origin", F.col("origin")))
        .unionByName(section(files, "files_by_review_origin", F.col("review_origin")))
    )


# The sums a digest is made of: eight 16-bit words of two row hashes.
WORDS = tuple(f"{h}w{i}" for h in ("h0", "h1") for i in range(4))


def row_sums(df: DataFrame, *by: Column) -> DataFrame:
    """``rows`` and the word sums of a table, or of each group ``by``; sums of parts add up to those of the whole."""
    columns = sorted(df.columns)
    values = [
        F.to_json(F.col(f"`{c}`")) if "map<" in df.schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in columns
    ]
    nulls = [value.isNull() for value in values]
    hashes = df.select(
        *by, F.xxhash64(F.lit(1), *values, *nulls).alias("h0"), F.xxhash64(F.lit(2), *nulls, *values).alias("h1")
    )
    kept = hashes.columns[: len(by)]
    words = [
        F.shiftrightunsigned(F.col(name[:2]), 16 * int(name[3])).bitwiseAND(F.lit(0xFFFF)).alias(name) for name in WORDS
    ]
    return hashes.select(*kept, *words).groupBy(*kept).agg(
        F.count("*").alias("rows"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in WORDS)
    )


def schema_text(df: DataFrame) -> str:
    """Names and types of the columns, by name."""
    return ",".join(f"{c}:{df.schema[c].dataType.simpleString()}" for c in sorted(df.columns))


def digest_of(schema: Column) -> Column:
    """The digest of a table with this schema text, ``rows`` and word sums."""
    return F.sha2(F.concat_ws("|", schema, F.col("rows").cast("string"), *(F.col(n).cast("string") for n in WORDS)), 256)


def table_digest(df: DataFrame, role: str) -> DataFrame:
    """Order- and partition-insensitive digest of a table: ``role, rows, digest``.

    Every row hashes to 128 bits (two seeded 64-bit hashes over all columns and their null flags);
    the eight 16-bit words are summed, so any order or partitioning of the same rows gives the same
    digest and repeats count. Sums stay exact up to 2^47 rows. This detects change; it is not a
    signature against an adversary.
    """
    return row_sums(df).select(F.lit(role).alias("role"), "rows", digest_of(F.lit(schema_text(df))).alias("digest"))


def settings_table(spark, settings: Mapping[str, object]) -> DataFrame:
    """Run settings as ``name, value`` rows of canonical JSON."""
    import json

    rows = [(name, json.dumps(value, sort_keys=True)) for name, value in sorted(settings.items())]
    return spark.createDataFrame(rows, "name string, value string")


def settings_digest(settings: DataFrame) -> DataFrame:
    """Digest of a settings table; independent of row order."""
    return table_digest(settings, "settings")


def provenance(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Digest rows of every published or consumed table."""
    merged = None
    for role, df in tables.items():
        part = table_digest(df, role)
        merged = part if merged is None else merged.unionByName(part)
    return merged
