"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.session import materialize, wide_partitions

# At most this many keys are treated as heavy, so the heavy list is always small enough to broadcast.
HEAVY_KEYS = 1_000
# A sketch tracking this many keys finds every key above 1 / HEAVY_SHARE of the rows.
TRACKED_KEYS = 3_000
# A key is heavy when it holds more than 1 / HEAVY_SHARE of the rows.
HEAVY_SHARE = 1_000
MIN_HEAVY_ROWS = 10_000
# Tasks that merge the sketches of all scan tasks before the last merge.
SKETCH_MERGERS = 64


def _key(on: Sequence[str]) -> Column:
    return F.concat_ws("\u0001", *(F.col(c).cast("string") for c in on))


def heavy_keys(rows: DataFrame, on: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """Keys holding a large share of ``rows``: one scan with a frequent-items sketch, no shuffle of keys.

    Sketches merge in two levels, so no task receives one from every scan task. The list is
    approximate and may differ between evaluations; both sides of a join must read one stored copy.
    """
    floor = MIN_HEAVY_ROWS if min_rows is None else min_rows
    # The extra blank key keeps the merge defined when there are no rows.
    keys = rows.select(_key(on).alias("__key")).unionByName(rows.sparkSession.range(1).select(F.lit("").alias("__key")))
    sketches = keys.groupBy((F.spark_partition_id() % SKETCH_MERGERS).alias("__part")).agg(
        F.expr(f"approx_top_k_accumulate(__key, {TRACKED_KEYS})").alias("__sketch"), F.count("*").alias("__n")
    )
    merged = sketches.agg(F.expr("approx_top_k_combine(__sketch)").alias("__sketch"), F.sum("__n").alias("__n"))
    return (
        merged.select("__n", F.explode(F.expr(f"approx_top_k_estimate(__sketch, {HEAVY_KEYS})")).alias("__item"))
        .where((F.col("__item.count") > floor) & (F.col("__item.count") * HEAVY_SHARE > F.col("__n")))
        .select(F.col("__item.item").alias("__key"), F.lit(True).alias("__heavy"))
    )


def attach(
    rows: DataFrame,
    facts: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int | None = None,
    min_rows: int | None = None,
    heavy_of: DataFrame | None = None,
) -> DataFrame:
    """Join many ``rows`` to at most one row of ``facts`` per key, salting the heavy keys.

    Rows of a heavy key spread over ``salts`` tasks and its one fact is repeated for each. The list
    of heavy keys is stored once and read by both sides, so that they always agree on the salts; a
    missed or extra key costs balance, never a row. ``rows`` is read for the list and for the join;
    where it is costly to make, ``heavy_of`` has narrow rows with (most of) the same keys, and
    ``rows`` is read once. Null keys match nothing and are spread too.
    """
    salts = salts or wide_partitions(rows.sparkSession)
    blank = rows.sparkSession.range(1).select(F.lit("").alias("__key"), F.lit(True).alias("__heavy"))
    found = heavy_keys(rows if heavy_of is None else heavy_of, on, min_rows).where("__key != ''").unionByName(blank)
    heavy = F.broadcast(materialize(found))
    spread = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), F.lit(salts))
    salted_rows = (
        rows.withColumn("__key", _key(on))
        .join(heavy, "__key", "left")
        .withColumn("__salt", F.when(F.col("__heavy"), spread).otherwise(F.lit(0).cast("bigint")))
        .drop("__key", "__heavy")
    )
    copies = F.when(F.col("__heavy"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    salted_facts = (
        facts.withColumn("__key", _key(on))
        .join(heavy, "__key", "left")
        .withColumn("__salt", F.explode(F.coalesce(copies, F.array(F.lit(0).cast("bigint")))))
        .drop("__key", "__heavy")
    )
    return salted_rows.join(salted_facts, [*on, "__salt"], how).drop("__salt")
