"""Dense numbering, ranks and running sums that do not put a large group into one task.

Three forms, by what is known about the order:

* :func:`dense_index` numbers a whole table in a total order: range sort, then per-partition
  offsets.
* :func:`bucketed_rank` ranks within groups when the caller can name a bucket that grows with
  the order (a hash prefix, a block of positions): bucket counts give each bucket its offset and
  the window runs inside (group, bucket).
* :func:`running` ranks and sums within groups for any order. Groups under ``max_group_rows``
  use one ordinary window; larger ones are range-split first and carry totals across the splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.session import materialize, wide_partitions

MAX_GROUP_ROWS = 2_000_000
MAX_BROADCAST_GROUPS = 10_000
HASH_DIGITS = 4


def _cols(columns: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def _partitions(df: DataFrame) -> int:
    return wide_partitions(df.sparkSession)


def dense_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "input_index", start: int = 0
) -> DataFrame:
    """Number every row from ``start`` in ``order`` (a total order)."""
    order = _cols(order)
    placed = materialize(
        df.repartitionByRange(_partitions(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    # One row per range partition, so this window and broadcast are bounded by the partition count.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__pid")
        .agg(F.count("*").alias("__n"))
        .select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    return (
        placed.join(F.broadcast(offsets), "__pid")
        .withColumn(name, F.col("__before") + F.col("__at") + start)
        .drop("__pid", "__at", "__before")
    )


def bucketed_rank(
    df: DataFrame,
    by: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """1-based rank within ``by`` in ``order``, where ``bucket`` never decreases along ``order``.

    ``total`` also adds the group's row count. The result equals one ``row_number`` over ``by``.
    """
    keyed = df.withColumn("__bucket", bucket)
    counts = keyed.groupBy(*by, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("__n").over(Window.partitionBy(*by)).alias(total)] if total else []
    offsets = counts.select(
        *by, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), *extra
    )
    inside = Window.partitionBy(*by, "__bucket").orderBy(*_cols(order))
    return (
        keyed.join(offsets, [*by, "__bucket"])
        .withColumn(name, F.col("__before") + F.row_number().over(inside))
        .drop("__bucket", "__before")
    )


def draw_hash(seed: int, key: Column | str) -> Column:
    """Seeded, input-order-independent draw position of a sampling unit."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key) if isinstance(key, str) else key), 256)


def draw_rank(
    df: DataFrame,
    by: Sequence[str],
    key: Column | str,
    seed: int,
    name: str = "draw_rank",
    total: str | None = None,
) -> DataFrame:
    """Rank units of each group in seeded hash order; the hash prefix is the bucket."""
    key = F.col(key) if isinstance(key, str) else key
    hashed = df.withColumn("__draw", draw_hash(seed, key))
    bucket = F.substring("__draw", 1, HASH_DIGITS)
    return bucketed_rank(hashed, by, bucket, ["__draw", key], name, total).drop("__draw")


def _groups_over(df: DataFrame, by: Sequence[str], limit: int) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > limit)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column] | None = None,
    rank: str | None = None,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Add inclusive running sums and/or a 1-based rank within ``by`` in ``order`` (a total order).

    A null summand counts as 0, whatever the size of its group.
    """
    limit = max_group_rows or MAX_GROUP_ROWS
    order = _cols(order)
    parts = {name: F.coalesce(expr, F.lit(0)) for name, expr in (sums or {}).items()}
    if rank:
        parts[rank] = F.lit(1).cast("bigint")
    by = list(by)

    def window(source: DataFrame, keys: list[str]) -> DataFrame:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return source.withColumns({name: F.sum(expr).over(frame) for name, expr in parts.items()})

    hot = _groups_over(df, by, limit).drop("__n")
    if hot.isEmpty():
        return window(df, by)
    hot = materialize(hot)
    # Few large groups travel as a broadcast; a long list of them is left to the planner.
    small = F.broadcast if hot.count() <= MAX_BROADCAST_GROUPS else (lambda table: table)
    cold_rows = window(df.join(small(hot), by, "left_anti"), by)
    hot_rows = df.join(small(hot), by, "left_semi")
    placed = materialize(
        hot_rows.repartitionByRange(_partitions(df), *by, *order).withColumn("__pid", F.spark_partition_id())
    )
    totals = placed.groupBy(*by, "__pid").agg(*(F.sum(expr).alias(f"__{name}") for name, expr in parts.items()))
    before = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # A partition boundary adds one row, so there are at most partitions + hot groups rows to carry.
    carry = totals.select(
        *by, "__pid", *(F.sum(f"__{name}").over(before).alias(f"__{name}") for name in parts)
    )
    local = window(placed, [*by, "__pid"]).join(small(carry), [*by, "__pid"])
    hot_result = local.select(
        *df.columns,
        *((F.col(name) + F.coalesce(F.col(f"__{name}"), F.lit(0))).alias(name) for name in parts),
    )
    return cold_rows.select(*hot_result.columns).unionByName(hot_result)


def first_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The first row of every group by ``order``: an aggregate, so partial results shuffle, not rows."""
    return _picked(df, by, order, F.min_by, columns)


def last_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column | str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The last row of every group by ``order``."""
    return _picked(df, by, order, F.max_by, columns)


def _picked(df, by, order, pick, columns) -> DataFrame:
    kept = [c for c in (columns or df.columns) if c not in by]
    picked = df.groupBy(*by).agg(pick(F.struct(*kept), F.struct(*_cols(order))).alias("__row"))
    return picked.select(*by, *(F.col(f"__row.`{c}`").alias(c) for c in kept))


def first_k(
    df: DataFrame,
    by: Sequence[str],
    bucket: Column,
    order: Sequence[Column | str],
    quota: Column | str,
    name: str = "rank",
) -> DataFrame:
    """The first ``quota`` rows of every group in ``order``; ``bucket`` grows along ``order``.

    Buckets that start at or after the quota are dropped by the join with the small count table,
    before any row is sorted.
    """
    keyed = df.withColumn("__bucket", bucket)
    counts = keyed.groupBy(*by, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*by, "__bucket").orderBy(*_cols(order))
    quota = F.col(quota) if isinstance(quota, str) else quota
    return (
        keyed.join(offsets, [*by, "__bucket"])
        .where(F.col("__before") < quota)
        .withColumn(name, F.col("__before") + F.row_number().over(inside))
        .where(F.col(name) <= quota)
        .drop("__bucket", "__before")
    )


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """All rows, sorted across partitions."""
    return df.orderBy(*_cols(order))


def leading_rows(df: DataFrame, order: Sequence[Column | str], count: int) -> DataFrame:
    """The first ``count`` rows in ``order``: each task passes on at most that many."""
    return df.orderBy(*_cols(order)).limit(count)
