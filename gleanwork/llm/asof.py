"""As-of join without a task that holds a whole key: range split, local window, carried last value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanwork.session import materialize, wide_partitions


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: Sequence[str],
    values: Sequence[str],
    strict: bool = False,
) -> DataFrame:
    """``left`` plus ``values`` of the last ``right`` row of the same ``keys`` at or before it (before, if ``strict``).

    Both sides carry ``keys`` and the order columns ``at``. Of right rows at one moment the largest
    ``values`` win. Rows of ``right`` with a null key or moment match nothing; rows of ``left`` with
    one come back with null ``values``. ``values`` come back as a struct column ``match``.
    """
    keys, at = list(keys), list(at)
    kept = [c for c in left.columns if c not in (*keys, *at)]
    usable = right.where(" and ".join(f"`{c}` is not null" for c in (*keys, *at)))
    match_type = right.select(F.struct(*values).alias("m")).schema["m"].dataType
    left_rank, right_rank = (0, 1) if strict else (1, 0)
    events = left.select(
        *keys, *at, F.lit(left_rank).alias("__side"), F.lit(None).cast(match_type).alias("__value"),
        (F.struct(*kept) if kept else F.struct(F.lit(1).alias("one"))).alias("__row"),
    )
    row_type = events.schema["__row"].dataType
    events = events.unionByName(
        usable.select(
            *keys, *at, F.lit(right_rank).alias("__side"), F.struct(*values).alias("__value"),
            F.lit(None).cast(row_type).alias("__row"),
        )
    )
    order = [*at, "__side", "__value"]
    # Stored once: the range borders come from a sample and must not move between the two uses.
    placed = materialize(
        events.repartitionByRange(wide_partitions(left.sparkSession), *keys, *order).withColumn(
            "__part", F.spark_partition_id()
        )
    )
    inside = Window.partitionBy("__part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("__local", F.last("__value", ignorenulls=True).over(inside)).where("__row is not null")
    # A key has at most one row per range partition here; only keys that span partitions carry anything.
    moment = F.when(F.col("__value").isNotNull(), F.struct(*(F.col(c) for c in order)))
    ends = placed.groupBy(*keys, "__part").agg(F.max_by("__value", moment).alias("__last"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.withColumn("__carried", F.last("__last", ignorenulls=True).over(earlier))
        .where("__carried is not null")
        .select(*keys, "__part", "__carried")
    )
    joined = local.join(carried, [*keys, "__part"], "left")
    return joined.select(
        *keys, *at, *(F.col(f"__row.`{c}`").alias(c) for c in kept), F.coalesce("__local", "__carried").alias("match")
    )
