"""Connected components of a link table, by alternating large-star and small-star rounds.

Links stay in Spark throughout. Each round only aggregates minima per node (combined before the
shuffle, so a hub is no burden) and joins them back (a join whose large partitions may be split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.session import materialize

MAX_ROUNDS = 60


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Link each neighbour to the smallest node of the star it is in.

    ``both``: large stars (every neighbour larger than the centre); else small stars
    (the centre and its smaller neighbours).
    """
    if both:
        sides = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = sides.join(least, "u")
    if both:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) → (node, component): the smallest node reachable, for every linked node.

    Nulls and self-links are ignored; repeated links count once; no links give no rows.
    """
    current = materialize(links.where(F.col("u") != F.col("v")).select("u", "v").distinct())
    for _ in range(MAX_ROUNDS):
        following = materialize(_star(_star(current, True), False))
        changed = following.join(current, ["u", "v"], "left_anti").limit(1).count()
        same = not changed and following.count() == current.count()
        current = following
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
