"""The most frequent keys of a counted table, without sending every task's candidates to the driver."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Counts within this factor share a bucket of the histogram.
STEP = 1.02


def most_frequent(counts: DataFrame, key: str, size: int) -> list[tuple]:
    """(key, n) of the ``size`` largest ``n``, ties to the smaller key, largest first.

    A histogram of the counts (one row per bucket) gives a count that about ``size`` rows reach; only
    those are ranked, so what is gathered doesn't grow with the number of tasks.
    """
    bucket = F.floor(F.log(F.col("n")) / math.log(STEP)).cast("int")
    histogram = counts.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), F.min("n").alias("least")).collect()
    least, reached = 0, 0
    for row in sorted(histogram, key=lambda r: -r["bucket"]):
        least, reached = row["least"], reached + row["rows"]
        if reached >= size:
            break
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), key).limit(size)
    return [(r[key], r["n"]) for r in top.select(key, "n").collect()]
