"""File bodies stored once per ``sha``, bucketed by it, so that later joins on ``sha`` leave them where they lie.

A store is an external table ``sha, n_chars, content``. A join with it shuffles the other side into
its buckets; bodies are read, used and dropped in the scan's own tasks. ``n_chars`` can be read
without the bodies.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.session import wide_partitions

COLUMNS = ("sha", "n_chars", "content")


def _name(path: str) -> str:
    return "contents_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _one_each(contents: DataFrame) -> DataFrame:
    """One body per sha; copies collapse in the tasks that read them. Rows without either are left out."""
    kept = contents.where(F.col("sha").isNotNull() & F.col("content").isNotNull())
    bodies = kept.groupBy("sha").agg(F.first("content").alias("content"))
    return bodies.select("sha", F.length("content").cast("bigint").alias("n_chars"), "content")


def _write(bodies: DataFrame, path: str, buckets: int, mode: str) -> None:
    folder = f"{path}/buckets-{buckets}"
    bodies.write.mode(mode).format("parquet").option("path", folder).bucketBy(buckets, "sha").sortBy("sha").saveAsTable(_name(path))


def write_contents(contents: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Store ``contents`` (``sha, content``, copies allowed) below ``path`` and return the store.

    ``buckets`` defaults to the shuffle partitions of the session. A bucket must fit a task, so its
    number follows the size of the bodies, not that of later queries.
    """
    spark, path = contents.sparkSession, path.rstrip("/")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    _write(_one_each(contents), path, buckets or wide_partitions(spark), "overwrite")
    return open_contents(spark, path)


def bucket_count(spark: SparkSession, path: str) -> int:
    """Buckets of the store below ``path``; 0 without one."""
    fs, folder = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    found = [int(n.removeprefix("buckets-")) for n in names if n.startswith("buckets-")]
    return found[0] if found else 0


def open_contents(spark: SparkSession, path: str) -> DataFrame:
    """The store below ``path``; the table is declared anew where the catalogue of this session lacks it."""
    path = path.rstrip("/")
    count = bucket_count(spark, path)
    if not count:
        raise ValueError(f"no content store in {path}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path)} (sha STRING, n_chars BIGINT, content STRING) USING parquet "
        f"CLUSTERED BY (sha) SORTED BY (sha) INTO {count} BUCKETS LOCATION '{path}/buckets-{count}'"
    )
    return spark.table(_name(path)).select(*COLUMNS)


def add_contents(contents: DataFrame, path: str) -> DataFrame:
    """Add the bodies whose ``sha`` the store doesn't have; those it has are only looked up by sha."""
    spark, path = contents.sparkSession, path.rstrip("/")
    known = open_contents(spark, path).select("sha")
    new = contents.join(known, "sha", "left_anti")
    _write(_one_each(new), path, bucket_count(spark, path), "append")
    spark.catalog.refreshTable(_name(path))
    return open_contents(spark, path)
