"""Sinks: ordered reports, append-only logs, JSON summaries, exports and bundles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.operators.publish import provenance
from gleanwork.session import wide_partitions


def write_report(
    df: DataFrame, path: str, columns: Sequence[str], order: Sequence[Column | str], format: str = "parquet"
) -> None:
    """Fixed columns in a fixed order: a range-partitioned sort, so files are ordered by name."""
    df.select(*columns).orderBy(*order).write.mode("overwrite").option("header", True).format(format).save(path)


def append_attempts(df: DataFrame, path: str, batch: str) -> bool:
    """Append attempts to the log as the batch of that name; whether they were written.

    A batch that is complete already is left as it is, so a rerun changes nothing; what a broken run
    left of one is replaced. The log is one folder per batch, committed by its ``_SUCCESS`` file.
    """
    if not batch or "/" in batch or "=" in batch:
        raise ValueError(f"not a batch name: {batch!r}")
    folder = f"{path.rstrip('/')}/batch={batch}"
    if is_committed(df.sparkSession, folder):
        return False
    df.write.mode("overwrite").json(folder)
    return True


def is_committed(spark: SparkSession, folder: str) -> bool:
    """Whether a write to ``folder`` has ended."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def write_attempt_records(df: DataFrame, path: str, order: Sequence[Column | str]) -> None:
    """All attempts as JSON lines in report order."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row frame as one JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_review_files(df: DataFrame, path: str) -> None:
    """Review files with their bodies, one folder per repository.

    Range splits on (folder, file) give small repositories one writer and a large one many.
    """
    splits = wide_partitions(df.sparkSession)
    df.repartitionByRange(splits, "folder", "file").write.mode("overwrite").partitionBy("folder").parquet(path)


def write_payloads(df: DataFrame, path: str) -> None:
    """Label-free review payloads as JSON lines."""
    df.write.mode("overwrite").json(path)


def publish(tables: Mapping[str, DataFrame], inputs: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Write a bundle and its provenance; digests are taken from what was written."""
    root = path.rstrip("/")
    written = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        written[name] = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")
    record = provenance({**inputs, **written})
    record.write.mode("overwrite").json(f"{root}/provenance")
    return record
