"""Digests of Parquet tables from a record of their files: files that have not changed are not read again.

The sums a table digest is made of add up over files. The record keeps them for every file, with
the file's length, time of change and the table's schema. Another run lists the files, reads those
the record does not know as they are, and adds up the rest from the record. A version of the record
holds the files of its run only; the one before it stays for readers that began with it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.operators.publish import WORDS, digest_of, row_sums, schema_text

KEY = ["role", "file", "length", "modified", "schema"]
ENTRY = "role string, file string, length bigint, modified timestamp, schema string, rows bigint, " + ", ".join(
    f"{w} bigint" for w in WORDS
)
# Versions before the newest that stay readable.
KEPT = 1


def recorded_digests(spark: SparkSession, tables: Mapping[str, str], record: str) -> DataFrame:
    """Digest rows of Parquet files or folders: ``role, rows, digest, files, files_read``.

    ``tables`` maps a role to a path, ``record`` is the folder of the record. ``digest`` equals that
    of ``table_digest`` over the whole table. A file counts as unchanged while its path, length and
    time of change are; a new schema of the table makes all its files read again. One run at a time
    may write a record; a run that broke off leaves the last whole version in place.
    """
    listed = None
    frames = {}
    for role, path in tables.items():
        frames[role] = spark.read.parquet(path)
        part = _listing(spark, path).select(
            F.lit(role).alias("role"), "path", "file", "length", "modified", F.lit(schema_text(frames[role])).alias("schema")
        )
        listed = part if listed is None else listed.unionByName(part)
    versions = _versions(spark, record)
    whole = [v for v, complete in versions if complete]
    known = spark.createDataFrame([], ENTRY) if not whole else spark.read.schema(ENTRY).parquet(_folder(record, whole[-1]))
    # The names of files to read, as Spark itself lists them on the driver before it reads.
    unread = listed.join(known.select(*KEY), KEY, "left_anti").select("role", "path").collect()
    entries = listed.join(known, KEY, "inner").select(*KEY, "rows", *WORDS, F.lit(0).alias("read"))
    for role, path in tables.items():
        new = sorted(r["path"] for r in unread if r["role"] == role)
        if new:
            entries = entries.unionByName(_hashed(spark, role, path, frames[role], new, listed))
    number = max((v for v, _ in versions), default=0) + 1
    entries.write.mode("errorifexists").parquet(_folder(record, number))
    _expire(spark, record, [v for v, _ in versions if v < (whole[-KEPT] if len(whole) >= KEPT else 0)])
    written = spark.read.schema(f"{ENTRY}, read int").parquet(_folder(record, number))
    sums = written.groupBy("role", "schema").agg(
        *(F.sum(n).alias(n) for n in ("rows", *WORDS)), F.count("*").alias("files"), F.sum("read").alias("files_read")
    )
    return sums.select("role", "rows", digest_of(F.col("schema")).alias("digest"), "files", "files_read")


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, file, length, modified`` of the data files below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        "path", F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )


def _hashed(spark: SparkSession, role: str, path: str, table: DataFrame, files: list[str], listed: DataFrame) -> DataFrame:
    """Entries of ``files``; one without rows has sums of zero."""
    reader = spark.read.schema(table.schema)
    # Values of partition columns are in the names of folders below the table's own.
    below = [f for f in files if not f.rstrip("/").endswith(path.rstrip("/"))]
    rows = (reader.option("basePath", path) if below else reader).parquet(*files)
    sums = row_sums(rows, F.col("_metadata.file_path").alias("file"))
    chosen = listed.where(F.col("role") == role).join(spark.createDataFrame([(f,) for f in files], "path string"), "path", "left_semi")
    return chosen.join(sums, "file", "left").select(
        *KEY, *(F.coalesce(n, F.lit(0)).alias(n) for n in ("rows", *WORDS)), F.lit(1).alias("read")
    )


# ---------------------------------------------------------------- versions


def _folder(record: str, version: int) -> str:
    return f"{record.rstrip('/')}/version-{version:012d}"


def _versions(spark: SparkSession, record: str) -> list[tuple[int, bool]]:
    """(number, whether it was written whole) of every version, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(record).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path(record))] if fs.exists(path(record)) else []
    numbers = sorted(int(n.removeprefix("version-")) for n in names if n.startswith("version-"))
    return [(n, fs.exists(path(f"{_folder(record, n)}/_SUCCESS"))) for n in numbers]


def _expire(spark: SparkSession, record: str, versions: list[int]) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(record).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for version in versions:
        fs.delete(path(_folder(record, version)), True)
