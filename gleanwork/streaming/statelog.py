"""Keyed state of a stream as files: deltas by batch over a base split by key hash, and a manifest for each batch.

A batch adds one delta. The manifest written after it names, for every bucket, the version of its
base, and every delta since with the buckets it has rows of. A batch therefore reads its own
buckets only: their base folders, and the deltas that touch them. Every few batches the buckets
with deltas are folded into new base folders; those without stay as they are.

A batch starts from the newest manifest older than itself, so a repeated one replaces what it
wrote before. Versions that no kept manifest names are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
# Deltas are folded into the base after this many batches.
COMPACT_EVERY = 20
# Manifests before the newest that stay readable, for readers that began with them.
KEPT = 2
# Files a bucket's base is split into, so that a bucket with a very large key has several writers.
FILES_BY_BUCKET = 4


@dataclass
class Manifest:
    """``base``: bucket → version of its base folder; ``deltas``: version → the buckets it has rows of."""

    base: dict[int, int] = field(default_factory=dict)
    deltas: dict[int, list[int]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"base": self.base, "deltas": self.deltas})

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest({int(k): v for k, v in raw["base"].items()}, {int(k): v for k, v in raw["deltas"].items()})


class StateLog:
    """Rows of one schema, spread over ``buckets`` by the hash of ``key``.

    ``merge`` folds rows of one key that several versions hold; it must be free to run on parts
    of them first (the latest of latest ones, distinct rows of distinct ones).
    """

    def __init__(self, path: str, schema: T.StructType, key: str, merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS, compact_every: int = COMPACT_EVERY, kept: int = KEPT) -> None:
        self.root, self.schema, self.key, self.merge = path.rstrip("/"), schema, key, merge
        self.buckets, self.compact_every, self.kept = buckets, compact_every, kept

    # ---------------------------------------------------------- files

    def _fs(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, spark: SparkSession, below: str = "") -> list[str]:
        fs, path = self._fs(spark)
        folder = path(f"{self.root}/{below}".rstrip("/"))
        return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []

    def versions(self, spark: SparkSession) -> list[int]:
        """Batches with a manifest, in order."""
        names = (n.removeprefix("manifest-").removesuffix(".json") for n in self._names(spark) if n.endswith(".json"))
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest-{version:012d}.json"

    def manifest(self, spark: SparkSession, below: int | None = None) -> Manifest:
        """The newest manifest, or the newest of a batch before ``below``."""
        found = [v for v in self.versions(spark) if below is None or v < below]
        return self._read_manifest(spark, found[-1]) if found else Manifest()

    def _read_manifest(self, spark: SparkSession, version: int) -> Manifest:
        fs, path = self._fs(spark)
        jvm = spark.sparkContext._jvm
        stream = fs.open(path(self._manifest_path(version)))
        try:
            return Manifest.from_json(jvm.java.lang.String(stream.readAllBytes(), "UTF-8"))
        finally:
            stream.close()

    def _write_manifest(self, spark: SparkSession, version: int, manifest: Manifest) -> None:
        # Written aside and renamed, so that no reader meets half of one.
        fs, path = self._fs(spark)
        done, aside = path(self._manifest_path(version)), path(self._manifest_path(version) + ".part")
        stream = fs.create(aside, True)
        stream.write(bytearray(manifest.to_json(), "utf-8"))
        stream.close()
        fs.delete(done, False)
        if not fs.rename(aside, done):
            raise OSError(f"{done.toString()} can't be written")

    # ---------------------------------------------------------- rows

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None, below: int | None = None) -> DataFrame:
        """Stored rows (not merged across versions) of some buckets, as of the newest batch before ``below``."""
        return self._rows(spark, self.manifest(spark, below), buckets)

    def _rows(self, spark: SparkSession, manifest: Manifest, buckets: Iterable[int] | None) -> DataFrame:
        wanted = set(range(self.buckets) if buckets is None else buckets)
        folders = [f"{self.root}/base-{v:012d}/bucket={k}" for k, v in sorted(manifest.base.items()) if k in wanted]
        deltas = [f"{self.root}/delta-{v:012d}" for v, held in sorted(manifest.deltas.items()) if wanted.intersection(held)]
        out = spark.createDataFrame([], self.schema)
        if folders:
            out = spark.read.schema(self.schema).parquet(*folders)
        if deltas:
            with_bucket = T.StructType([*self.schema.fields, T.StructField("__bucket", T.IntegerType())])
            new = spark.read.schema(with_bucket).parquet(*deltas)
            if len(wanted) < self.buckets:
                # Deltas are sorted by bucket, so the filter skips their other row groups.
                new = new.where(F.col("__bucket").isin(sorted(wanted)))
            new = new.select(*self.schema.names)
            out = out.unionByName(new) if folders else new
        return out

    # ---------------------------------------------------------- batches

    def commit(self, batch_id: int, rows: DataFrame) -> None:
        """Add ``rows`` as the delta of a batch, fold the deltas when it is time, and remove old versions."""
        spark = rows.sparkSession
        manifest = self.manifest(spark, batch_id)
        delta = f"{self.root}/delta-{batch_id:012d}"
        own = rows.select(*self.schema.names).withColumn("__bucket", self.bucket())
        own.sortWithinPartitions("__bucket").write.mode("overwrite").parquet(delta)
        held = sorted(r[0] for r in spark.read.parquet(delta).select("__bucket").distinct().collect())
        manifest.deltas[batch_id] = held
        if (batch_id + 1) % self.compact_every == 0:
            manifest = self._folded(spark, manifest, batch_id)
        self._write_manifest(spark, batch_id, manifest)
        self._expire(spark, batch_id)

    def _folded(self, spark: SparkSession, manifest: Manifest, version: int) -> Manifest:
        """The manifest after the buckets with deltas have a new base; the others keep theirs."""
        changed = sorted({k for held in manifest.deltas.values() for k in held})
        if not changed:
            return Manifest(manifest.base, {})
        merged = self.merge(self._rows(spark, manifest, changed)).select(*self.schema.names).withColumn("bucket", self.bucket())
        part = F.pmod(F.xxhash64(*self.schema.names), F.lit(FILES_BY_BUCKET))
        merged.repartition("bucket", part).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/base-{version:012d}")
        return Manifest({**manifest.base, **{k: version for k in changed}}, {})

    def _expire(self, spark: SparkSession, newest: int) -> None:
        """Remove manifests before the last few, and the deltas and bucket folders that only they named."""
        fs, path = self._fs(spark)
        versions = self.versions(spark)
        kept = versions[-1 - self.kept :]
        named = [self._read_manifest(spark, v) for v in kept]
        for v in versions[: len(versions) - len(kept)]:
            fs.delete(path(self._manifest_path(v)), False)
        deltas = {v for m in named for v in m.deltas}
        bases = {(v, k) for m in named for k, v in m.base.items()}
        for name in self._names(spark):
            kind, _, version = name.partition("-")
            if not version.isdigit() or int(version) >= newest:
                continue
            if kind == "delta" and int(version) not in deltas:
                fs.delete(path(f"{self.root}/{name}"), True)
            if kind == "base":
                self._expire_base(spark, name, {k for v, k in bases if v == int(version)})

    def _expire_base(self, spark: SparkSession, name: str, live: set[int]) -> None:
        fs, path = self._fs(spark)
        if not live:
            fs.delete(path(f"{self.root}/{name}"), True)
            return
        for child in self._names(spark, name):
            number = child.removeprefix("bucket=")
            if number.isdigit() and int(number) not in live:
                fs.delete(path(f"{self.root}/{name}/{child}"), True)
