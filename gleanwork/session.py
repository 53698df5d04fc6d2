"""Session settings and shared-folder materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "gleanwork", cpus: str | int = "*", **conf: object) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a machine-local
    folder would vanish with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="gleanwork-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def wide_partitions(spark: SparkSession) -> int:
    """Partitions for explicit range splits and salts: the shuffle setting, at least one per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _intermediates(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/gleanwork/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> bool:
    """Remove what this application's ``materialize`` calls wrote; whether there was anything.

    For the end of a flow, after its results are written elsewhere: frames that read the
    intermediates fail from then on. Other applications sharing the folder keep theirs.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_intermediates(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Copies written inside the innermost ``temporary`` of this thread.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove, at its end, what ``materialize`` calls of this thread wrote inside: for steps of a stream that never ends."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for name in paths:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: object, default: str | None = None) -> Iterator[None]:
    before = spark.conf.get(key) if default is None else spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Inside, rows go to Python in Arrow batches of about ``size`` bytes; for actions, since a plan takes this when it is made."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, the shuffle files of a ``materialize`` call go when it ends, not when the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", True, "false")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage.

    Column pruning still works on the copy, and a lost executor re-reads it instead of
    recomputing (and possibly re-sampling) the plan behind it. ``release`` removes the copies.
    """
    spark = df.sparkSession
    path = f"{_intermediates(spark)}/{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
