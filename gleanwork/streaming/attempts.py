"""Streaming forms of the attempt log: latest state per key and retry budgets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleanwork.operators.attempts import (
    MAX_MODEL_ATTEMPTS,
    MAX_RETRIEVAL_ATTEMPTS,
    MODEL_ATTEMPT_STATUSES,
    exhausted,
    latest_attempts,
)
from gleanwork.operators.ordering import running
from gleanwork.session import materialize, temporary
from gleanwork.streaming.statelog import StateLog

BUDGET_OUTPUT = (
    "custom_id string, seq bigint, status string, attempt_count bigint, model_attempt_count bigint, "
    "retrieval_attempt_count bigint, retry_exhausted boolean"
)


def _latest_log(path: str, schema: T.StructType, **settings: int) -> StateLog:
    return StateLog(path, schema, "custom_id", lambda rows: latest_attempts(rows).select(*schema.names), **settings)


def upsert_latest(state_path: str, **settings: int) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer keeping the latest attempt per key.

    A batch only writes its own latest rows as a delta, so its cost follows the batch, not the
    state; the deltas of changed buckets fold into a new base every ``compact_every`` batches, and
    what was replaced is removed. A repeated batch replaces its own delta, and "latest by seq"
    ignores re-delivered rows. ``settings``: ``buckets``, ``compact_every``, ``kept`` of the log.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _latest_log(state_path, batch.schema, **settings).commit(batch_id, latest_attempts(batch))

    return write


def read_latest(spark, state_path: str, schema: T.StructType) -> DataFrame:
    """Latest attempt per key from the newest manifest: the bases and the deltas after them."""
    log = _latest_log(state_path, schema)
    return log.merge(log.read(spark))


class RetryBudget(StatefulProcessor):
    """Attempt counters per key. A (key, seq) pair seen before is ignored; a late one is counted in.

    The state of a key is its attempts, by ``seq``. When new ones arrive, the key's attempts from the
    first new one on are counted (again) and emitted; of several rows of one pair the last holds.
    """

    def __init__(self, max_model: int, max_retrieval: int) -> None:
        self.max_model, self.max_retrieval = max_model, max_retrieval

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Spelled out: workers have no session to parse a schema string with.
        key = T.StructType([T.StructField("seq", T.LongType())])
        value = T.StructType([T.StructField("status", T.StringType())])
        self.attempts = handle.getMapState("attempts", key, value)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = {k[0]: v[0] for k, v in self.attempts.iterator()}
        arrived = pd.concat(list(rows)).sort_values(["seq", "status"]).drop_duplicates("seq")
        new = arrived[~arrived["seq"].isin(known.keys())]
        if new.empty:
            return
        for seq, status in zip(new["seq"], new["status"]):
            self.attempts.updateValue((int(seq),), (status,))
        table = pd.DataFrame([*known.items(), *zip(new["seq"], new["status"])], columns=["seq", "status"]).sort_values("seq")
        model = table["status"].isin(MODEL_ATTEMPT_STATUSES).cumsum()
        retrieval = (table["status"] == "retrieval_error").cumsum()
        counted = pd.DataFrame(
            {
                "custom_id": key[0],
                "seq": table["seq"].astype("int64"),
                "status": table["status"],
                "attempt_count": range(1, len(table) + 1),
                "model_attempt_count": model,
                "retrieval_attempt_count": retrieval,
                "retry_exhausted": ((table["status"] == "model_error") & (model >= self.max_model))
                | ((table["status"] == "retrieval_error") & (retrieval >= self.max_retrieval)),
            }
        )
        yield counted[counted["seq"] >= new["seq"].min()]

    def close(self) -> None:
        pass


def retry_budgets(
    attempts: DataFrame, max_model: int = MAX_MODEL_ATTEMPTS, max_retrieval: int = MAX_RETRIEVAL_ATTEMPTS
) -> DataFrame:
    """Streaming attempts with their running counters (needs the RocksDB state store).

    Late attempts make rows of higher ``seq`` come again; :func:`read_budgets` keeps the last of each.
    """
    return (
        attempts.select("custom_id", "seq", "status")
        .groupBy("custom_id")
        .transformWithStateInPandas(
            statefulProcessor=RetryBudget(max_model, max_retrieval),
            outputStructType=T.StructType.fromDDL(BUDGET_OUTPUT),
            outputMode="append",
            timeMode="none",
        )
    )


def drain(stream: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a stream over everything available, then stop."""
    query = (
        stream.writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _budget_log(path: str, **settings: int) -> StateLog:
    schema = T.StructType.fromDDL("custom_id string, seq bigint, status string")

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("custom_id", "seq").agg(F.min("status").alias("status"))

    return StateLog(path, schema, "custom_id", merge, **settings)


def budget_batches(
    state_path: str,
    output_path: str,
    max_model: int = MAX_MODEL_ATTEMPTS,
    max_retrieval: int = MAX_RETRIEVAL_ATTEMPTS,
    max_group_rows: int | None = None,
    **settings: int,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` form of :func:`retry_budgets` for logs with very long histories per key.

    The state is the log of ``(custom_id, seq, status)``, split by the hash of the key; a batch
    reads only the buckets its keys fall into. A pair that is stored already is ignored. Attempts
    of a touched key below its first new ``seq`` are only summed; those from there on are counted by
    the skew-safe running sums of the batch operator and written (again), so late arrivals correct
    the rows after them. A repeated batch only sees state older than itself. ``settings``:
    ``buckets``, ``compact_every``, ``kept`` of the log.
    """
    log, out_root = _budget_log(state_path, **settings), output_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        with temporary(batch.sparkSession):
            count(batch.sparkSession, batch, batch_id)

    def count(spark, batch: DataFrame, batch_id: int) -> None:
        arrived = materialize(log.merge(batch).select(*log.schema.names))
        # Pairs of keys that were not seen before need no state, so these rows are all that is read.
        known = log.read(spark, log.touched(arrived), batch_id)
        history = materialize(known.join(arrived.select("custom_id").distinct(), "custom_id", "left_semi"))
        fresh = materialize(arrived.join(history, ["custom_id", "seq"], "left_anti"))
        log.commit(batch_id, fresh)
        first = fresh.groupBy("custom_id").agg(F.min("seq").alias("__first"))
        touched = log.merge(history).join(first, "custom_id")
        model = F.col("status").isin(*MODEL_ATTEMPT_STATUSES).cast("bigint")
        retrieval = (F.col("status") == "retrieval_error").cast("bigint")
        before = (
            touched.where(F.col("seq") < F.col("__first"))
            .groupBy("custom_id")
            .agg(F.count("*").alias("attempts"), F.sum(model).alias("model"), F.sum(retrieval).alias("retrieval"))
        )
        again = touched.where(F.col("seq") > F.col("__first")).select(*log.schema.names).unionByName(fresh)
        counted = running(
            materialize(again), ["custom_id"], ["seq"], {"__model": model, "__retrieval": retrieval}, "__attempts", max_group_rows
        ).join(before, "custom_id", "left")
        result = counted.select(
            "custom_id",
            "seq",
            "status",
            (F.col("__attempts") + F.coalesce("attempts", F.lit(0))).alias("attempt_count"),
            (F.col("__model") + F.coalesce("model", F.lit(0))).alias("model_attempt_count"),
            (F.col("__retrieval") + F.coalesce("retrieval", F.lit(0))).alias("retrieval_attempt_count"),
        )
        result.withColumn(
            "retry_exhausted",
            exhausted(F.col("model_attempt_count"), F.col("retrieval_attempt_count"), max_model, max_retrieval),
        ).write.mode("overwrite").parquet(f"{out_root}/b={batch_id:012d}")

    return write


def read_budgets(spark, output_path: str) -> DataFrame:
    """Counted attempts written batch by batch: of each (custom_id, seq) the row of the last batch."""
    written = spark.read.schema(BUDGET_OUTPUT + ", b bigint").parquet(output_path.rstrip("/"))
    names = [field.split()[0] for field in BUDGET_OUTPUT.split(", ")]
    last = written.groupBy("custom_id", "seq").agg(F.max_by(F.struct(*names), "b").alias("row"))
    return last.select("row.*")


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer with one folder per batch, so a repeated batch replaces itself."""
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/b={batch_id:012d}")

    return write
