"""Attempt-log replay: latest outcome, retry budgets, pending work.

An attempt row has ``custom_id``, ``status`` and ``seq`` (its append order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.operators.ordering import last_rows, running
from gleanwork.operators.skew import attach

# Status families of the attempt log.
RETRYABLE_STATUSES = ("model_error", "retrieval_error", "snapshot_incomplete")
CLASSIFIED_STATUSES = ("not_found", "pass", "review")
MODEL_ATTEMPT_STATUSES = (*CLASSIFIED_STATUSES, "model_error")
SKIPPED_STATUSES = ("explicitly_excluded", "snapshot_incomplete")
TERMINAL_SCREENINGS = ("pass", "not_found", "no_candidates")
MAX_MODEL_ATTEMPTS, MAX_RETRIEVAL_ATTEMPTS, MAX_REPOSITORY_ATTEMPTS = 3, 2, 3


def latest_attempts(log: DataFrame, key: str = "custom_id", seq: str = "seq") -> DataFrame:
    """The last appended attempt of every key."""
    return last_rows(log, [key], [seq])


def exhausted(model_attempts: Column, retrieval_attempts: Column, max_model: int, max_retrieval: int) -> Column:
    """Whether an attempt's status used up its own budget."""
    status = F.col("status")
    return ((status == "model_error") & (model_attempts >= max_model)) | (
        (status == "retrieval_error") & (retrieval_attempts >= max_retrieval)
    )


def replay(
    log: DataFrame,
    max_model: int = MAX_MODEL_ATTEMPTS,
    max_retrieval: int = MAX_RETRIEVAL_ATTEMPTS,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Recompute every attempt's counters from the log; stored counters are ignored."""
    counted = running(
        log.drop("attempt_count", "model_attempt_count", "retrieval_attempt_count", "retry_exhausted"),
        ["custom_id"],
        ["seq"],
        {
            "model_attempt_count": F.col("status").isin(*MODEL_ATTEMPT_STATUSES).cast("bigint"),
            "retrieval_attempt_count": (F.col("status") == "retrieval_error").cast("bigint"),
        },
        rank="attempt_count",
        max_group_rows=max_group_rows,
    )
    return counted.withColumn(
        "retry_exhausted",
        exhausted(F.col("model_attempt_count"), F.col("retrieval_attempt_count"), max_model, max_retrieval),
    )


def attempt_state(
    log: DataFrame, max_model: int = MAX_MODEL_ATTEMPTS, max_retrieval: int = MAX_RETRIEVAL_ATTEMPTS
) -> DataFrame:
    """Latest attempt with its final counters: one aggregate, no window.

    Final counters are plain counts, so the whole history collapses map-side.
    """
    kept = [c for c in log.columns if c not in ("custom_id",)]
    state = log.groupBy("custom_id").agg(
        F.max_by(F.struct(*kept), F.col("seq")).alias("__row"),
        F.count("*").alias("attempt_count"),
        F.count_if(F.col("status").isin(*MODEL_ATTEMPT_STATUSES)).alias("model_attempt_count"),
        F.count_if(F.col("status") == "retrieval_error").alias("retrieval_attempt_count"),
    )
    flat = state.select(
        "custom_id",
        *(F.col(f"__row.`{c}`").alias(c) for c in kept),
        "attempt_count",
        "model_attempt_count",
        "retrieval_attempt_count",
    )
    return flat.withColumn(
        "retry_exhausted",
        exhausted(F.col("model_attempt_count"), F.col("retrieval_attempt_count"), max_model, max_retrieval),
    )


def completed(state: DataFrame) -> DataFrame:
    """Keys that need no retry."""
    return state.where(~F.col("status").isin(*RETRYABLE_STATUSES) | F.col("retry_exhausted"))


def pending(requested: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Requested work without a completed outcome."""
    return requested.join(done.select(*key), key, "left_anti")


def retryable_files(state: DataFrame) -> DataFrame:
    """Latest model or retrieval errors whose stored budget is not used up."""
    return state.where(F.col("status").isin("model_error", "retrieval_error") & ~F.col("retry_exhausted"))


def retryable_repositories(
    screenings: DataFrame, file_state: DataFrame, max_attempts: int = MAX_REPOSITORY_ATTEMPTS
) -> DataFrame:
    """Screenings to run again: those with retryable files, else unresolved ones within their own budget."""
    again = retryable_files(file_state).select("sample_order").distinct().withColumn("__files", F.lit(True))
    errors = F.col("model_error_count") + F.col("retrieval_error_count") + F.col("input_too_large_count")
    own = (
        (F.col("status") == "unresolved")
        & (errors == 0)
        & F.col("retryable")
        & (F.col("attempt_count") < max_attempts)
    )
    return (
        screenings.join(again, "sample_order", "left").where(F.col("__files").isNotNull() | own).drop("__files")
    )


def repository_gate(
    sources: DataFrame, exclusions: DataFrame | None = None, snapshots: DataFrame | None = None
) -> DataFrame:
    """``ready`` or a skip reason per repository, by priority: excluded, failed, incomplete.

    ``sources``: ``name, lastCommitSHA, status, error``; ``exclusions``: ``name``;
    ``snapshots``: ``name, lastCommitSHA, state, detail, complete``. A repository without an
    inspected snapshot counts as incomplete once ``snapshots`` is given.
    """
    gated = sources
    excluded = F.lit(False)
    if exclusions is not None:
        names = exclusions.select(F.lower("name").alias("__name")).distinct().withColumn("__out", F.lit(True))
        gated = gated.withColumn("__name", F.lower("name")).join(names, "__name", "left").drop("__name")
        excluded = F.col("__out").isNotNull()
    state = F.when(excluded, "explicitly_excluded").when(F.col("status") != "completed", F.col("status"))
    reason = F.when(excluded, "explicitly_excluded").when(F.col("status") != "completed", F.col("error"))
    if snapshots is not None:
        seen = snapshots.select("name", "lastCommitSHA", "state", "detail", "complete")
        gated = gated.join(seen, ["name", "lastCommitSHA"], "left")
        broken = ~F.coalesce("complete", F.lit(False))
        text = F.concat_ws(": ", F.coalesce("state", F.lit("missing")), F.nullif(F.col("detail"), F.lit("")))
        state = state.when(broken, "snapshot_incomplete")
        reason = reason.when(broken, text)
    return gated.select(
        "name",
        "lastCommitSHA",
        F.coalesce(state, F.lit("ready")).alias("gate"),
        F.coalesce(reason, F.lit("")).alias("gate_reason"),
    )


def retryable(rows: DataFrame) -> DataFrame:
    """Attempts whose status allows another try."""
    return rows.where(F.col("status").isin(*RETRYABLE_STATUSES))


def split_by_gate(candidates: DataFrame, gate: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates to classify, and skip records inherited from their repository.

    An explicitly excluded file that already has an outcome keeps it.
    """
    marked = attach(candidates, gate, ["name", "lastCommitSHA"], how="inner").join(
        done.select("custom_id", F.lit(True).alias("__done")), "custom_id", "left"
    )
    finished = F.col("__done").isNotNull()
    ready = marked.where((F.col("gate") == "ready") & ~finished).select(*candidates.columns)
    skipped = marked.where(
        (F.col("gate") != "ready") & ~((F.col("gate") == "explicitly_excluded") & finished)
    ).select(*candidates.columns, F.col("gate").alias("status"), F.col("gate_reason").alias("reason"))
    return ready, skipped
