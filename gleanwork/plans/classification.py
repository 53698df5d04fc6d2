"""File-level plans: extract candidates, classify the open ones, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions import paths, terms
from gleanwork.functions.labels import COST, Rates
from gleanwork.functions.terms import Term
from gleanwork.operators import attempts, costs, dedup, files, gates, scoring
from gleanwork.operators.ordering import dense_index
from gleanwork.session import materialize


@dataclass(frozen=True)
class Extraction:
    """Tables of one candidate extraction."""

    candidates: DataFrame
    unique: DataFrame
    occurrences: DataFrame
    conflicts: DataFrame
    dedup_summary: DataFrame
    coverage: DataFrame
    audit: DataFrame
    skipped: DataFrame


def extract_candidates(
    entries: DataFrame,
    contents: DataFrame,
    repositories: DataFrame,
    evidence: DataFrame,
    filename_terms: Sequence[Term] = terms.FILENAME_TERMS,
    content_terms: Sequence[Term] = terms.CONTENT_TERMS,
) -> Extraction:
    """Two-stage filter, exact dedup and coverage over every completed repository.

    The screened table is written once; all reports read it, never the bodies again.
    """
    done = repositories.where(F.col("status") == "completed").select(
        F.col("name").alias("repository"), F.col("lastCommitSHA").alias("revision")
    )
    open_entries = entries.join(done, ["repository", "revision"], "left_semi")
    screened = materialize(files.screen_files(open_entries, contents, filename_terms, content_terms))
    # Stored as well: five reports read it.
    candidates = materialize(files.candidate_files(screened, evidence))
    coverage = files.evidence_coverage(evidence, screened, repositories)
    return Extraction(
        candidates=candidates,
        unique=dedup.canonical_rows(candidates),
        occurrences=dedup.occurrences(candidates),
        conflicts=dedup.occurrences(candidates, conflicts_only=True),
        dedup_summary=dedup.dedup_summary(candidates),
        coverage=coverage,
        audit=files.repository_audit(repositories, screened, coverage),
        skipped=files.skipped_repositories(repositories),
    )


def classify_candidates(
    unique: DataFrame,
    contents: DataFrame,
    gate: DataFrame,
    log: DataFrame,
    scorer: scoring.Scorer,
    rates: Rates,
    model: str,
    effort: str = "high",
    max_output_tokens: int = 4_000,
    max_input_bytes: int = 200_000,
    max_model: int = attempts.MAX_MODEL_ATTEMPTS,
    max_retrieval: int = attempts.MAX_RETRIEVAL_ATTEMPTS,
) -> DataFrame:
    """New attempt rows: skips of closed repositories, content errors, and scored files.

    Only files without a completed outcome are read and scored. Scoring runs once: its answers
    are written before the rows that depend on them are derived.
    """
    identified = unique.withColumn(
        "custom_id", paths.stable_id("name", "lastCommitSHA", "markdown_path", "blob_sha")
    )
    state = attempts.attempt_state(log, max_model, max_retrieval)
    ready, skipped = attempts.split_by_gate(identified, gate, attempts.completed(state))
    # Bodies are looked up once; requests, quote checks and error rows all read this copy.
    fetched = materialize(files.candidate_contents(ready, contents, max_input_bytes))
    sendable = fetched.where(F.col("error_status").isNull())
    requests = costs.requests(sendable, model, effort, max_output_tokens)
    answers = materialize(scoring.parsed_answers(scoring.score(requests, scorer)))
    manifest = sendable.select(*identified.columns)
    results = costs.result_rows(
        manifest,
        answers.where(F.col("response").isNotNull()),
        answers.where(F.col("error").isNotNull()),
        sendable.select("custom_id", "content"),
        rates,
    )
    blank = {
        "model_label": F.lit(""),
        "model_reason": F.lit(""),
        "quote": F.lit(""),
        "confidence": F.lit(0),
        **{name: F.lit(0).cast("bigint") for name in (*costs.TOKEN_COLUMNS, "total_tokens")},
        "cost_usd": F.lit(0).cast(COST),
    }
    errors = (
        fetched.where(F.col("error_status").isNotNull())
        .withColumnsRenamed({"error_status": "status", "error": "reason"})
        .drop("content")
        .withColumns(blank)
    )
    rows = results.unionByName(errors).unionByName(skipped.withColumns(blank))
    numbered = dense_index(rows, ["custom_id"], "__n", start=1)
    last = F.coalesce(log.agg(F.max("seq")).scalar(), F.lit(0))
    return numbered.withColumn("seq", last + F.col("__n")).drop("__n")


@dataclass(frozen=True)
class FileReports:
    """Reports over one attempt log."""

    latest: DataFrame
    cost: DataFrame
    repositories: DataFrame
    statuses: DataFrame


def report_files(log: DataFrame, audit: DataFrame, gate: DataFrame | None = None) -> FileReports:
    """Latest outcomes, costs, repository roll-up and status counts from the log alone."""
    latest = attempts.attempt_state(log)
    summary = audit.withColumnRenamed("markdown_filename_and_content_file_count", "candidate_file_count")
    return FileReports(
        latest=latest,
        cost=costs.cost_report(latest),
        repositories=costs.repository_rollup(summary, latest, gate),
        statuses=costs.status_histogram(latest),
    )


def check_candidates(rows: DataFrame) -> None:
    """Fail when one path of a revision names two blobs."""
    gates.require_empty(gates.conflicting_candidates(rows))
