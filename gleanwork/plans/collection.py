"""Repository-level plans: schedule, select, report, finalise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import strip
from gleanwork.operators import evaluate, gates, publish, quota, review, sampling
from gleanwork.session import materialize


@dataclass(frozen=True)
class Collection:
    """Tables of one collection state."""

    schedule: DataFrame
    pending: DataFrame
    next_wave: DataFrame
    ledger: DataFrame
    report: DataFrame
    selected: DataFrame


def eligible_schedule(
    population: DataFrame,
    languages: Sequence[str],
    seed: int,
    excluded: DataFrame | None = None,
    allowlist: DataFrame | None = None,
) -> DataFrame:
    """Draw the full schedule first, then thin it by licence; positions never move."""
    drawn = sampling.schedule(population, languages, seed, excluded).select(
        "sample_order",
        "round_number",
        F.col("sampling_language").alias("language"),
        "language_population",
        F.col("name").alias("repository"),
        F.col("lastCommitSHA").alias("revision"),
        strip("license").alias("license_name"),
        "source_file",
        "input_index",
    )
    return materialize(quota.with_names(drawn, quota.eligible_names(population, allowlist)))


# Columns that identify a schedule position; a manifest also lists the licence-free part of it.
SCREENING_IDENTITY = ("round_number", "language", "repository", "revision")


def carried_screenings(
    screenings: DataFrame,
    manifest: DataFrame,
    settings: DataFrame,
    schedule: DataFrame,
    current_settings: DataFrame,
    eligible: DataFrame | None = None,
) -> DataFrame:
    """Screenings of an earlier run that count for this one; raises when the runs don't fit together.

    ``schedule`` is the complete schedule, before eligibility. Every earlier screening and every
    row of the earlier ``manifest`` must stand at the same position of it, the manifest must cover
    it, and sampling and classification settings must agree (fingerprints whatever their paths).
    ``eligible``: ``repository``; screenings of other repositories are left out.
    """
    gates.require_empty(gates.schedule_mismatch(screenings, schedule, SCREENING_IDENTITY))
    gates.require_empty(gates.schedule_mismatch(manifest, schedule, SCREENING_IDENTITY))
    gates.require_empty(gates.schedule_mismatch(schedule, manifest, SCREENING_IDENTITY))
    gates.require_empty(gates.incompatible_prior(settings, current_settings))
    return screenings if eligible is None else quota.with_names(screenings, eligible)


def collection_state(
    population: DataFrame,
    schedule: DataFrame,
    screenings: DataFrame,
    baseline: DataFrame,
    reviewed: DataFrame,
    targets: DataFrame,
    license_policy_applied: bool,
    prior: DataFrame | None = None,
    budget: int | None = None,
) -> Collection:
    """Where a collection stands: pending positives, next wave, ledger and stage.

    ``baseline``: ``repository``; ``reviewed``: ``repository, state``; ``targets``:
    ``language, target`` with one row per stratum; ``prior``: what :func:`carried_screenings`
    returned. Raises when reviews and screenings contradict each other.
    """
    gates.require_empty(gates.review_consistency(reviewed, screenings, prior))

    def by_language(names: DataFrame, rows: DataFrame, name: str, language: str) -> DataFrame:
        return quota.with_names(rows.select(name, F.col(language).alias("language")).distinct(), names, name)

    confirmed = reviewed.where(F.col("state") == "confirmed").select("repository")
    base = by_language(baseline, population, "name", "mainLanguage")
    chosen = by_language(confirmed, schedule, "repository", "language")
    empty = schedule.select("language").limit(0)
    before = quota.ledger(targets, base, chosen, empty)
    quotas = materialize(before.select("language", F.greatest("remaining", F.lit(0)).alias("quota")))
    pending = quota.selected_by_stratum(screenings, quotas, reviewed, schedule)
    already = reviewed.select("repository")
    if prior is not None:
        already = already.unionByName(quota.carried_names(prior))
    rows = quota.ledger(targets, base, chosen, pending)
    return Collection(
        schedule=schedule,
        pending=pending,
        next_wave=quota.next_wave(schedule, screenings, quotas, already, budget),
        ledger=rows,
        report=quota.collection_report(rows, license_policy_applied),
        selected=quota.selected_repositories(baseline, confirmed, pending, schedule, population),
    )


def next_review(existing: DataFrame, exported: DataFrame, starts_next: bool) -> DataFrame:
    """The checklist of the next review round."""
    origin = review.next_round(existing, starts_next).first()["review_origin"]
    return review.merge_checklist(existing, exported, origin)


@dataclass(frozen=True)
class Bundle:
    """Published tables."""

    repositories: DataFrame
    files: DataFrame
    totals: DataFrame


def finalize(
    selected: DataFrame,
    checklists: Mapping[str, DataFrame],
    targets: DataFrame,
    allowlist: DataFrame,
    baseline: DataFrame,
    ineligible: DataFrame | None = None,
) -> Bundle:
    """Check every invariant first; only a clean bundle is returned."""
    for rows in checklists.values():
        whole = rows if "duplicate_of" in rows.columns else rows.withColumn("duplicate_of", F.lit(""))
        gates.require_empty(gates.checklist_integrity(whole))
    accepted = materialize(publish.accepted_files(checklists, ineligible))
    gates.require_empty(gates.final_bundle(selected, accepted, accepted, targets, allowlist, baseline))
    files = publish.guideline_rows(accepted, selected)
    return Bundle(publish.repository_rows(selected, files), files, publish.final_totals(selected, files))


@dataclass(frozen=True)
class Evaluation:
    """Tables of one label evaluation."""

    files: DataFrame
    metrics: DataFrame
    matrix: DataFrame
    repositories: DataFrame
    scope: DataFrame


def evaluate_labels(checklist: DataFrame, predictions: DataFrame) -> Evaluation:
    """Model labels against human decisions; the joined rows are written once for all reports."""
    gates.require_empty(
        gates.value_domain(checklist, "human_decision", ("", "pass", "not_found"), "github_url", "human_decision")
    )
    gates.require_empty(gates.duplicate_keys(predictions, strip("markdown_url"), "duplicate_url"))
    files = materialize(evaluate.evaluated_files(checklist, predictions))
    return Evaluation(
        files=files,
        metrics=evaluate.binary_metrics(files, evaluate.labeled_count(checklist)),
        matrix=evaluate.decision_matrix(files),
        repositories=evaluate.worst_first(evaluate.repository_metrics(files)),
        scope=evaluate.repository_scope(files),
    )
