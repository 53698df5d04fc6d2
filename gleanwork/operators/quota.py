"""Quota filling in schedule order, review state and the per-stratum ledger.

Screenings carry ``sample_order, round_number, language, repository, status``; quota tables carry
one row per stratum (``language, quota``) and are the only tables broadcast here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.text import strip
from gleanwork.operators.attempts import TERMINAL_SCREENINGS
from gleanwork.operators.ordering import first_k, first_rows, running
from gleanwork.operators.skew import attach
from gleanwork.session import materialize

ORDER_BLOCK = 65_536


def order_block(order: Column | str = "sample_order") -> Column:
    """Bucket of consecutive schedule positions."""
    return F.floor((F.col(order) if isinstance(order, str) else order) / ORDER_BLOCK)


def _names(df: DataFrame, column: str = "repository") -> DataFrame:
    return df.select(F.lower(strip(F.col(column))).alias("__name")).where(F.col("__name") != "").distinct()


def without_names(df: DataFrame, names: DataFrame, column: str = "repository") -> DataFrame:
    """Drop rows whose name occurs in ``names``, ignoring case."""
    return df.withColumn("__name", F.lower(column)).join(_names(names), "__name", "left_anti").drop("__name")


def with_names(df: DataFrame, names: DataFrame, column: str = "repository") -> DataFrame:
    """Keep rows whose name occurs in ``names``, ignoring case."""
    return df.withColumn("__name", F.lower(column)).join(_names(names), "__name", "left_semi").drop("__name")


# Strata that are broadcast at most.
MAX_STRATA = 10_000


def _strata(table: DataFrame, *columns: str) -> DataFrame:
    """Columns of a table of strata for a join on ``language``: broadcast once its size is known to be small.

    Beyond ``MAX_STRATA`` rows the planner chooses, and splits skewed strata while it runs.
    """
    rows = table.select("language", *columns)
    return F.broadcast(rows) if rows.limit(MAX_STRATA + 1).count() <= MAX_STRATA else rows


def selected_by_stratum(
    screenings: DataFrame,
    quotas: DataFrame,
    reviewed: DataFrame | None = None,
    schedule: DataFrame | None = None,
) -> DataFrame:
    """The first positives of every stratum up to its quota, reviewed names left out."""
    positives = screenings.where(F.col("status") == "pass")
    if reviewed is not None:
        positives = without_names(positives, reviewed)
    if schedule is not None:
        positives = positives.join(schedule.select("sample_order"), "sample_order", "left_semi")
    keyed = positives.join(_strata(quotas, "quota"), "language")
    return first_k(keyed, ["language"], order_block(), ["sample_order"], "quota", "__rank").drop("__rank", "quota")


def selected(screenings: DataFrame, limit: int, reviewed: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` positives overall in schedule order."""
    positives = screenings.where(F.col("status") == "pass")
    if reviewed is not None:
        positives = without_names(positives, reviewed)
    return positives.orderBy("sample_order").limit(limit)


def screened_prefix(scheduled: DataFrame, quotas: DataFrame, budget: int | None = None) -> DataFrame:
    """Rows a sequential screening would process before every quota is met.

    Closed form of the wave loop: a row is screened when its stratum had fewer positives than its
    quota in all earlier rounds; with a ``budget``, whole rounds are kept while the running number
    of screened rows fits. ``scheduled`` carries the outcome in ``status``.
    """
    positive = F.coalesce(F.col("status") == "pass", F.lit(False)).cast("bigint")
    counted = running(
        scheduled, ["language"], ["round_number", "sample_order"], {"__positives": positive}
    ).withColumn("__earlier", F.col("__positives") - positive)
    kept = (
        counted.join(_strata(quotas, "quota"), "language")
        .where(F.col("__earlier") < F.col("quota"))
        .drop("__positives", "__earlier", "quota")
    )
    if budget is None:
        return kept
    rounds = kept.groupBy("round_number").agg(F.count("*").alias("__n")).withColumn("__all", F.lit(1))
    # Running count over rounds; the single group is range-split like any other large group.
    fits = running(rounds, ["__all"], ["round_number"], {"__screened": F.col("__n")}).where(
        F.col("__screened") <= budget
    )
    return kept.join(fits.select("round_number"), "round_number", "left_semi")


def next_wave(
    schedule: DataFrame,
    screenings: DataFrame,
    quotas: DataFrame,
    already: DataFrame | None = None,
    budget: int | None = None,
) -> DataFrame:
    """The next round to screen on resume: the first one with open work in a stratum below quota.

    ``already`` names reviewed or carried repositories. A round that would overflow the budget of
    stored screenings yields nothing.
    """
    have = (
        screenings.where(F.col("status") == "pass")
        .join(schedule.select("sample_order"), "sample_order", "left_semi")
    )
    if already is not None:
        have = without_names(have, already)
    counts = have.groupBy("language").agg(F.count("*").alias("__have"))
    active = (
        quotas.join(counts, "language", "left")
        .where(F.coalesce("__have", F.lit(0)) < F.col("quota"))
        .select("language")
    )
    open_rows = schedule.join(_strata(active), "language", "left_semi").join(
        screenings.select("sample_order"), "sample_order", "left_anti"
    )
    if already is not None:
        open_rows = without_names(open_rows, already)
    # One number comes back; the wave itself then filters the schedule by it at the scan.
    first_round = open_rows.agg(F.min("round_number")).first()[0]
    wave = open_rows.where(F.col("round_number") == F.lit(first_round).cast("bigint"))
    if budget is None:
        return wave
    # A round holds at most one row per stratum.
    wave = materialize(wave)
    return wave if screenings.count() + wave.count() <= budget else wave.limit(0)


def carried_names(prior: DataFrame) -> DataFrame:
    """Repositories whose earlier run ended for good."""
    return prior.where(F.col("status").isin(*TERMINAL_SCREENINGS)).select(F.lower("repository").alias("repository")).distinct()


def confirmed_names(*checklists: DataFrame) -> DataFrame:
    """Repositories with a confirmed, non-duplicate file; the first spelling wins.

    Each checklist carries ``row_index``; earlier checklists come first.
    """
    merged = None
    for index, rows in enumerate(checklists):
        duplicate = strip("duplicate_of") if "duplicate_of" in rows.columns else F.lit("")
        part = rows.select(
            strip("repository").alias("repository"),
            strip("human_decision").alias("__decision"),
            F.coalesce(duplicate, F.lit("")).alias("__duplicate"),
            F.lit(index).alias("__source"),
            F.col("row_index").alias("__row"),
        )
        merged = part if merged is None else merged.unionByName(part)
    accepted = merged.where(
        (F.col("__decision") == "pass") & (F.col("repository") != "") & (F.col("__duplicate") == "")
    ).withColumn("name_key", F.lower("repository"))
    return first_rows(accepted, ["name_key"], ["__source", "__row"], ["repository"])


def counts_by_stratum(names: DataFrame, rows: DataFrame, name: str, language: str) -> DataFrame:
    """How many of ``names`` fall in each stratum of ``rows``."""
    lookup = rows.select(F.lower(name).alias("__name"), F.col(language).alias("language")).distinct()
    return _names(names).join(lookup, "__name").groupBy("language").agg(F.count("*").alias("repositories"))


def eligible_names(population: DataFrame, allowlist: DataFrame | None) -> DataFrame:
    """Lower-cased names allowed by licence; every name while no allow-list was reviewed."""
    rows = population if allowlist is None else allowed(population, allowlist, "license")
    return rows.select(F.lower("name").alias("repository")).distinct()


def allowlist_names(rows: DataFrame) -> DataFrame:
    """Trimmed, non-blank licence names; the ambiguous name never counts."""
    name = strip("license_name")
    return rows.select(name.alias("license_name")).where((name != "") & (F.lower(name) != "other")).distinct()


def allowed(rows: DataFrame, allowlist: DataFrame, column: str = "license_name") -> DataFrame:
    """Rows whose trimmed licence is on the list, compared with case."""
    return (
        rows.withColumn("__license", strip(column))
        .join(allowlist_names(allowlist).select(F.col("license_name").alias("__license")), "__license", "left_semi")
        .drop("__license")
    )


def rejected(rows: DataFrame, allowlist: DataFrame, column: str = "license_name") -> DataFrame:
    """The complement of :func:`allowed`."""
    return (
        rows.withColumn("__license", strip(column))
        .join(allowlist_names(allowlist).select(F.col("license_name").alias("__license")), "__license", "left_anti")
        .drop("__license")
    )


def license_totals(selected: DataFrame) -> DataFrame:
    """One-row counts of the licence names of a selection."""
    name = strip("license_name")
    return selected.agg(
        F.count("*").alias("repositories"),
        F.count_distinct("license_name").alias("license_names"),
        F.count_if(name == "").alias("blank_license_repositories"),
        F.count_if(F.lower(name) == "other").alias("other_license_repositories"),
    )


def allowlist_totals(rows: DataFrame, allowlist: DataFrame) -> DataFrame:
    """One-row counts after applying the allow-list."""
    names = allowlist_names(allowlist)
    return rows.agg(F.count("*").alias("input_repositories")).select(
        "input_repositories",
        F.lit(allowed(rows, allowlist).agg(F.count("*")).scalar()).alias("accepted_repositories"),
        (F.col("input_repositories") - allowed(rows, allowlist).agg(F.count("*")).scalar()).alias("rejected_repositories"),
        F.lit(names.agg(F.count("*")).scalar()).alias("allowlisted_license_names"),
    )


def review_by_eligibility(reviewed: DataFrame, eligible: DataFrame) -> DataFrame:
    """Mark reviewed names as eligible or not; ``dropped`` flags acceptances lost to the policy.

    ``reviewed``: ``repository, state`` with state ``baseline``, ``confirmed`` or ``rejected``.
    """
    ok = _names(eligible).withColumn("eligible", F.lit(True))
    return (
        reviewed.select(F.lower(strip("repository")).alias("__name"), "state")
        .distinct()
        .join(ok, "__name", "left")
        .select(
            F.col("__name").alias("repository"),
            "state",
            F.col("eligible").isNotNull().alias("eligible"),
            (F.col("eligible").isNull() & F.col("state").isin("baseline", "confirmed")).alias("dropped"),
        )
    )


def selected_repositories(
    baseline: DataFrame, confirmed: DataFrame, pending: DataFrame, schedule: DataFrame, population: DataFrame
) -> DataFrame:
    """Final selection with origin: baseline names with looked-up metadata, then confirmed, then pending."""
    meta = first_rows(
        population.select(F.lower("name").alias("__name"), "lastCommitSHA", "mainLanguage", "license", "input_index"),
        ["__name"],
        [-F.col("input_index")],
    )
    base = (
        baseline.withColumn("__name", F.lower("repository"))
        .join(meta, "__name", "left")
        .select(
            "repository",
            F.coalesce("lastCommitSHA", F.lit("")).alias("revision"),
            F.coalesce("mainLanguage", F.lit("")).alias("sampling_language"),
            F.coalesce("license", F.lit("")).alias("license_name"),
            F.lit("baseline").alias("origin"),
            F.lit(None).cast("bigint").alias("sample_order"),
        )
    )

    def rows(source: DataFrame, origin: str) -> DataFrame:
        return source.select(
            "repository", "revision", F.col("language").alias("sampling_language"), "license_name",
            F.lit(origin).alias("origin"), "sample_order",
        )

    return (
        base.unionByName(rows(with_names(schedule, confirmed), "new_confirmed"))
        .unionByName(rows(pending, "new_pending"))
    )


def ledger(quotas: DataFrame, baseline: DataFrame, confirmed: DataFrame, pending: DataFrame) -> DataFrame:
    """Per stratum: target, baseline, confirmed, pending, selected and remaining.

    ``quotas``: ``language, target``; the other inputs have one ``language`` row per repository.
    """
    def counts(source: DataFrame, name: str) -> DataFrame:
        return source.groupBy("language").agg(F.count("*").alias(name))

    joined = quotas.select("language", "target")
    for source, name in ((baseline, "baseline"), (confirmed, "confirmed"), (pending, "pending")):
        joined = joined.join(counts(source, name), "language", "left")
    joined = joined.fillna(0, ["baseline", "confirmed", "pending"])
    picked = F.col("baseline") + F.col("confirmed") + F.col("pending")
    return joined.withColumns({"selected": picked, "remaining": F.col("target") - picked})


def collection_report(ledger_rows: DataFrame, license_policy_applied: bool) -> DataFrame:
    """One-row totals, target flags and workflow stage."""
    totals = ledger_rows.agg(
        F.sum("target").alias("target_total"),
        F.sum("baseline").alias("baseline_repositories"),
        F.sum(F.col("target") - F.col("baseline")).alias("new_repository_target"),
        F.sum("confirmed").alias("confirmed_new_repositories"),
        F.sum("pending").alias("pending_new_repositories"),
        F.sum("selected").alias("selected_total_repositories"),
        F.every(F.col("remaining") == 0).alias("target_reached"),
        F.every(F.col("baseline") + F.col("confirmed") >= F.col("target")).alias("human_target_reached"),
    )
    return totals.withColumn(
        "workflow_stage",
        workflow_stage(F.lit(license_policy_applied), F.col("target_reached"), F.col("human_target_reached")),
    ).withColumn("next_action", next_action("workflow_stage"))


def workflow_stage(policy_applied: Column, target_reached: Column, human_target_reached: Column) -> Column:
    """Stage of a collection from three durable facts."""
    return (
        F.when(~policy_applied & target_reached, "needs_license_review")
        .when(~policy_applied, "provisional_screening")
        .when(human_target_reached, "ready_to_finalize")
        .when(~target_reached, "needs_replenishment")
        .otherwise("needs_file_review")
    )


# The operation each stage permits.
NEXT_ACTIONS = {
    "provisional_screening": "resume provisional repository screening",
    "needs_license_review": "prepare and apply the license allowlist",
    "needs_replenishment": "resume eligible repository screening",
    "needs_file_review": "complete the exported file review checklist",
    "ready_to_finalize": "finalize the guideline collection",
}


def next_action(stage: Column | str) -> Column:
    value = F.col(stage) if isinstance(stage, str) else stage
    action = F.when(F.lit(False), F.lit(""))
    for name, text in NEXT_ACTIONS.items():
        action = action.when(value == name, text)
    return action


def population_profile(population: DataFrame) -> DataFrame:
    """Rows, distinct revisions and rows per stratum in one pass over the keys."""
    return population.groupBy("mainLanguage").agg(
        F.count("*").alias("repositories"),
        F.count_distinct("lastCommitSHA").alias("distinct_revisions"),
    )


def file_records(attempts: DataFrame, schedule: DataFrame, selected_names: DataFrame) -> DataFrame:
    """Annotate every file attempt with its schedule position and whether its repository is selected."""
    chosen = _names(selected_names).withColumn("__selected", F.lit(True))
    facts = (
        schedule.select("sample_order", "round_number", "language", "repository")
        .withColumn("__name", F.lower("repository"))
        .join(chosen, "__name", "left")
        .select(
            "sample_order",
            "round_number",
            F.col("language").alias("sampling_language"),
            F.col("__selected").isNotNull().alias("selected_repository"),
        )
    )
    return attach(attempts, facts, ["sample_order"], how="inner")


def needs_review(scheduled: DataFrame) -> DataFrame:
    """Scheduled repositories whose screening left no outcome."""
    return scheduled.where(F.col("status") == "unresolved")
