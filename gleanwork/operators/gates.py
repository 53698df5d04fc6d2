"""Data-quality gates. Each returns violations ``(rule, key, detail)``; an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwork.functions import paths
from gleanwork.functions.labels import final_origin
from gleanwork.functions.text import strip
from gleanwork.operators.attempts import TERMINAL_SCREENINGS
from gleanwork.operators.quota import allowlist_names
from gleanwork.operators.skew import attach
from gleanwork.session import materialize

# Population rules.
REPOSITORY_PATTERN = r"^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$"
REVISION_PATTERN = r"^[0-9a-fA-F]{7,64}$"
COMMIT_PATTERN = r"^[0-9a-fA-F]{40}$"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
SNAPSHOT_START = "2026-01-01T00:00:00Z"
LANGUAGES = ("Java", "JavaScript", "Python", "TypeScript")
MINIMUMS = {"stargazers": 1000, "totalIssues": 200, "totalPullRequests": 200, "forks": 200, "contributors": 10}


def violations(df: DataFrame, rule: str | Column, key: Column | str, detail: Column | str) -> DataFrame:
    """Shape rows as violations."""
    rule = F.lit(rule) if isinstance(rule, str) else rule
    key = F.col(key) if isinstance(key, str) else key
    detail = F.col(detail) if isinstance(detail, str) else detail
    return df.select(
        rule.alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")
    )


def union_all(*parts: DataFrame) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def require_empty(found: DataFrame) -> None:
    """Raise with the first violations when a gate failed; reads at most five rows."""
    rows = found.limit(5).collect()
    if rows:
        raise ValueError("; ".join(f"{r['rule']}: {r['key']}: {r['detail']}" for r in rows))


def _broken(df: DataFrame, key: Column, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One violation row per failing check, in one pass: ``checks`` maps rule → (ok, detail)."""
    found = F.array_compact(
        F.array(
            *(
                F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
                for rule, (ok, detail) in checks.items()
            )
        )
    )
    return df.select(key.alias("key"), F.explode(found).alias("v")).select("v.rule", "key", "v.detail")


def utc_timestamp(column: str) -> Column:
    """ISO 8601 text as a timestamp, null when malformed; without an offset it is UTC in any session zone."""
    text = F.col(column)
    zoned = (
        F.when(text.rlike(r"(Z|[+-]\d{2}:\d{2})$"), text)
        .when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.when(text.rlike(TIMESTAMP_PATTERN), zoned.try_cast("timestamp"))


def population_format(population: DataFrame, enforce_window: bool = True) -> DataFrame:
    """Name, revision and snapshot rules of every population row."""
    committed = utc_timestamp("lastCommit")
    checks = {
        "name_format": (strip("name").rlike(REPOSITORY_PATTERN), F.col("name")),
        "revision_format": (strip("lastCommitSHA").rlike(REVISION_PATTERN), F.col("lastCommitSHA")),
        "timestamp_format": (committed.isNotNull(), F.col("lastCommit")),
    }
    if enforce_window:
        inside = committed.isNull() | (committed >= F.lit(SNAPSHOT_START).cast("timestamp"))
        checks["snapshot_window"] = (inside, F.col("lastCommit"))
    return _broken(population, F.col("name"), checks)


def selection_criteria(
    population: DataFrame, minimums: Mapping[str, int] = MINIMUMS, languages: Sequence[str] = LANGUAGES
) -> DataFrame:
    """All violations of the collection criteria, not only the first."""
    checks = {
        "language": (strip("mainLanguage").isin(*languages), F.col("mainLanguage")),
        "is_fork": (F.lower(strip("isFork")) == "false", F.col("isFork")),
    }
    for field, minimum in minimums.items():
        number = strip(field).try_cast("bigint")
        checks[f"{field}_integer"] = (number.isNotNull(), F.col(field))
        checks[f"{field}_minimum"] = (number.isNull() | (number >= minimum), F.col(field))
    return union_all(
        _broken(population, F.col("name"), checks),
        missing_strata(population, "mainLanguage", languages),
        duplicate_keys(population, F.lower("name"), "duplicate_repository"),
    )


def duplicate_keys(df: DataFrame, key: Column | str, rule: str = "duplicate_key") -> DataFrame:
    """Non-blank keys that occur more than once."""
    key = F.col(key) if isinstance(key, str) else key
    counted = df.groupBy(key.alias("__key")).agg(F.count("*").alias("__n"))
    return violations(counted.where((F.col("__n") > 1) & (F.col("__key") != "")), rule, "__key", "__n")


def unique_keys(df: DataFrame, key: Column | str, rule: str = "unique_key") -> DataFrame:
    """Repeated or blank keys."""
    key = F.col(key) if isinstance(key, str) else key
    counted = df.groupBy(F.coalesce(key.cast("string"), F.lit("")).alias("__key")).agg(F.count("*").alias("__n"))
    broken = counted.where((F.col("__key") == "") | (F.col("__n") > 1))
    return violations(
        broken, F.when(F.col("__key") == "", f"{rule}_blank").otherwise(f"{rule}_duplicate"), "__key", "__n"
    )


def value_domain(df: DataFrame, column: str, allowed_values: Sequence[str], key: Column | str, rule: str) -> DataFrame:
    """Values outside a fixed domain; null counts as outside."""
    outside = ~F.coalesce(strip(F.col(column).cast("string")).isin(*allowed_values), F.lit(False))
    return violations(df.where(outside), rule, key, column)


def missing_strata(df: DataFrame, column: str, strata: Sequence[str], minimum: int = 1) -> DataFrame:
    """Declared strata with fewer than ``minimum`` rows."""
    wanted = df.sparkSession.createDataFrame([(s,) for s in strata], "stratum string")
    counts = df.groupBy(F.col(column).alias("stratum")).agg(F.count("*").alias("__n"))
    short = wanted.join(counts, "stratum", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    return violations(short.where(F.col("__n") < minimum), "missing_stratum", "stratum", "__n")


def uncovered_deficits(schedule: DataFrame, quotas: DataFrame, baseline: DataFrame) -> DataFrame:
    """Strata still below target without any scheduled candidate."""
    have = baseline.groupBy("language").agg(F.count("*").alias("__have"))
    scheduled = schedule.select("language").distinct().withColumn("__scheduled", F.lit(True))
    rows = (
        quotas.join(have, "language", "left")
        .join(scheduled, "language", "left")
        .where((F.coalesce("__have", F.lit(0)) < F.col("target")) & F.col("__scheduled").isNull())
    )
    return violations(rows, "uncovered_deficit", "language", "target")


def conflicting_candidates(candidates: DataFrame) -> DataFrame:
    """One path of a revision with more than one blob."""
    grouped = candidates.groupBy("name", "lastCommitSHA", "markdown_path").agg(
        F.count_distinct("blob_sha").alias("__blobs")
    )
    return violations(
        grouped.where(F.col("__blobs") > 1),
        "conflicting_candidate",
        F.concat_ws(":", "name", "lastCommitSHA", "markdown_path"),
        "__blobs",
    )


def conflicting_strata(population: DataFrame) -> DataFrame:
    """One name (ignoring case) in more than one stratum."""
    grouped = population.groupBy(F.lower("name").alias("__name")).agg(F.count_distinct("mainLanguage").alias("__n"))
    return violations(grouped.where(F.col("__n") > 1), "conflicting_stratum", "__name", "__n")


def empty_input(rows: DataFrame, rule: str, key: str) -> DataFrame:
    """A selection that left no rows."""
    counted = rows.agg(F.count("*").alias("__n"))
    return violations(counted.where(F.col("__n") == 0), rule, F.lit(key), "__n")


def absent_keys(rows: DataFrame, known: DataFrame, on: Sequence[str], rule: str) -> DataFrame:
    """Keys of ``rows`` that ``known`` lacks."""
    missing = rows.select(*on).distinct().join(known.select(*on), list(on), "left_anti")
    return violations(missing, rule, F.concat_ws("@", *on), F.lit(""))


def checklist_integrity(checklist: DataFrame) -> DataFrame:
    """Complete decisions, unique files, and ``duplicate_of`` pointing at a non-duplicate pass."""
    rows = checklist.select(
        strip("file").alias("file"),
        strip("human_decision").alias("human_decision"),
        strip("duplicate_of").alias("duplicate_of"),
    )
    targets = (
        rows.groupBy(F.col("file").alias("duplicate_of"))
        .agg(F.max((F.col("human_decision") == "pass") & (F.col("duplicate_of") == "")).alias("__sound"))
    )
    pointing = rows.where(F.col("duplicate_of") != "").join(targets, "duplicate_of", "left")
    return union_all(
        value_domain(rows, "human_decision", ("pass", "not_found"), "file", "human_decision"),
        duplicate_keys(rows, "file", "file_not_unique"),
        violations(pointing.where(F.col("__sound").isNull()), "duplicate_target_absent", "file", "duplicate_of"),
        violations(
            pointing.where(F.col("human_decision") != "pass"), "duplicate_not_pass", "file", "human_decision"
        ),
        violations(pointing.where(~F.col("__sound")), "duplicate_target_not_pass", "file", "duplicate_of"),
    )


def set_difference(left: DataFrame, right: DataFrame, on: Sequence[str], rule: str) -> DataFrame:
    """Set equality: keys on one side only."""
    on = list(on)
    a = left.select(*on).distinct().withColumn("__left", F.lit(True))
    b = right.select(*on).distinct().withColumn("__right", F.lit(True))
    odd = a.join(b, on, "full_outer").where(F.col("__left").isNull() | F.col("__right").isNull())
    side = F.when(F.col("__right").isNull(), "left_only").otherwise("right_only")
    return violations(odd, rule, F.concat_ws("@", *on), side)


def overlap(left: DataFrame, right: DataFrame, on: Sequence[str], rule: str) -> DataFrame:
    """Disjointness: keys on both sides."""
    both = left.select(*on).distinct().join(right.select(*on), list(on), "left_semi")
    return violations(both, rule, F.concat_ws("@", *on), F.lit(""))


def single_configuration(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """More than one combination of settings in one run."""
    settings = rows.select(F.concat_ws("|", *columns).alias("__setting")).distinct()
    several = settings.agg(F.count("*").alias("__n"), F.min("__setting").alias("__first"))
    return violations(several.where(F.col("__n") != 1), "mixed_configuration", "__first", "__n")


def invalid_reviews(reviews: DataFrame, documents: DataFrame) -> DataFrame:
    """Review answers that are malformed or whose quote is not in the document."""
    joined = reviews.join(documents.select("custom_id", "content"), "custom_id", "left")
    decision, quote = F.col("decision"), F.col("quote")
    checks = {
        "unknown_custom_id": (F.col("content").isNotNull(), F.col("custom_id")),
        "invalid_decision": (decision.isin("pass", "not_found"), decision),
        "empty_reason": (strip("reason") != "", F.col("reason")),
        "not_found_with_quote": ((decision != "not_found") | (quote == ""), F.length(quote)),
        "quote_not_found": (
            (decision != "pass") | ((quote != "") & F.coalesce(F.col("content").contains(quote), F.lit(False))),
            F.length(quote),
        ),
    }
    return _broken(joined, F.col("custom_id"), checks)


def quota_arithmetic(ledger_rows: DataFrame, total: int) -> DataFrame:
    """Divisible total, counts within target per stratum."""
    strata = ledger_rows.agg(F.count("*").alias("__n"))
    uneven = strata.where((F.lit(total) % F.col("__n") != 0) | (F.lit(total) < F.col("__n")))
    checks = {
        "baseline_within_target": (F.col("baseline") <= F.col("target"), F.col("baseline")),
        "confirmed_within_target": (
            F.col("confirmed") <= F.greatest(F.col("target") - F.col("baseline"), F.lit(0)), F.col("confirmed"),
        ),
        "baseline_not_negative": (F.col("baseline") >= 0, F.col("baseline")),
    }
    return union_all(
        violations(uneven, "total_not_divisible", F.lit("target_total"), F.lit(total)),
        _broken(ledger_rows, F.col("language"), checks),
    )


def provisional_selection(selected: DataFrame, targets: DataFrame) -> DataFrame:
    """Selection counts per stratum that differ from the recorded quotas, and repeated names."""
    counts = selected.groupBy(F.col("sampling_language").alias("language")).agg(F.count("*").alias("__n"))
    joined = targets.select("language", "target").join(counts, "language", "full_outer")
    wrong = joined.where(F.coalesce("target", F.lit(-1)) != F.coalesce("__n", F.lit(0)))
    return union_all(
        violations(wrong, "quota_mismatch", "language", F.coalesce("__n", F.lit(0))),
        duplicate_keys(selected, F.lower(strip("repository")), "duplicate_selected"),
    )


def schedule_mismatch(prior: DataFrame, schedule: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Prior rows whose schedule position now holds different values (null-safe, names ignore case)."""
    def fold(name: str, side: str) -> Column:
        column = F.col(f"{side}.{name}")
        return F.lower(column) if name in ("repository", "revision", "name", "lastCommitSHA") else column

    same = F.lit(True)
    for name in columns:
        same = same & fold(name, "p").eqNullSafe(fold(name, "s"))
    joined = prior.alias("p").join(
        schedule.withColumn("__here", F.lit(True)).alias("s"), F.col("p.sample_order") == F.col("s.sample_order"), "left"
    )
    key = F.col(f"p.{'repository' if 'repository' in prior.columns else 'name'}")
    return violations(
        joined.where(F.col("s.__here").isNull() | ~same), "schedule_mismatch", key, F.col("p.sample_order")
    )


def review_consistency(
    reviewed: DataFrame, screenings: DataFrame, prior: DataFrame | None = None
) -> DataFrame:
    """Reviewed names that contradict or lack positive screening, and unreviewed earlier positives."""
    names = reviewed.select(F.lower(strip("repository")).alias("name")).distinct()

    def outcome(source: DataFrame, column: str) -> DataFrame:
        return source.groupBy(F.lower("repository").alias("name")).agg(F.max_by("status", "sample_order").alias(column))

    local = outcome(screenings, "local")
    joined = names.join(local, "name", "left")
    if prior is not None:
        joined = joined.join(outcome(prior, "prior"), "name", "left")
    else:
        joined = joined.withColumn("prior", F.lit(None).cast("string"))
    contradictory = joined.where(F.col("local").isNotNull() & (F.col("local") != "pass"))
    unproven = joined.where(
        ~F.coalesce(F.col("local") == "pass", F.lit(False)) & ~F.coalesce(F.col("prior") == "pass", F.lit(False))
    )
    parts = [
        violations(contradictory, "contradictory_review", "name", "local"),
        violations(unproven, "unproven_review", "name", F.coalesce("local", F.lit(""))),
    ]
    if prior is not None:
        open_rows = (
            prior.where(F.col("status") == "pass")
            .select(F.lower("repository").alias("name"))
            .distinct()
            .join(names, "name", "left_anti")
        )
        parts.append(violations(open_rows, "unreviewed_prior_positive", "name", F.lit("")))
    return union_all(*parts)


def unmatched_gold(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Gold rows without a prediction, repeated predictions, and labels outside the domain."""
    model = predictions.select(
        F.col("name").alias("repository"), F.col("lastCommitSHA").alias("revision"), "guideline_status"
    )
    key = ["repository", "revision"]
    return union_all(
        absent_keys(gold, model, key, "missing_prediction"),
        duplicate_keys(model, F.concat_ws("@", *key), "duplicate_prediction"),
        value_domain(gold, "status", ("pass", "review", "not_found"), F.concat_ws("@", *key), "gold_status"),
        value_domain(
            model, "guideline_status", ("pass", "review", "not_found"), F.concat_ws("@", *key), "predicted_status"
        ),
    )


def document_identity(candidates: DataFrame, labels: DataFrame, inputs: DataFrame) -> DataFrame:
    """Labels without candidate or input, or whose identity differs across the three tables."""
    joined = (
        labels.select("custom_id", F.col("markdown_url").alias("url"), "name", "markdown_path")
        .join(
            candidates.select(
                F.col("markdown_url").alias("url"), F.struct("name", "markdown_path").alias("candidate")
            ),
            "url",
            "left",
        )
        .join(inputs.select("custom_id", F.struct("repository", "path").alias("input")), "custom_id", "left")
    )
    same = (
        (F.col("candidate.name") == F.col("name"))
        & (F.col("candidate.markdown_path") == F.col("markdown_path"))
        & (F.col("input.repository") == F.col("name"))
        & (F.col("input.path") == F.col("markdown_path"))
    )
    has_candidate, has_input = F.col("candidate").isNotNull(), F.col("input").isNotNull()
    return _broken(
        joined,
        F.col("custom_id"),
        {
            "candidate_absent": (has_candidate, F.col("url")),
            "input_absent": (has_input, F.col("url")),
            "identity_differs": (~has_candidate | ~has_input | same, F.col("url")),
        },
    )


def final_bundle(
    selected: DataFrame,
    files: DataFrame,
    accepted: DataFrame,
    targets: DataFrame,
    allowlist: DataFrame,
    baseline: DataFrame,
) -> DataFrame:
    """Every invariant of the published bundle, with one scan of each input.

    All rules become entries (rule, key) of the rows and are counted by one aggregate; only the
    revisions that URLs pin are then compared by a join, of what was counted.
    ``selected``: ``repository, revision, sampling_language, license_name, origin``; ``files`` and
    ``accepted``: accepted checklist rows (``repository, file, github_url`` / ``repository, origin``).
    """
    entries = union_all(
        _selected_entries(selected, allowlist),
        *_reviewed_entries(files, accepted),
        _counted(baseline, [("baseline_set", F.lower(strip("repository")))], "right"),
        _counted(targets, [("quota_mismatch", F.col("language")), ("repository_count", F.lit("total"))], "target", F.col("target")),
    )
    # The only exchange of the inputs; what comes out is one narrow row per rule and key.
    found = materialize(
        entries.groupBy("rule", "key", "detail", "value").agg(
            F.sum("left").alias("left"), F.sum("right").alias("right"), F.sum("target").alias("target")
        )
    )
    n, reviewed = F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))
    one_sided = F.col("left").isNull() | F.col("right").isNull()
    side = F.when(F.col("right").isNull(), "left_only").otherwise("right_only")
    unique = F.when(F.col("key") == "", F.concat("rule", F.lit("_blank"))).otherwise(F.concat("rule", F.lit("_duplicate")))
    rule = F.col("rule")
    counted = union_all(
        violations(found.where((rule == "repository_count") & (F.col("target") != n)), rule, "key", n),
        violations(found.where((rule == "quota_mismatch") & (F.coalesce("target", F.lit(-1)) != n)), rule, "key", n),
        violations(found.where((rule == "duplicate_selected") & (n > 1) & (F.col("key") != "")), rule, "key", n),
        violations(found.where(rule.isin("accepted_set", "baseline_set") & one_sided), rule, "key", side),
        violations(found.where(rule.isin("file", "github_url") & ((F.col("key") == "") | (reviewed > 1))), unique, "key", reviewed),
    )
    # Rules of single rows, as often as the row occurs.
    rows = found.where(rule.isin("license_not_allowed", "revision_format", "unknown_origin"))
    revisions = found.where(rule == "selected_revision").select("key", F.col("value").alias("__revision"))
    pinned = attach(found.where(rule == "revision_mismatch"), revisions, ["key"], how="inner")
    wrong = pinned.where(~F.coalesce(F.col("value") == F.col("__revision"), F.lit(False)))
    each = rows.unionByName(wrong.drop("__revision")).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), n + reviewed)))
    return counted.unionByName(violations(each, rule, "key", "detail"))


def _entry(rule: str, key: Column, detail: Column | None = None, value: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    parts = (F.lit(rule), key, none if detail is None else detail, none if value is None else value)
    return F.struct(*(c.cast("string").alias(n) for c, n in zip(parts, ("rule", "key", "detail", "value"), strict=True)))


def _counts(rows: DataFrame, entries: Column, side: str, amount: Column | None = None) -> DataFrame:
    """One row per entry of each row, with 1 (or ``amount``) on its side."""
    one = F.lit(1) if amount is None else amount
    sides = [(one if s == side else F.lit(None)).cast("bigint").alias(s) for s in ("left", "right", "target")]
    return rows.select(F.explode(F.array_compact(entries)).alias("e"), *sides).select("e.*", "left", "right", "target")


def _counted(rows: DataFrame, keys: list[tuple[str, Column]], side: str, amount: Column | None = None) -> DataFrame:
    return _counts(rows, F.array(*(_entry(rule, key) for rule, key in keys)), side, amount)


def _selected_entries(selected: DataFrame, allowlist: DataFrame) -> DataFrame:
    """What each selected repository says about every rule."""
    names = allowlist_names(allowlist).select(F.col("license_name").alias("__license"), F.lit(True).alias("__allowed"))
    rows = selected.withColumn("__license", strip("license_name")).join(names, "__license", "left")
    name, origin = F.lower(strip("repository")), final_origin("origin")
    revision = strip("revision")
    entries = F.array(
        _entry("repository_count", F.lit("total")),
        _entry("quota_mismatch", F.col("sampling_language")),
        _entry("duplicate_selected", name),
        _entry("selected_revision", name, None, revision),
        F.when(origin.isNotNull(), _entry("accepted_set", F.concat_ws("@", name, origin))),
        F.when(origin == "baseline", _entry("baseline_set", name)),
        F.when(F.col("__allowed").isNull(), _entry("license_not_allowed", name, F.col("license_name"))),
        F.when(~F.coalesce(revision.rlike(COMMIT_PATTERN), F.lit(False)), _entry("revision_format", name, F.col("revision"))),
        F.when(origin.isNull(), _entry("unknown_origin", name, F.col("origin"))),
    )
    return _counts(rows, entries, "left")


def _reviewed_entries(files: DataFrame, accepted: DataFrame) -> list[DataFrame]:
    """Names and URLs of reviewed files with the revisions the URLs pin, and accepted repositories.

    One frame when both are the same table.
    """
    name = F.lower(strip("repository"))
    of_file = [
        _entry("file", F.coalesce(F.col("file").cast("string"), F.lit(""))),
        _entry("github_url", F.coalesce(F.col("github_url").cast("string"), F.lit(""))),
        _entry("revision_mismatch", name, F.col("github_url"), paths.url_revision("github_url", strip("repository"))),
    ]
    of_repository = [_entry("accepted_set", F.concat_ws("@", name, "origin"))]
    if files is accepted:
        return [_counts(files, F.array(*of_file, *of_repository), "right")]
    return [_counts(files, F.array(*of_file), "right"), _counts(accepted, F.array(*of_repository), "right")]


def review_revisions(files: DataFrame, selected: DataFrame) -> DataFrame:
    """Reviewed URLs that do not pin the selected revision."""
    revisions = selected.select(
        F.lower(strip("repository")).alias("__name"), strip("revision").alias("__revision")
    )
    named = files.select("repository", "github_url", F.lower(strip("repository")).alias("__name"))
    pinned = attach(named, revisions, ["__name"], how="inner").withColumn(
        "__pinned", paths.url_revision("github_url", strip("repository"))
    )
    return violations(
        pinned.where(~F.coalesce(F.col("__pinned") == F.col("__revision"), F.lit(False))),
        "revision_mismatch",
        "__name",
        "github_url",
    )


def changed_inputs(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Inputs whose digest differs from the one recorded for the run (``role, digest``)."""
    joined = recorded.select("role", F.col("digest").alias("__then")).join(
        current.select("role", F.col("digest").alias("__now")), "role", "full_outer"
    )
    return violations(
        joined.where(~F.col("__then").eqNullSafe(F.col("__now"))), "input_changed", "role", F.coalesce("__now", F.lit("absent"))
    )


# Settings that may change when a licence policy is applied to a pending run.
LICENSE_POLICY_SETTINGS = (
    "baseline_repositories", "baseline_repositories_by_language", "license_allowlist",
    "license_allowlist_fingerprints", "license_ineligible_reviewed_repositories", "license_policy_status",
)
# Settings that must agree before an earlier run's outcomes are carried over.
PRIOR_SETTINGS = (
    "repository_source", "sample_seed", "languages", "excluded_repositories", "input_fingerprints",
    "exclude_csv_fingerprints", "classification_contract_sha256", "filter", "provider", "region", "model",
    "reasoning_effort", "max_output_tokens", "max_input_bytes", "enforce_snapshot_window",
)


FINGERPRINT_SETTINGS = ("input_fingerprints", "exclude_csv_fingerprints")


def incompatible_settings(existing: DataFrame, current: DataFrame) -> DataFrame:
    """Settings (``name, value``) that differ between two runs.

    A pending policy may become an applied one; only then may the policy's own settings differ.
    """
    joined = (
        existing.select("name", F.col("value").alias("__old"))
        .join(current.select("name", F.col("value").alias("__new")), "name", "full_outer")
        .where(~F.col("__old").eqNullSafe(F.col("__new")))
    )
    moved = joined.where(
        (F.col("name") == "license_policy_status") & (F.col("__old") == "pending") & (F.col("__new") == "applied")
    ).agg(F.count("*")).scalar()
    forgiven = (moved > 0) & F.col("name").isin(*LICENSE_POLICY_SETTINGS)
    return violations(joined.where(~forgiven), "setting_changed", "name", F.coalesce("__new", F.lit("absent")))


def incompatible_prior(prior: DataFrame, current: DataFrame) -> DataFrame:
    """Sampling and classification settings (``name, value``) that rule out carrying outcomes over.

    Fingerprints (JSON objects from path to hash) are compared by their sorted hashes: the same
    files under other paths stay compatible.
    """
    hashes = F.array_join(F.array_sort(F.map_values(F.from_json("value", "map<string,string>"))), ",")
    by_hash = F.when(F.col("name").isin(*FINGERPRINT_SETTINGS), F.coalesce(hashes, F.col("value"))).otherwise(F.col("value"))

    def compared(settings: DataFrame) -> DataFrame:
        return settings.where(F.col("name").isin(*PRIOR_SETTINGS)).select("name", by_hash.alias("value"))

    return changed_settings(compared(prior), compared(current))


def changed_settings(existing: DataFrame, current: DataFrame) -> DataFrame:
    """Settings whose values differ, absent ones included."""
    joined = existing.select("name", F.col("value").alias("__old")).join(
        current.select("name", F.col("value").alias("__new")), "name", "full_outer"
    )
    return violations(
        joined.where(~F.col("__old").eqNullSafe(F.col("__new"))),
        "setting_changed",
        "name",
        F.coalesce("__new", F.lit("absent")),
    )


def open_outcomes(screenings: DataFrame) -> DataFrame:
    """Screenings that have not ended for good."""
    return violations(
        screenings.where(~F.col("status").isin(*TERMINAL_SCREENINGS)), "not_terminal", "repository", "status"
    )
