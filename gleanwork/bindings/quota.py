"""Quotas, review state, licence policy and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import SCHEDULED_SQL, UNITS_SQL, Tables
from gleanwork.operators import attempts, gates, quota
from gleanwork.plans import collection

# Quotas and targets of the bound queries.
QUOTAS = (("de", 20), ("en", 60), ("es", 15), ("fr", 400))
QUOTA_VALUES = "(VALUES ('de', 20), ('en', 60), ('es', 15), ('fr', 400)) v(language, quota)"
TARGETS = (("de", 40), ("en", 160), ("es", 35), ("fr", 60))
TARGET_VALUES = "(VALUES ('de', 40), ('en', 160), ('es', 35), ('fr', 60)) v(language, target)"


def quotas(t: Tables):
    return t.spark.createDataFrame(QUOTAS, "language string, quota bigint")


def targets(t: Tables):
    return t.spark.createDataFrame(TARGETS, "language string, target bigint")


def reviewed(t: Tables):
    """Human-reviewed repositories: those with a toxic label."""
    return t.scheduled.join(t.labels.where("toxic = 1"), "doc_id", "left_semi").select(F.upper("repository").alias("repository"))


REVIEWED_SQL = f"""{SCHEDULED_SQL}, reviewed AS (SELECT repository, status FROM scheduled WHERE doc_id IN
    (SELECT doc_id FROM labels WHERE toxic = 1))"""
SELECTED_SQL = f"""{REVIEWED_SQL}, positives AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY sample_order) AS rn
    FROM scheduled WHERE status = 'pass' AND repository NOT IN (SELECT repository FROM reviewed)),
  pending AS (SELECT p.* FROM positives p JOIN {QUOTA_VALUES} USING (language) WHERE rn <= quota)"""


@query("w3_first_k_by_stratum", f"WITH {SELECTED_SQL} SELECT sample_order, language, repository FROM pending")
def w3(t: Tables):
    return quota.selected_by_stratum(t.scheduled, quotas(t), reviewed(t), t.scheduled).select(
        "sample_order", "language", "repository"
    )


@query(
    "w3_first_k_overall",
    f"""WITH {REVIEWED_SQL} SELECT sample_order, repository FROM scheduled WHERE status = 'pass'
       AND repository NOT IN (SELECT repository FROM reviewed) ORDER BY sample_order LIMIT 80""",
)
def w3_overall(t: Tables):
    return quota.selected(t.scheduled, 80, reviewed(t)).select("sample_order", "repository")


PREFIX_SQL = f"""{SCHEDULED_SQL}, counted AS (SELECT *, coalesce(count(*) FILTER (status = 'pass') OVER (PARTITION BY language
    ORDER BY round_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM scheduled),
  kept AS (SELECT c.* FROM counted c JOIN {QUOTA_VALUES} USING (language) WHERE earlier < quota)"""


@query("w4_sequential_stop", f"WITH {PREFIX_SQL} SELECT sample_order, round_number, language FROM kept")
def w4(t: Tables):
    return quota.screened_prefix(t.scheduled, quotas(t)).select("sample_order", "round_number", "language")


@query(
    "w4_sequential_stop_budget",
    f"""WITH {PREFIX_SQL}, rounds AS (SELECT round_number, sum(count(*)) OVER (ORDER BY round_number) AS total FROM kept GROUP BY 1)
       SELECT sample_order, round_number, language FROM kept WHERE round_number IN (SELECT round_number FROM rounds WHERE total <= 250)""",
)
def w4_budget(t: Tables):
    return quota.screened_prefix(t.scheduled, quotas(t), 250).select("sample_order", "round_number", "language")


WAVE_SQL = f"""{REVIEWED_SQL}, stored AS (SELECT * FROM scheduled WHERE license_name NOT LIKE 'src1%' AND status <> 'unresolved'),
  have AS (SELECT language, count(*) AS n FROM stored WHERE status = 'pass' AND repository NOT IN (SELECT repository FROM reviewed) GROUP BY 1),
  active AS (SELECT language FROM {QUOTA_VALUES} LEFT JOIN have USING (language) WHERE coalesce(n, 0) < quota),
  todo AS (SELECT * FROM scheduled WHERE language IN (SELECT language FROM active) AND sample_order NOT IN
    (SELECT sample_order FROM stored) AND repository NOT IN (SELECT repository FROM reviewed))"""


@query(
    "r5_next_wave",
    f"""WITH {WAVE_SQL} SELECT sample_order, round_number, language FROM todo
       WHERE round_number = (SELECT min(round_number) FROM todo)""",
)
def r5(t: Tables):
    stored = t.scheduled.where("license_name not like 'src1%' and status <> 'unresolved'")
    return quota.next_wave(t.scheduled, stored, quotas(t), reviewed(t), budget=10**9).select(
        "sample_order", "round_number", "language"
    )


@query(
    "r6_carried_outcomes",
    f"WITH {SCHEDULED_SQL} SELECT DISTINCT lower(repository) AS repository FROM scheduled WHERE status IN ('pass', 'not_found')",
)
def r6(t: Tables):
    return quota.carried_names(t.scheduled)


@query(
    "r6_gated_carry",
    f"""WITH {SCHEDULED_SQL} SELECT DISTINCT lower(repository) AS repository FROM scheduled
        WHERE status IN ('pass', 'not_found') AND license_name NOT IN ('src3', 'src4')""",
)
def r6_gated(t: Tables):
    """Carried behind the gates: the same positions and settings, the inputs under another path."""
    scheduled = t.scheduled
    total = scheduled.agg(F.count("*").cast("string").alias("value"))

    def settings(folder: str):
        hashes = scheduled.groupBy("language").agg(F.md5(F.max("revision")).alias("hash"))
        entry = F.struct(F.concat(F.lit(folder), "language").alias("path"), "hash")
        inputs = hashes.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
        return inputs.select(F.lit("input_fingerprints").alias("name"), "value").unionByName(
            total.select(F.lit("sample_seed").alias("name"), "value")
        )

    manifest = scheduled.select("sample_order", *collection.SCREENING_IDENTITY)
    eligible = scheduled.where("license_name not in ('src3', 'src4')").select("repository")
    kept = collection.carried_screenings(scheduled, manifest, settings("old/"), manifest, settings("new/"), eligible)
    return quota.carried_names(kept)


def languages_of(t: Tables, condition):
    return t.scheduled.where(condition).select("language")


LEDGER_SQL = f"""{SELECTED_SQL}, b AS (SELECT language, count(*) AS baseline FROM scheduled WHERE license_name IN ('src3', 'src4') GROUP BY 1),
  c AS (SELECT language, count(*) AS confirmed FROM scheduled WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
    AND status = 'pass' GROUP BY 1), p AS (SELECT language, count(*) AS pending FROM pending GROUP BY 1),
  ledger AS (SELECT language, CAST(target AS BIGINT) AS target, coalesce(baseline, 0) AS baseline, coalesce(confirmed, 0) AS confirmed,
    coalesce(pending, 0) AS pending, coalesce(baseline, 0) + coalesce(confirmed, 0) + coalesce(pending, 0) AS selected,
    target - (coalesce(baseline, 0) + coalesce(confirmed, 0) + coalesce(pending, 0)) AS remaining
    FROM {TARGET_VALUES} LEFT JOIN b USING (language) LEFT JOIN c USING (language) LEFT JOIN p USING (language))"""


def ledger(t: Tables):
    confirmed = t.scheduled.join(t.labels.where("toxic = 1"), "doc_id", "left_semi").where("status = 'pass'")
    pending = quota.selected_by_stratum(t.scheduled, quotas(t), reviewed(t))
    return quota.ledger(targets(t), t.scheduled.where("license_name in ('src3', 'src4')"), confirmed, pending)


@query("a16_quota_ledger", f"WITH {LEDGER_SQL} SELECT * FROM ledger")
def a16(t: Tables):
    return ledger(t)


@query(
    "v14_workflow_stage",
    f"""WITH {LEDGER_SQL} SELECT CAST(sum(target) AS BIGINT) AS target_total, CAST(sum(baseline) AS BIGINT) AS baseline_repositories,
         CAST(sum(target - baseline) AS BIGINT) AS new_repository_target, CAST(sum(confirmed) AS BIGINT) AS confirmed_new_repositories,
         CAST(sum(pending) AS BIGINT) AS pending_new_repositories, CAST(sum(selected) AS BIGINT) AS selected_total_repositories,
         bool_and(remaining = 0) AS target_reached, bool_and(baseline + confirmed >= target) AS human_target_reached,
         CASE WHEN bool_and(baseline + confirmed >= target) THEN 'ready_to_finalize' WHEN NOT bool_and(remaining = 0)
           THEN 'needs_replenishment' ELSE 'needs_file_review' END AS workflow_stage,
         CASE WHEN bool_and(baseline + confirmed >= target) THEN 'finalize the guideline collection' WHEN NOT bool_and(remaining = 0)
           THEN 'resume eligible repository screening' ELSE 'complete the exported file review checklist' END AS next_action FROM ledger""",
)
def v14(t: Tables):
    return quota.collection_report(ledger(t), True)


@query(
    "v13_quota_arithmetic",
    f"""WITH {LEDGER_SQL} SELECT 'total_not_divisible' AS rule, 'target_total' AS key, '295' AS detail
       UNION ALL SELECT 'baseline_within_target', language, CAST(baseline AS VARCHAR) FROM ledger WHERE baseline > target
       UNION ALL SELECT 'confirmed_within_target', language, CAST(confirmed AS VARCHAR) FROM ledger WHERE confirmed > greatest(target - baseline, 0)""",
)
def v13(t: Tables):
    return gates.quota_arithmetic(ledger(t), 295)


@query(
    "v15_provisional_selection",
    f"""WITH {SELECTED_SQL}, n AS (SELECT language, count(*) AS n FROM pending GROUP BY 1)
       SELECT 'quota_mismatch' AS rule, language AS key, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM {TARGET_VALUES}
       FULL JOIN n USING (language) WHERE coalesce(target, -1) <> coalesce(n, 0)""",
)
def v15(t: Tables):
    pending = quota.selected_by_stratum(t.scheduled, quotas(t), reviewed(t))
    return gates.provisional_selection(pending.withColumnRenamed("language", "sampling_language"), targets(t))


@query(
    "u4_confirmed_names",
    """WITH rows AS (SELECT 1 AS src, doc_id, trim(source) AS repository, CASE quality WHEN 1 THEN 'pass' ELSE 'not_found' END AS decision,
           CASE WHEN toxic = 1 THEN 'x' ELSE '' END AS dup FROM documents JOIN labels USING (doc_id)
         UNION ALL SELECT 0, doc_id, upper(source), CASE toxic WHEN 1 THEN 'pass' ELSE 'not_found' END, '' FROM documents JOIN labels USING (doc_id)),
       ok AS (SELECT *, row_number() OVER (PARTITION BY lower(repository) ORDER BY src, doc_id) AS rn FROM rows
         WHERE decision = 'pass' AND dup = '')
       SELECT lower(repository) AS name_key, repository FROM ok WHERE rn = 1""",
)
def u4(t: Tables):
    d = t.documents.join(t.labels, "doc_id")
    first = d.select(
        F.upper("source").alias("repository"),
        F.when(F.col("toxic") == 1, "pass").otherwise("not_found").alias("human_decision"),
        F.col("doc_id").alias("row_index"),
    )
    second = d.select(
        F.concat(F.lit(" "), "source").alias("repository"),
        F.when(F.col("quality") == 1, "pass ").otherwise("not_found").alias("human_decision"),
        F.when(F.col("toxic") == 1, "x").otherwise("").alias("duplicate_of"),
        F.col("doc_id").alias("row_index"),
    )
    return quota.confirmed_names(first, second)


@query(
    "j9_names_by_stratum",
    f"WITH {REVIEWED_SQL} SELECT language, count(*) AS repositories FROM reviewed JOIN scheduled USING (repository) GROUP BY 1",
)
def j9(t: Tables):
    return quota.counts_by_stratum(reviewed(t), t.units, "name", "mainLanguage")


@query(
    "j10_confirmed_in_schedule",
    f"""WITH {REVIEWED_SQL} SELECT 'absent_from_schedule' AS rule, lower(repository) AS key, '' AS detail FROM reviewed
       WHERE repository NOT IN (SELECT repository FROM scheduled WHERE language <> 'de')""",
)
def j10(t: Tables):
    thinned = t.scheduled.where("language <> 'de'").select(F.lower("repository").alias("name"))
    return gates.absent_keys(reviewed(t).select(F.lower("repository").alias("name")), thinned, ["name"], "absent_from_schedule")


ALLOW_SQL = "(SELECT DISTINCT source FROM documents WHERE lang = 'de' AND n_chars < 900)"


def allow(t: Tables):
    return t.documents.where("lang = 'de' and n_chars < 900").select(F.concat("source", F.lit(" ")).alias("license_name"))


@query("p16_allowed_licenses", f"WITH {UNITS_SQL} SELECT name FROM units WHERE license IN {ALLOW_SQL}")
def p16(t: Tables):
    return quota.allowed(t.units, allow(t), "license").select("name")


@query(
    "j11_license_partition",
    f"WITH {UNITS_SQL} SELECT name, license IN {ALLOW_SQL} AS accepted FROM units",
)
def j11(t: Tables):
    accepted = quota.allowed(t.units, allow(t), "license").select("name", F.lit(True).alias("accepted"))
    return accepted.unionByName(
        quota.rejected(t.units, allow(t), "license").select("name", F.lit(False).alias("accepted"))
    )


@query(
    "a15_license_totals",
    """SELECT count(*) AS repositories, count(DISTINCT n) AS license_names, count(*) FILTER (trim(n) = '') AS blank_license_repositories,
       count(*) FILTER (lower(trim(n)) = 'other') AS other_license_repositories
       FROM (SELECT CASE WHEN c_nationkey = 3 THEN ' ' WHEN c_nationkey = 4 THEN 'OTHER ' ELSE c_mktsegment END AS n FROM customer)""",
)
def a15_licenses(t: Tables):
    nation = F.col("c_nationkey")
    name = F.when(nation == 3, "\t").when(nation == 4, "OTHER ").otherwise(F.col("c_mktsegment"))
    return quota.license_totals(t.customer.select(name.alias("license_name")))


@query(
    "a15_allowlist_totals",
    f"""WITH {UNITS_SQL} SELECT count(*) AS input_repositories, count(*) FILTER (license IN {ALLOW_SQL}) AS accepted_repositories,
       count(*) FILTER (license NOT IN {ALLOW_SQL}) AS rejected_repositories, (SELECT count(*) FROM {ALLOW_SQL}) AS allowlisted_license_names FROM units""",
)
def a15_allowlist(t: Tables):
    return quota.allowlist_totals(t.units.withColumnRenamed("license", "license_name"), allow(t))


@query(
    "u7_review_by_eligibility",
    f"""WITH {REVIEWED_SQL}, states AS (SELECT lower(repository) AS repository, CASE status WHEN 'pass' THEN 'confirmed' ELSE 'rejected' END AS state FROM reviewed),
       eligible AS (SELECT lower(lang || '/Doc' || doc_id) AS repository FROM documents WHERE source IN {ALLOW_SQL})
       SELECT repository, state, repository IN (SELECT repository FROM eligible) AS eligible,
         repository NOT IN (SELECT repository FROM eligible) AND state = 'confirmed' AS dropped FROM states""",
)
def u7(t: Tables):
    rows = t.scheduled.join(t.labels.where("toxic = 1"), "doc_id", "left_semi").select(
        "repository", F.when(F.col("status") == "pass", "confirmed").otherwise("rejected").alias("state")
    )
    return quota.review_by_eligibility(rows, quota.eligible_names(t.units, allow(t)))


@query(
    "u8_selected_with_origin",
    f"""WITH {SELECTED_SQL} SELECT repository, revision, language AS sampling_language, license_name, 'new_pending' AS origin, sample_order FROM pending
       UNION ALL SELECT repository, revision, language, license_name, 'new_confirmed', sample_order FROM scheduled
         WHERE repository IN (SELECT repository FROM reviewed WHERE status = 'pass')
       UNION ALL SELECT lower(repository), revision, language, license_name, 'baseline', NULL FROM scheduled WHERE license_name IN ('src3', 'src4')
       UNION ALL SELECT n_name, '', '', '', 'baseline', NULL FROM nation""",
)
def u8(t: Tables):
    baseline = t.scheduled.where("license_name in ('src3', 'src4')").select(F.lower("repository").alias("repository"))
    baseline = baseline.unionByName(t.nation.select(F.col("n_name").alias("repository")))
    confirmed = t.scheduled.join(t.labels.where("toxic = 1"), "doc_id", "left_semi").where("status = 'pass'")
    pending = quota.selected_by_stratum(t.scheduled, quotas(t), reviewed(t))
    return quota.selected_repositories(baseline, confirmed, pending, t.scheduled, t.units)


@query(
    "a1_population_profile",
    f"""WITH {UNITS_SQL} SELECT mainLanguage, count(*) AS repositories, count(DISTINCT lastCommitSHA) AS distinct_revisions FROM units GROUP BY 1""",
)
def a1(t: Tables):
    return quota.population_profile(t.units)


@query(
    "j22_annotated_file_attempts",
    f"""WITH {SELECTED_SQL} SELECT event_id, sample_order, round_number, language AS sampling_language,
         repository IN (SELECT repository FROM pending) AS selected_repository FROM events JOIN scheduled ON sample_order = user_id + 1""",
)
def j22(t: Tables):
    rows = t.events.select("event_id", (F.col("user_id") + 1).alias("sample_order"))
    pending = quota.selected_by_stratum(t.scheduled, quotas(t), reviewed(t))
    return quota.file_records(rows, t.scheduled, pending).select(
        "event_id", "sample_order", "round_number", "sampling_language", "selected_repository"
    )


@query(
    "u6_rejected_names",
    """SELECT DISTINCT source AS repository FROM documents JOIN labels USING (doc_id) WHERE source NOT IN
       (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND lang = 'en')""",
)
def u6(t: Tables):
    reviewed_rows = t.documents.join(t.labels, "doc_id")
    confirmed = reviewed_rows.where("toxic = 1 and lang = 'en'").select("source")
    # Set difference: reviewed minus confirmed.
    return reviewed_rows.select("source").subtract(confirmed).withColumnRenamed("source", "repository")


@query(
    "j20_review_consistency",
    f"""WITH {REVIEWED_SQL}, names AS (SELECT lower(repository) AS name, doc_id FROM scheduled WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)),
       here AS (SELECT lower(repository) AS name, status FROM scheduled WHERE license_name LIKE 'src1%'),
       prior AS (SELECT lower(repository) AS name, status FROM scheduled WHERE language = 'en')
       SELECT 'contradictory_review' AS rule, name AS key, status AS detail FROM names JOIN here USING (name) WHERE status <> 'pass'
       UNION ALL SELECT 'unproven_review', n.name, coalesce(h.status, '') FROM names n LEFT JOIN here h USING (name) LEFT JOIN prior p USING (name)
         WHERE coalesce(h.status, '') <> 'pass' AND coalesce(p.status, '') <> 'pass'
       UNION ALL SELECT 'unreviewed_prior_positive', name, '' FROM prior WHERE status = 'pass' AND name NOT IN (SELECT name FROM names)""",
)
def j20(t: Tables):
    return gates.review_consistency(
        reviewed(t), t.scheduled.where("license_name like 'src1%'"), t.scheduled.where("language = 'en'")
    )


@query(
    "j19_schedule_mismatch",
    f"""WITH {SCHEDULED_SQL} SELECT 'schedule_mismatch' AS rule, repository AS key, CAST(sample_order AS VARCHAR) AS detail FROM scheduled
       WHERE doc_id % 7 = 0 OR doc_id % 11 = 0 UNION ALL SELECT 'schedule_mismatch', n_name, CAST(-1 - n_nationkey AS VARCHAR) FROM nation""",
)
def j19(t: Tables):
    columns = ["round_number", "language", "repository", "revision", "license_name"]
    prior = t.scheduled.select("sample_order", *columns)
    moved = (
        prior.withColumn("round_number", F.col("round_number") + F.when(F.col("sample_order") % 7 == 1, 1).otherwise(0))
        .withColumn("license_name", F.when(F.col("sample_order") % 11 != 1, F.col("license_name")))
        .withColumn("revision", F.upper("revision"))
    )
    stray = t.nation.select(
        (-1 - F.col("n_nationkey")).cast("bigint").alias("sample_order"), F.lit(1).cast("bigint").alias("round_number"),
        F.lit("de").alias("language"), F.col("n_name").alias("repository"), F.lit("0").alias("revision"), F.lit("x").alias("license_name"),
    )
    return gates.schedule_mismatch(moved.unionByName(stray), t.scheduled, columns)


@query(
    "p14_open_outcomes",
    f"WITH {SCHEDULED_SQL} SELECT 'not_terminal' AS rule, repository AS key, status AS detail FROM scheduled WHERE status = 'unresolved'",
)
def p14_open(t: Tables):
    return gates.open_outcomes(t.scheduled)


@query(
    "p14_retryable_view",
    "SELECT event_id FROM events WHERE event_type IN ('click', 'error')",
)
def p14_views(t: Tables):
    return attempts.retryable(t.attempts).select(F.col("seq").alias("event_id"))
