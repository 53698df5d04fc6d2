"""Sampling, schedules, size strata and hard cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import CANDIDATES_SQL, LANGS, UNITS_SQL, Tables
from gleanwork.functions import labels
from gleanwork.operators import ordering, quota, sampling

SEED = 20260807

ELIGIBLE_SQL = f"""{UNITS_SQL}, dim AS (SELECT * FROM (VALUES ('de', 1), ('en', 2), ('es', 3), ('fr', 4)) v(sampling_language, idx)),
  pool AS (SELECT *, lower(name) AS unit FROM units WHERE lower(name) NOT IN (SELECT unit FROM excluded)),
  drawn AS (SELECT *, row_number() OVER (PARTITION BY mainLanguage ORDER BY sha256('{SEED}:' || unit), unit) AS rn,
    count(*) OVER (PARTITION BY mainLanguage) AS language_population FROM pool)"""


def quotas_sql(size: int) -> str:
    return f"""quotas AS (SELECT sampling_language, idx, {size} // count(*) OVER () + CASE WHEN row_number() OVER
      (ORDER BY sha256('{SEED}:' || sampling_language), sampling_language) <= {size} % count(*) OVER () THEN 1 ELSE 0 END
      AS language_sample_size FROM dim)"""


@query(
    "m1_stratified_sample",
    f"""WITH {ELIGIBLE_SQL}, {quotas_sql(50)}, offs AS (SELECT *, coalesce(sum(language_sample_size) OVER
         (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM quotas)
       SELECT CAST(off + rn AS BIGINT) AS sample_order, sampling_language, language_population, language_sample_size, name, lastCommitSHA
       FROM drawn d JOIN offs o ON o.sampling_language = d.mainLanguage WHERE rn <= language_sample_size""",
)
def m1(t: Tables):
    return sampling.stratified_sample(t.units, LANGS, 50, SEED, t.excluded).select(
        "sample_order", "sampling_language", "language_population", "language_sample_size", "name", "lastCommitSHA"
    )


@query(
    "m2_stratum_quotas",
    f"""WITH dim AS (SELECT DISTINCT lang AS sampling_language, 0 AS idx FROM documents), {quotas_sql(50)}
       SELECT sampling_language, language_sample_size FROM quotas""",
)
def m2(t: Tables):
    dimension = t.documents.select(F.col("lang").alias("sampling_language")).distinct()
    return sampling.stratum_quotas(dimension, 50, SEED)


@query(
    "m3_inclusion_probability",
    f"""WITH {ELIGIBLE_SQL}, {quotas_sql(50)} SELECT name, language_sample_size / language_population AS inclusion_probability
       FROM drawn d JOIN quotas q ON q.sampling_language = d.mainLanguage WHERE rn <= language_sample_size""",
)
def m3(t: Tables):
    return sampling.stratified_sample(t.units, LANGS, 50, SEED, t.excluded).select("name", "inclusion_probability")


STRATA_SQL = f"""{CANDIDATES_SQL}, ordered AS (SELECT *, row_number() OVER (ORDER BY size_bytes, name, lastCommitSHA, markdown_path) - 1 AS r,
    count(*) OVER () AS n FROM candidates),
  strata AS (SELECT *, CAST((5 * (r + 1) - 1) // n + 1 AS INTEGER) AS stratum FROM ordered)"""


@query("w6_size_strata", f"WITH {STRATA_SQL} SELECT name, markdown_path, size_bytes, stratum FROM strata")
def w6(t: Tables):
    return sampling.size_strata(t.candidates).select("name", "markdown_path", "size_bytes", "stratum")


@query(
    "m4_size_stratified_sample",
    f"""WITH {STRATA_SQL}, pops AS (SELECT stratum, count(*) AS stratum_population FROM strata GROUP BY 1),
       drawn AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sha256('{SEED}:' || name || '/' || lastCommitSHA
         || '/' || markdown_path), name, lastCommitSHA, markdown_path) AS rn FROM strata),
       picked AS (SELECT *, row_number() OVER (ORDER BY stratum, name, lastCommitSHA, markdown_path) AS num FROM drawn WHERE rn <= 12)
       SELECT printf('candidate-%04d', num) AS custom_id, stratum, stratum_population, name, markdown_path
       FROM picked JOIN pops USING (stratum)""",
)
def m4(t: Tables):
    return sampling.size_sample(t.candidates, 60, SEED).select(
        "custom_id", "stratum", "stratum_population", "name", "markdown_path"
    )


@query(
    "m5_select_all",
    f"""WITH {CANDIDATES_SQL} SELECT printf('candidate-%04d', row_number() OVER (ORDER BY name, lastCommitSHA, markdown_path)) AS custom_id,
       CAST(0 AS INTEGER) AS stratum, count(*) OVER () AS stratum_population, name, markdown_path FROM candidates""",
)
def m5(t: Tables):
    return sampling.select_all(t.candidates).select("custom_id", "stratum", "stratum_population", "name", "markdown_path")


@query(
    "w10_sequential_ids",
    """SELECT printf('candidate-%04d', row_number() OVER (ORDER BY c_mktsegment, c_custkey)) AS custom_id, c_custkey FROM customer""",
)
def w10(t: Tables):
    return sampling.sequential_ids(t.customer.select("c_mktsegment", "c_custkey"), ["c_mktsegment", "c_custkey"]).select(
        "custom_id", "c_custkey"
    )


@query(
    "m6_sampling_report",
    f"""WITH {UNITS_SQL}, dim AS (SELECT * FROM (VALUES ('de', 1), ('en', 2), ('es', 3), ('fr', 4)) v(sampling_language, idx)),
       {quotas_sql(50)}, c AS (SELECT mainLanguage AS sampling_language, count(*) AS population,
         count(*) FILTER (lower(name) IN (SELECT unit FROM excluded)) AS excluded FROM units GROUP BY 1)
       SELECT sampling_language, population, c.excluded, population - c.excluded AS eligible,
         least(language_sample_size, population - c.excluded) AS sampled FROM quotas JOIN c USING (sampling_language)""",
)
def m6(t: Tables):
    return sampling.sampling_report(t.units, LANGS, 50, t.excluded, SEED)


SCHEDULE_SQL = f"""{ELIGIBLE_SQL}, rounds AS (SELECT min(language_population) AS n FROM drawn),
  schedule AS (SELECT (rn - 1) * 4 + idx AS sample_order, rn AS round_number, d.mainLanguage AS sampling_language,
    language_population, name, lastCommitSHA, source_file, input_index, license, doc_id FROM drawn d
    JOIN dim ON dim.sampling_language = d.mainLanguage WHERE rn <= (SELECT n FROM rounds))"""


@query(
    "w5_round_robin_schedule",
    f"WITH {SCHEDULE_SQL} SELECT sample_order, round_number, sampling_language, language_population, name FROM schedule",
)
def w5(t: Tables):
    return sampling.schedule(t.units, LANGS, SEED, t.excluded).select(
        "sample_order", "round_number", "sampling_language", "language_population", "name"
    )


@query(
    "p13_eligible_units",
    f"WITH {UNITS_SQL} SELECT name FROM units WHERE mainLanguage IN ('de', 'en') AND lower(name) NOT IN (SELECT unit FROM excluded)",
)
def p13(t: Tables):
    return sampling.eligible(t.units, t.excluded, ("de", "en")).select("name")


@query(
    "j12_eligible_schedule",
    f"""WITH {SCHEDULE_SQL} SELECT sample_order, name FROM schedule
       WHERE license IN (SELECT source FROM documents WHERE lang = 'es' AND n_chars > 2000)""",
)
def j12(t: Tables):
    allow = t.documents.where("lang = 'es' and n_chars > 2000").select(F.col("source").alias("license_name"))
    # The schedule is drawn first; eligibility then thins it without renumbering.
    plan = sampling.schedule(t.units, LANGS, SEED, t.excluded)
    return quota.with_names(plan, quota.eligible_names(t.units, allow), "name").select("sample_order", "name")


@query("o3_first_rows_requested", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 100")
def o3(t: Tables):
    return ordering.leading_rows(t.part, ["p_partkey"], 100).select("p_partkey", "p_name")


def classified(t: Tables):
    """Classified repositories with nested candidate documents built from the tables."""
    d = t.documents.join(t.labels, "doc_id")
    nested = F.to_json(
        F.array(
            F.struct((F.col("doc_id") % 5).alias("strong_matches"), (F.col("doc_id") % 7).alias("normative_matches"),
                     (F.col("n_chars") % 60).alias("code_matches")),
            F.struct((F.col("doc_id") % 3).alias("strong_matches"), (F.col("doc_id") % 11).alias("normative_matches"),
                     (F.col("n_chars") % 40).alias("code_matches")),
        )
    )
    path = F.when(F.col("doc_id") % 3 == 0, "README.md").when(F.col("doc_id") % 3 == 1, "docs/STYLE.md").otherwise("x.md")
    return d.select(
        F.concat("source", F.lit("/Project"), (F.col("doc_id") % 97).cast("string"), F.lit("-"), "doc_id").alias("name"),
        F.col("lang").alias("mainLanguage"),
        F.when(F.col("quality") == 1, "pass").otherwise("review").alias("guideline_status"),
        (F.col("doc_id") % 9).cast("string").alias("candidate_count"),
        nested.alias("candidate_documents_json"),
        path.alias("guideline_path"),
        F.when(F.col("toxic") == 1, "True").otherwise("false").alias("tree_truncated"),
    )


SCORED_SQL = """scored AS (SELECT source || '/Project' || doc_id % 97 || '-' || doc_id AS name, lang AS mainLanguage,
    CASE quality WHEN 1 THEN 'pass' ELSE 'review' END AS status, source AS owner, toxic,
    10 * greatest(doc_id % 5, doc_id % 3) + 4 * greatest(doc_id % 7, doc_id % 11)
      + least(greatest(n_chars % 60, n_chars % 40), 25) + doc_id % 9
      + CASE WHEN quality = 1 THEN CASE doc_id % 3 WHEN 0 THEN 20 WHEN 1 THEN 0 ELSE 8 END ELSE 0 END AS score
    FROM documents JOIN labels USING (doc_id))"""


@query("f18_difficulty_score", f"WITH {SCORED_SQL} SELECT name, score FROM scored")
def f18(t: Tables):
    score = labels.difficulty("candidate_documents_json", "candidate_count", "guideline_status", "guideline_path")
    return classified(t).select("name", score.alias("score"))


# Project names are unique here (they end in the document id), so only owners can clash.
@query(
    "o4_hard_cases",
    f"""WITH RECURSIVE {SCORED_SQL}, steps AS (SELECT * FROM (VALUES (1, 'en', 'pass', 1, 'subtle_confirmed'),
         (2, 'en', 'review', -1, 'dense_unconfirmed'), (3, 'en', 'review', 1, 'weak_unconfirmed'),
         (4, 'fr', 'pass', 1, 'subtle_confirmed'), (5, 'fr', 'review', -1, 'dense_unconfirmed'),
         (6, 'fr', 'review', 1, 'weak_unconfirmed')) v(step, lang, status, sign, stratum)),
       picks AS (
         SELECT CAST(0 AS BIGINT) AS step, CAST(NULL AS VARCHAR) AS name, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS stratum, CAST(NULL AS BIGINT) AS score
         UNION ALL
         SELECT p.step + 1, b.best.name, list_append(p.used, b.best.owner), b.stratum, b.best.score FROM picks p,
           LATERAL (SELECT any_value(s.stratum) AS stratum, arg_min(struct_pack(name := c.name, owner := c.owner, score := c.score),
             struct_pack(a := c.score * s.sign, b := lower(c.name))) AS best
             FROM steps s JOIN scored c ON c.mainLanguage = s.lang AND c.status = s.status AND c.toxic = 0
             WHERE s.step = p.step + 1 AND NOT list_contains(p.used, c.owner)) b
         WHERE p.step < 6)
       SELECT name, stratum AS sampling_stratum, score AS difficulty_score FROM picks WHERE step > 0""",
)
def o4(t: Tables):
    return sampling.hard_cases(classified(t), ("en", "fr"), (1, 1, 1)).select(
        "name", "sampling_stratum", "difficulty_score"
    )
