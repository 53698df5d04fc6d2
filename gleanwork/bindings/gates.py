"""Data-quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwork.bindings.quota import TARGET_VALUES, targets
from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import CANDIDATES_SQL, FILES_SQL, SCHEDULED_SQL, Tables
from gleanwork.operators import gates

POPULATION_SQL = """population AS (SELECT CASE WHEN p_partkey % 50 = 0 THEN p_brand ELSE replace(p_brand, '#', '-') || '/part' || p_partkey // 2 END AS name,
    CASE WHEN p_partkey % 60 = 1 THEN 'xyz' ELSE substr(sha256(p_name || p_partkey), 1, 40) END AS lastCommitSHA,
    CASE WHEN p_partkey % 70 = 2 THEN '20260101' WHEN p_size < 10 THEN '2025-12-31T23:59:59+00:00' ELSE '2026-01-01T00:00:00Z' END AS lastCommit,
    p_type AS mainLanguage, CASE WHEN p_partkey % 80 = 3 THEN 'many' ELSE CAST(p_size * 100 AS VARCHAR) END AS stargazers,
    CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS forks, CASE WHEN p_partkey % 90 = 4 THEN 'True' ELSE ' FALSE ' END AS isFork FROM part)"""


def population(t: Tables):
    k = F.col("p_partkey")
    return t.part.select(
        F.when(k % 50 == 0, F.col("p_brand"))
        .otherwise(F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit("/part"), F.floor(k / 2)))
        .alias("name"),
        F.when(k % 60 == 1, "xyz")
        .otherwise(F.substring(F.sha2(F.concat("p_name", k.cast("string")), 256), 1, 40))
        .alias("lastCommitSHA"),
        F.when(k % 70 == 2, "20260101")
        .when(F.col("p_size") < 10, "2025-12-31T23:59:59+00:00")
        .otherwise("2026-01-01T00:00:00Z")
        .alias("lastCommit"),
        F.col("p_type").alias("mainLanguage"),
        F.when(k % 80 == 3, "many").otherwise((F.col("p_size") * 100).cast("string")).alias("stargazers"),
        F.col("p_retailprice").cast("bigint").cast("string").alias("forks"),
        F.when(k % 90 == 4, "True").otherwise(" FALSE ").alias("isFork"),
    )


@query(
    "p1_population_format",
    f"""WITH {POPULATION_SQL} SELECT 'name_format' AS rule, name AS key, name AS detail FROM population WHERE NOT regexp_matches(name, '^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+$')
       UNION ALL SELECT 'revision_format', name, lastCommitSHA FROM population WHERE NOT regexp_matches(lastCommitSHA, '^[0-9a-fA-F]{{7,64}}$')
       UNION ALL SELECT 'timestamp_format', name, lastCommit FROM population WHERE lastCommit = '20260101'""",
)
def p1(t: Tables):
    return gates.population_format(population(t), enforce_window=False)


@query(
    "p2_snapshot_window",
    f"WITH {POPULATION_SQL} SELECT 'snapshot_window' AS rule, name AS key, lastCommit AS detail FROM population WHERE lastCommit LIKE '2025%'",
)
def p2(t: Tables):
    return gates.population_format(population(t)).where("rule = 'snapshot_window'")


CRITERIA_SQL = f"""{POPULATION_SQL}, broken AS (
    SELECT 'language' AS rule, name AS key, mainLanguage AS detail FROM population WHERE mainLanguage NOT IN ('ECONOMY', 'SMALL', 'LARGE')
    UNION ALL SELECT 'is_fork', name, isFork FROM population WHERE lower(trim(isFork)) <> 'false'
    UNION ALL SELECT 'stargazers_integer', name, stargazers FROM population WHERE try_cast(stargazers AS BIGINT) IS NULL
    UNION ALL SELECT 'stargazers_minimum', name, stargazers FROM population WHERE try_cast(stargazers AS BIGINT) < 1000
    UNION ALL SELECT 'forks_minimum', name, forks FROM population WHERE CAST(forks AS BIGINT) < 950
    UNION ALL SELECT 'missing_stratum', s, '0' FROM (VALUES ('ECONOMY'), ('SMALL'), ('LARGE')) v(s) WHERE s NOT IN (SELECT mainLanguage FROM population)
    UNION ALL SELECT 'duplicate_repository', lower(name), CAST(count(*) AS VARCHAR) FROM population GROUP BY lower(name) HAVING count(*) > 1)"""


def criteria(t: Tables):
    return gates.selection_criteria(population(t), {"stargazers": 1000, "forks": 950}, ("ECONOMY", "SMALL", "LARGE"))


@query("v1_selection_criteria", f"WITH {CRITERIA_SQL} SELECT * FROM broken")
def v1(t: Tables):
    return criteria(t)


@query("p3_numeric_minimums", f"WITH {CRITERIA_SQL} SELECT * FROM broken WHERE rule LIKE '%minimum' OR rule LIKE '%integer'")
def p3(t: Tables):
    return criteria(t).where("rule like '%minimum' or rule like '%integer'")


@query("p4_not_a_fork", f"WITH {CRITERIA_SQL} SELECT key, detail FROM broken WHERE rule = 'is_fork'")
def p4(t: Tables):
    return criteria(t).where("rule = 'is_fork'").select("key", "detail")


@query(
    "v2_duplicate_units",
    f"""WITH {POPULATION_SQL} SELECT 'duplicate_unit' AS rule, lower(name) AS key, CAST(count(*) AS VARCHAR) AS detail FROM population
       GROUP BY lower(name) HAVING count(*) > 1""",
)
def v2(t: Tables):
    return gates.duplicate_keys(population(t), F.lower("name"), "duplicate_unit")


@query(
    "j9_conflicting_strata",
    f"""WITH {POPULATION_SQL} SELECT 'conflicting_stratum' AS rule, lower(name) AS key, CAST(count(DISTINCT mainLanguage) AS VARCHAR) AS detail
       FROM population GROUP BY lower(name) HAVING count(DISTINCT mainLanguage) > 1""",
)
def j9_conflicts(t: Tables):
    return gates.conflicting_strata(population(t))


@query(
    "v3_missing_strata",
    """WITH w AS (SELECT * FROM (VALUES ('BUILDING'), ('MACHINERY'), ('FURNITURE'), ('SPACECRAFT')) v(s)),
       c AS (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1)
       SELECT 'missing_stratum' AS rule, s AS key, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM w LEFT JOIN c USING (s) WHERE coalesce(n, 0) < 300""",
)
def v3(t: Tables):
    return gates.missing_strata(t.customer, "c_mktsegment", ("BUILDING", "MACHINERY", "FURNITURE", "SPACECRAFT"), 300)


@query(
    "v3_uncovered_deficits",
    f"""WITH {SCHEDULED_SQL} SELECT 'uncovered_deficit' AS rule, language AS key, CAST(target AS VARCHAR) AS detail FROM {TARGET_VALUES}
       WHERE language NOT IN ('en', 'fr') AND target > (SELECT count(*) FROM scheduled s WHERE s.language = v.language AND license_name IN ('src3', 'src4'))""",
)
def v3_deficits(t: Tables):
    return gates.uncovered_deficits(
        t.scheduled.where("language in ('en', 'fr')"), targets(t), t.scheduled.where("license_name in ('src3', 'src4')")
    )


@query(
    "v4_unique_keys",
    """WITH k AS (SELECT CASE WHEN o_orderkey % 1000 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS k FROM orders)
       SELECT CASE WHEN k = '' THEN 'customer_blank' ELSE 'customer_duplicate' END AS rule, k AS key, CAST(count(*) AS VARCHAR) AS detail
       FROM k GROUP BY k HAVING k = '' OR count(*) > 1""",
)
def v4(t: Tables):
    key = F.when(F.col("o_orderkey") % 1000 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    return gates.unique_keys(t.orders, key, "customer")


@query(
    "s8_conflicting_candidates",
    f"""WITH {CANDIDATES_SQL}, both_rows AS (SELECT name, lastCommitSHA, markdown_path, blob_sha FROM candidates UNION ALL
         SELECT name, lastCommitSHA, markdown_path, CASE WHEN input_index % 40 = 0 OR size_bytes > 9000 THEN 'other' ELSE blob_sha END FROM candidates)
       SELECT 'conflicting_candidate' AS rule, name || ':' || lastCommitSHA || ':' || markdown_path AS key, CAST(count(DISTINCT blob_sha) AS VARCHAR) AS detail
       FROM both_rows GROUP BY name, lastCommitSHA, markdown_path HAVING count(DISTINCT blob_sha) > 1""",
)
def s8_conflicts(t: Tables):
    other = (F.col("input_index") % 40 == 0) | (F.col("size_bytes") > 9000)
    again = t.candidates.withColumn("blob_sha", F.when(other, "other").otherwise(F.col("blob_sha")))
    return gates.conflicting_candidates(t.candidates.unionByName(again))


@query(
    "u5_set_equality",
    """WITH a AS (SELECT DISTINCT o_custkey AS custkey FROM orders), b AS (SELECT c_custkey AS custkey FROM customer WHERE c_nationkey <> 3)
       SELECT 'customer_set' AS rule, CAST(coalesce(a.custkey, b.custkey) AS VARCHAR) AS key,
         CASE WHEN b.custkey IS NULL THEN 'left_only' ELSE 'right_only' END AS detail FROM a FULL JOIN b ON a.custkey = b.custkey
       WHERE a.custkey IS NULL OR b.custkey IS NULL""",
)
def u5(t: Tables):
    return gates.set_difference(
        t.orders.select(F.col("o_custkey").alias("custkey")),
        t.customer.where("c_nationkey <> 3").select(F.col("c_custkey").alias("custkey")),
        ["custkey"],
        "customer_set",
    )


@query(
    "u6_disjoint_sets",
    "SELECT 'overlap' AS rule, CAST(s_nationkey AS VARCHAR) AS key, '' AS detail FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < 100) GROUP BY s_nationkey",
)
def u6_disjoint(t: Tables):
    return gates.overlap(
        t.supplier.select(F.col("s_nationkey").alias("nation")),
        t.customer.where("c_acctbal < 100").select(F.col("c_nationkey").alias("nation")),
        ["nation"],
        "overlap",
    )


@query(
    "v10_answers_match_requests",
    """SELECT 'answer_set' AS rule, CAST(doc_id AS VARCHAR) AS key, 'left_only' AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
       UNION ALL SELECT 'answer_set', CAST(-1 - n_nationkey AS VARCHAR), 'right_only' FROM nation""",
)
def v10(t: Tables):
    strays = t.nation.select((-1 - F.col("n_nationkey")).cast("bigint").alias("doc_id"))
    return gates.set_difference(
        t.documents.select("doc_id"), t.labels.select("doc_id").unionByName(strays), ["doc_id"], "answer_set"
    )


@query(
    "v11_single_configuration",
    """SELECT 'mixed_configuration' AS rule, min(lang || '|' || source) AS key, CAST(count(DISTINCT lang || '|' || source) AS VARCHAR) AS detail FROM documents""",
)
def v11(t: Tables):
    return gates.single_configuration(t.documents, ["lang", "source"])


@query(
    "j5_document_identity",
    f"""WITH {FILES_SQL} SELECT 'candidate_absent' AS rule, CAST(doc_id AS VARCHAR) AS key, 'u' || doc_id AS detail FROM files WHERE doc_id % 43 = 0
       UNION ALL SELECT 'input_absent', CAST(doc_id AS VARCHAR), 'u' || doc_id FROM files WHERE lang = 'es'
       UNION ALL SELECT 'identity_differs', CAST(doc_id AS VARCHAR), 'u' || doc_id FROM files WHERE doc_id % 43 <> 0 AND lang <> 'es'
         AND (doc_id % 47 = 0 OR doc_id % 53 = 0)""",
)
def j5(t: Tables):
    doc = F.col("doc_id")
    url, custom_id = F.concat(F.lit("u"), "doc_id"), doc.cast("string")
    labels = t.files.select(
        custom_id.alias("custom_id"), url.alias("markdown_url"), F.col("repository").alias("name"), F.col("path").alias("markdown_path")
    )
    candidates = t.files.where("doc_id % 43 <> 0").select(
        url.alias("markdown_url"), F.col("repository").alias("name"),
        F.when(doc % 47 == 0, "other").otherwise(F.col("path")).alias("markdown_path"),
    )
    inputs = t.files.where("lang <> 'es'").select(
        custom_id.alias("custom_id"), F.when(doc % 53 == 0, "x/y").otherwise(F.col("repository")).alias("repository"), "path"
    )
    return gates.document_identity(candidates, labels, inputs)


@query(
    "v9_incompatible_settings",
    """WITH now AS (SELECT c_name AS name, CAST(c_acctbal AS BIGINT) + CASE WHEN c_custkey % 25 = 0 THEN 1 ELSE 0 END AS value FROM customer WHERE c_nationkey <> 7)
       SELECT 'setting_changed' AS rule, c_name AS key, CASE WHEN c_nationkey = 7 THEN 'absent' ELSE CAST((SELECT value FROM now WHERE now.name = c_name) AS VARCHAR) END AS detail
       FROM customer WHERE c_nationkey = 7 OR c_custkey % 25 = 0""",
)
def v9(t: Tables):
    # Whole numbers as SQL's cast gives them: a half goes to the even neighbour.
    whole = F.bround("c_acctbal").cast("bigint")
    old = t.customer.select(F.col("c_name").alias("name"), whole.cast("string").alias("value"))
    policy = t.spark.createDataFrame([("license_policy_status", "pending"), ("license_allowlist", "")], "name string, value string")
    applied = t.spark.createDataFrame([("license_policy_status", "applied"), ("license_allowlist", "[MIT]")], "name string, value string")
    new = t.customer.where("c_nationkey <> 7").select(
        F.col("c_name").alias("name"),
        (whole + F.when(F.col("c_custkey") % 25 == 0, 1).otherwise(0)).cast("string").alias("value"),
    )
    return gates.incompatible_settings(old.unionByName(policy), new.unionByName(applied))


@query(
    "v9_incompatible_prior",
    """SELECT 'setting_changed' AS rule, 'exclude_csv_fingerprints' AS key, string_agg(md5(c_name || 'x'), ',' ORDER BY md5(c_name || 'x')) AS detail FROM customer
       UNION ALL SELECT 'setting_changed', 'sample_seed', CAST(count(*) + 1 AS VARCHAR) FROM customer""",
)
def v9_prior(t: Tables):
    """The inputs moved to another folder, the exclusions and the seed changed, and a setting outside the list too."""
    names = t.customer.select("c_name")

    def fingerprints(setting: str, folder: str, extra: str):
        entry = F.struct(F.concat(F.lit(folder), "c_name").alias("path"), F.md5(F.concat("c_name", F.lit(extra))).alias("hash"))
        return names.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).select(F.lit(setting).alias("name"), "value")

    def seed(more: int):
        count = (F.count("*") + more).cast("string").alias("value")
        return names.agg(count).select(F.lit("sample_seed").alias("name"), "value").unionByName(
            names.agg(count).select(F.lit("output_folder").alias("name"), "value")
        )

    prior = fingerprints("input_fingerprints", "old/", "").unionByName(fingerprints("exclude_csv_fingerprints", "", ""))
    current = fingerprints("input_fingerprints", "new/", "").unionByName(fingerprints("exclude_csv_fingerprints", "", "x"))
    return gates.incompatible_prior(prior.unionByName(seed(0)), current.unionByName(seed(1)))
