"""Attempt-log replay, requests and responses, costs and roll-ups."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gleanwork.bindings.files import repositories
from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import ATTEMPTS_SQL, CANDIDATES_SQL, FILES_SQL, UNITS_SQL, Tables
from gleanwork.functions import labels, paths
from gleanwork.operators import attempts, costs, ordering, scoring
from gleanwork.session import materialize, shared_dir
from gleanwork.sources import readers, sinks
from gleanwork.streaming import attempts as streams

REPLAY_SQL = f"""{ATTEMPTS_SQL}, replayed AS (SELECT *, row_number() OVER w AS attempt_count,
    count(*) FILTER (status <> 'retrieval_error') OVER w AS model_attempt_count,
    count(*) FILTER (status = 'retrieval_error') OVER w AS retrieval_attempt_count FROM attempts
    WINDOW w AS (PARTITION BY custom_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  budgeted AS (SELECT *, (status = 'model_error' AND model_attempt_count >= 3) OR (status = 'retrieval_error'
    AND retrieval_attempt_count >= 2) AS retry_exhausted FROM replayed),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY custom_id ORDER BY seq DESC) AS back FROM budgeted) WHERE back = 1)"""


@query("w1_latest_attempt", f"WITH {REPLAY_SQL} SELECT custom_id, seq, status, input_tokens FROM latest")
def w1(t: Tables):
    return attempts.latest_attempts(t.attempts).select("custom_id", "seq", "status", "input_tokens")


@query(
    "w2_attempt_replay",
    f"""WITH {REPLAY_SQL} SELECT custom_id, seq, status, attempt_count, model_attempt_count, retrieval_attempt_count,
       retry_exhausted FROM budgeted""",
)
def w2(t: Tables):
    return attempts.replay(t.attempts).select(
        "custom_id", "seq", "status", "attempt_count", "model_attempt_count", "retrieval_attempt_count", "retry_exhausted"
    )


@query(
    "w2_attempt_replay_split",
    f"""WITH {REPLAY_SQL} SELECT custom_id, seq, attempt_count, model_attempt_count, retrieval_attempt_count, retry_exhausted
       FROM budgeted""",
)
def w2_split(t: Tables):
    """The same replay with every long history range-split, as a hot key would be."""
    return attempts.replay(t.attempts, max_group_rows=60).select(
        "custom_id", "seq", "attempt_count", "model_attempt_count", "retrieval_attempt_count", "retry_exhausted"
    )


@query(
    "r3_completed_ids",
    f"""WITH {REPLAY_SQL} SELECT custom_id, attempt_count FROM latest
       WHERE status NOT IN ('model_error', 'retrieval_error', 'snapshot_incomplete') OR retry_exhausted""",
)
def r3(t: Tables):
    return attempts.completed(attempts.attempt_state(t.attempts)).select("custom_id", "attempt_count")


@query(
    "j8_pending_work",
    f"""WITH {REPLAY_SQL}, done AS (SELECT custom_id FROM latest WHERE status NOT IN ('model_error', 'retrieval_error'))
       SELECT 'candidate-' || c_custkey AS custom_id FROM customer WHERE 'candidate-' || c_custkey NOT IN (SELECT custom_id FROM done)""",
)
def j8(t: Tables):
    state = attempts.attempt_state(t.attempts, 10**9, 10**9)
    requested = t.customer.select(F.concat(F.lit("candidate-"), "c_custkey").alias("custom_id"))
    return attempts.pending(requested, attempts.completed(state), ["custom_id"])


# Ten users share one repository position; its stored counters decide about a retry.
def screenings(t: Tables):
    grouped = t.attempts.groupBy((F.floor(F.col("user_id") / 10) + 1).alias("sample_order"))
    return grouped.agg(
        F.count("*").alias("n"),
        F.count_if((F.col("status") == "model_error") & (F.col("seq") % 1000 == 0)).alias("model_error_count"),
    ).select(
        "sample_order",
        F.concat(F.lit("org/repo"), "sample_order").alias("repository"),
        F.when(F.col("sample_order") % 3 == 0, "unresolved").otherwise("pass").alias("status"),
        (F.col("sample_order") % 4).alias("attempt_count"),
        "model_error_count",
        F.lit(0).cast("bigint").alias("retrieval_error_count"),
        F.lit(0).cast("bigint").alias("input_too_large_count"),
        (F.col("sample_order") % 2 == 1).alias("retryable"),
    )


@query(
    "r4_retryable_repositories",
    f"""WITH {REPLAY_SQL}, s AS (SELECT user_id // 10 + 1 AS sample_order,
         count(*) FILTER (status = 'model_error' AND seq % 1000 = 0) AS errors FROM attempts GROUP BY 1),
       again AS (SELECT DISTINCT user_id // 10 + 1 AS sample_order FROM latest
         WHERE (status = 'model_error' AND model_attempt_count < 60) OR (status = 'retrieval_error' AND retrieval_attempt_count < 14))
       SELECT sample_order, 'org/repo' || sample_order AS repository FROM s WHERE sample_order IN (SELECT sample_order FROM again)
         OR (sample_order % 3 = 0 AND errors = 0 AND sample_order % 2 = 1 AND sample_order % 4 < 3)""",
)
def r4(t: Tables):
    state = attempts.attempt_state(t.attempts, 60, 14).withColumn("sample_order", F.floor(F.col("user_id") / 10) + 1)
    return attempts.retryable_repositories(screenings(t), state).select("sample_order", "repository")


GATE_SQL = f"""{FILES_SQL}, repos AS (SELECT DISTINCT repository AS name, revision, lang FROM files),
  gate AS (SELECT name, CASE WHEN name IN (SELECT 'en-org/' || source FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND toxic = 1) THEN 'explicitly_excluded'
    WHEN lang = 'es' THEN 'retrieval_error' WHEN lang = 'fr' THEN 'snapshot_incomplete' ELSE 'ready' END AS gate,
    CASE WHEN name IN (SELECT 'en-org/' || source FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND toxic = 1) THEN 'explicitly_excluded'
    WHEN lang = 'es' THEN 'timeout' WHEN lang = 'fr' THEN 'object_missing: blob' ELSE '' END AS gate_reason FROM repos)"""


def gate(t: Tables):
    toxic = t.documents.where("lang = 'en'").join(t.labels.where("toxic = 1"), "doc_id", "left_semi")
    excluded = toxic.select(F.upper(F.concat(F.lit("en-org/"), "source")).alias("name"))
    bad = F.col("name").startswith("fr-")
    snapshots = repositories(t).select(
        "name",
        "lastCommitSHA",
        F.when(bad, "object_missing").otherwise("complete").alias("state"),
        F.when(bad, "blob").otherwise("").alias("detail"),
        (~bad).alias("complete"),
    )
    return attempts.repository_gate(repositories(t), excluded, snapshots)


@query("j21_repository_gate", f"WITH {GATE_SQL} SELECT name, gate, gate_reason FROM gate")
def j21(t: Tables):
    return gate(t).drop("lastCommitSHA")


@query(
    "j21_skip_records",
    f"""WITH {GATE_SQL}, c AS (SELECT doc_id, repository AS name FROM files)
       SELECT doc_id, gate AS status, gate_reason AS reason FROM c JOIN gate USING (name)
       WHERE gate <> 'ready' AND NOT (gate = 'explicitly_excluded' AND doc_id IN (SELECT doc_id FROM labels))""",
)
def j21_skips(t: Tables):
    rows = t.files.select(
        "doc_id", F.col("repository").alias("name"), F.col("revision").alias("lastCommitSHA"),
        F.col("doc_id").cast("string").alias("custom_id"),
    )
    done = t.labels.select(F.col("doc_id").cast("string").alias("custom_id"))
    return attempts.split_by_gate(rows, gate(t), done)[1].select("doc_id", "status", "reason")


# ---------------------------------------------------------------- costs


@query("a3_status_histogram", f"WITH {ATTEMPTS_SQL} SELECT status, count(*) AS rows FROM attempts GROUP BY 1")
def a3(t: Tables):
    return costs.status_histogram(t.attempts)


@query(
    "a4_cost_report",
    f"""WITH {REPLAY_SQL} SELECT count(*) AS sampled, count(*) FILTER (status IN ('pass','review','not_found')) AS completed,
         count(*) FILTER (status NOT IN ('pass','review','not_found')) AS errors, CAST(0 AS BIGINT) AS skipped_files,
         CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(uncached_input_tokens) AS BIGINT) AS uncached_input_tokens,
         CAST(sum(cached_input_tokens) AS BIGINT) AS cached_input_tokens,
         CAST(sum(cache_write_input_tokens) AS BIGINT) AS cache_write_input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
         CAST(sum(cost_usd) AS DOUBLE) AS pilot_cost_usd,
         CAST(sum(cost_usd) FILTER (status IN ('pass','review','not_found')) AS DOUBLE) / count(*) FILTER (status IN ('pass','review','not_found')) AS average_completed_cost_usd,
         count(*) FILTER (status IN ('pass','review','not_found') AND input_tokens <= 272000) AS short_context_requests,
         count(*) FILTER (status IN ('pass','review','not_found') AND input_tokens > 272000) AS long_context_requests FROM latest""",
)
def a4(t: Tables):
    report = costs.cost_report(attempts.latest_attempts(t.attempts))
    return report.withColumn("pilot_cost_usd", F.col("pilot_cost_usd").cast("double"))


STRATUM_SQL = f"""{ATTEMPTS_SQL}, rows AS (SELECT CAST(user_id % 5 + 1 AS INTEGER) AS stratum, status, cost_usd,
    (user_id % 5 + 1) * 100 AS stratum_population FROM attempts)"""


@query(
    "a5_extrapolated_cost",
    f"""WITH {STRATUM_SQL}, s AS (SELECT stratum, max(stratum_population) AS population,
         CAST(sum(cost_usd) FILTER (status <> 'model_error') AS DOUBLE) AS cost, count(*) FILTER (status <> 'model_error') AS n,
         sum(cost_usd) AS total FROM rows GROUP BY 1)
       SELECT round(sum(population * cost / n), 6) AS estimated_full_cost_usd, CAST(sum(total) AS DOUBLE) AS calculated_cost_usd FROM s""",
)
def a5(t: Tables):
    key = F.col("user_id") % 5 + 1
    rows = t.attempts.select(key.cast("int").alias("stratum"), "status", "cost_usd", (key * 100).alias("stratum_population"))
    return costs.extrapolated_cost(rows).withColumn("estimated_full_cost_usd", F.round("estimated_full_cost_usd", 6))


@query(
    "a6_billed_cost",
    f"""WITH {ATTEMPTS_SQL} SELECT user_id, CASE WHEN count(c) = count(*) THEN CAST(sum(c) AS DOUBLE) END AS billed_cost_usd
       FROM (SELECT user_id, CASE WHEN seq % 200 = 7 THEN NULL ELSE cost_usd END AS c FROM attempts) GROUP BY 1""",
)
def a6(t: Tables):
    rows = t.attempts.withColumn("cost_usd", F.when(F.col("seq") % 200 != 7, F.col("cost_usd")))
    out = costs.billed_cost(rows.groupBy("user_id"))
    return out.withColumn("billed_cost_usd", F.col("billed_cost_usd").cast("double"))


@query(
    "f12_uncached_tokens",
    f"""WITH {ATTEMPTS_SQL} SELECT seq, CASE WHEN seq % 10 = 0 THEN CASE WHEN input_tokens = 0 THEN 0 END
       ELSE uncached_input_tokens END AS uncached FROM attempts""",
)
def f12(t: Tables):
    total = F.when(F.col("seq") % 10 == 0, F.floor(F.col("input_tokens") / 5000)).otherwise(F.col("input_tokens"))
    return t.attempts.select(
        "seq", labels.uncached_tokens(total, "cached_input_tokens", "cache_write_input_tokens").alias("uncached")
    )


@query(
    "f13_request_cost",
    f"""WITH {ATTEMPTS_SQL}, m AS (SELECT *, CASE WHEN input_tokens > 272000 THEN 2.0 ELSE 1.0 END AS a,
         CASE WHEN input_tokens > 272000 THEN 1.5 ELSE 1.0 END AS b FROM attempts)
       SELECT seq, CAST(CAST((uncached_input_tokens * 0.22 * a + cached_input_tokens * 0.022 * a + cache_write_input_tokens * 0.275 * a
         + output_tokens * 1.32 * b) AS DECIMAL(24,4)) * 0.000001 AS DOUBLE) AS cost FROM m""",
)
def f13(t: Tables):
    cost = labels.request_cost(
        "input_tokens", "cached_input_tokens", "cache_write_input_tokens", "output_tokens", labels.PRICES["bedrock"]
    )
    return t.attempts.select("seq", cost.cast("double").alias("cost"))


@query(
    "a7_repository_rollup",
    f"""WITH {CANDIDATES_SQL}, labelled AS (SELECT name, CASE WHEN quality = 1 AND toxic = 0 AND input_index % 9 = 0 THEN 'pass'
           WHEN quality = 0 THEN 'not_found' WHEN toxic = 1 THEN 'model_error' WHEN quality = 1 AND input_index % 2 = 0 THEN 'not_found' END AS status
         FROM candidates c JOIN labels l ON l.doc_id = c.input_index),
       f AS (SELECT name, count(*) AS classified, count(*) FILTER (status = 'pass') AS p, count(*) FILTER (status = 'not_found') AS n,
         count(*) FILTER (status = 'model_error') AS m FROM labelled WHERE status IS NOT NULL GROUP BY 1),
       s AS (SELECT repository AS name, lang, count(*) FILTER (mode <> '120000' AND lower(path) LIKE '%.md' AND doc_id IN (SELECT doc_id FROM labels)) AS total
         FROM files GROUP BY 1, 2)
       SELECT s.name, total AS candidate_file_count, coalesce(classified, 0) AS classified_file_count, coalesce(p, 0) AS pass_count,
         coalesce(n, 0) AS not_found_count, coalesce(m, 0) AS model_error_count,
         CASE WHEN lang = 'es' THEN 'retrieval_error' WHEN total = 0 THEN 'no_candidates' WHEN coalesce(p, 0) > 0 THEN 'pass'
           WHEN coalesce(m, 0) > 0 THEN 'unresolved' WHEN coalesce(classified, 0) <> total THEN 'unresolved' ELSE 'not_found' END AS status
       FROM s LEFT JOIN f USING (name)""",
)
def a7(t: Tables):
    doc = F.col("input_index")
    status = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0) & (doc % 9 == 0), "pass")
        .when(F.col("quality") == 0, "not_found")
        .when(F.col("toxic") == 1, "model_error")
        .when((F.col("quality") == 1) & (doc % 2 == 0), "not_found")
    )
    labelled = t.candidates.join(t.labels.withColumnRenamed("doc_id", "input_index"), "input_index")
    files = labelled.withColumn("status", status).where(F.col("status").isNotNull())
    counts = labelled.groupBy("name", "lastCommitSHA").agg(F.count("*").alias("candidate_file_count"))
    summary = repositories(t).join(counts, ["name", "lastCommitSHA"], "left").fillna(0, ["candidate_file_count"])
    return costs.repository_rollup(summary, files).select(
        "name", "candidate_file_count", "classified_file_count", "pass_count", "not_found_count", "model_error_count", "status"
    )


@query(
    "j7_repository_report",
    f"""WITH {CANDIDATES_SQL}, gate AS (SELECT DISTINCT repository AS name, lang FROM files),
       f AS (SELECT name, count(*) AS n FROM candidates GROUP BY 1)
       SELECT g.name, coalesce(n, 0) AS classified_file_count, CASE WHEN lang = 'fr' THEN 'snapshot_incomplete'
         WHEN lang = 'es' THEN 'retrieval_error' WHEN coalesce(n, 0) = 0 THEN 'no_candidates' ELSE 'pass' END AS status,
         CASE WHEN lang = 'fr' THEN 'missing' WHEN lang = 'es' THEN 'timeout' ELSE '' END AS error
       FROM gate g LEFT JOIN f USING (name)""",
)
def j7(t: Tables):
    counts = t.candidates.groupBy("name", "lastCommitSHA").agg(F.count("*").alias("candidate_file_count"))
    summary = repositories(t).join(counts, ["name", "lastCommitSHA"], "left").fillna(0, ["candidate_file_count"])
    closed = F.col("name").startswith("fr-")
    states = repositories(t).select(
        "name",
        "lastCommitSHA",
        F.when(closed, "snapshot_incomplete").otherwise("ready").alias("gate"),
        F.when(closed, "missing").otherwise("").alias("gate_reason"),
    )
    files = t.candidates.withColumn("status", F.lit("review"))
    return costs.repository_rollup(summary, files, states).select("name", "classified_file_count", "status", "error")


@query(
    "a17_usage_totals",
    f"""WITH {ATTEMPTS_SQL} SELECT count(*) AS processed, count(*) FILTER (status = 'pass') AS selected,
         count(*) FILTER (status <> 'retrieval_error') AS model_calls, CAST(sum(cost_usd) AS DOUBLE) AS checkout_seconds,
         CAST(sum(cost_usd) * 2 AS DOUBLE) AS model_seconds, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
         CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS total_tokens FROM attempts""",
)
def a17(t: Tables):
    rows = t.attempts.select(
        (F.col("status") == "pass").alias("selected"),
        (F.col("status") != "retrieval_error").alias("model_called"),
        F.col("cost_usd").alias("checkout_seconds"),
        (F.col("cost_usd") * 2).alias("model_seconds"),
        "input_tokens",
        "output_tokens",
        (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
    )
    totals = costs.usage_totals(rows)
    return totals.withColumns({c: F.col(c).cast("double") for c in ("checkout_seconds", "model_seconds")})


@query(
    "a18_extraction_stats",
    f"""WITH {GATE_SQL}, done AS (SELECT name FROM repos WHERE lang = 'de') SELECT count(*) AS requested,
         count(*) FILTER (name IN (SELECT name FROM done)) AS skipped, count(*) FILTER (name NOT IN (SELECT name FROM done)) AS evaluated,
         count(*) FILTER (gate = 'snapshot_incomplete') AS incomplete_repositories,
         count(*) FILTER (gate = 'explicitly_excluded') AS explicitly_excluded_repositories,
         count(*) FILTER (gate NOT IN ('snapshot_incomplete', 'explicitly_excluded')) AS processed_repositories FROM gate""",
)
def a18(t: Tables):
    requested = t.files.select(F.col("repository").alias("name"), F.col("revision").alias("lastCommitSHA"))
    done = repositories(t).where(F.col("name").startswith("de-"))
    return costs.extraction_stats(requested, done, gate(t).withColumnRenamed("gate", "status"))


# ---------------------------------------------------------------- requests and responses


def with_bodies(t: Tables):
    return t.files.select(
        paths.stable_id("repository", "revision", "path", "sha").alias("custom_id"),
        F.col("repository").alias("name"),
        F.col("revision").alias("lastCommitSHA"),
        F.col("path").alias("markdown_path"),
        "content",
        "doc_id",
    )


ID_SQL = """'candidate-' || sha256('["' || repository || '","' || revision || '","' || path || '","' || sha || '"]')"""


@query(
    "f15_request_documents",
    f"""WITH {FILES_SQL} SELECT {ID_SQL} AS custom_id, repository, path, sha256(content) AS digest, 'm' AS model,
       CAST(500 AS INTEGER) AS max_output_tokens FROM files""",
)
def f15(t: Tables):
    prepared = costs.requests(with_bodies(t), "m", "high", 500)
    return readers.parse_requests(prepared, "request").select(
        "custom_id", "repository", "path", F.sha2("content", 256).alias("digest"), "model", "max_output_tokens"
    )


@query("s10_prepared_requests", f"WITH {FILES_SQL} SELECT {ID_SQL} AS custom_id, 'POST' AS method, '/v1/responses' AS url, 'high' AS effort, revision FROM files")
def s10(t: Tables):
    prepared = costs.requests(with_bodies(t), "m", "high", 500, instructions="Label the file.")
    return readers.parse_requests(prepared, "request").select("custom_id", "method", "url", "effort", "revision")


def rule_scorer():
    """A deterministic scorer: YES with the first words when the body holds "license"."""

    def answer(request):
        content = json.loads(request["body"]["input"])["content"]
        if "Le" in content[:40]:
            raise TimeoutError("slow")
        found = "license" in content
        label = {
            "label": "YES" if found else "NO",
            "reason": "rule",
            "quote": content[:12] if found else "",
            "confidence": 7,
        }
        usage = {"input_tokens": len(content), "output_tokens": 9, "total_tokens": len(content) + 9}
        text = {"type": "output_text", "text": json.dumps(label)}
        return {"output": [{"type": "message", "content": [text]}], "usage": usage}

    return answer


SCORED_SQL = f"""{FILES_SQL}, scored AS (SELECT doc_id, content, contains(substr(content, 1, 40), 'Le') AS failed,
    contains(content, 'license') AS found FROM files)"""


def answers(t: Tables):
    prepared = costs.requests(with_bodies(t), "m", "high", 500)
    return scoring.parsed_answers(scoring.score(prepared, rule_scorer()))


@query(
    "x1_scored_documents",
    f"""WITH {SCORED_SQL} SELECT doc_id, CASE WHEN failed THEN 'TimeoutError: slow' END AS error,
       CASE WHEN NOT failed THEN CAST(200 AS INTEGER) END AS status_code, CASE WHEN failed THEN NULL WHEN found THEN 'YES' ELSE 'NO' END AS label,
       CASE WHEN failed THEN NULL WHEN found THEN substr(content, 1, 12) ELSE '' END AS quote FROM scored""",
)
def x1(t: Tables):
    ids = with_bodies(t).select("custom_id", "doc_id")
    answer = F.from_json(labels.output_text("response.body"), "label string, quote string")
    return answers(t).join(ids, "custom_id").select(
        "doc_id", "error", F.col("response.status_code").alias("status_code"), answer["label"].alias("label"), answer["quote"].alias("quote")
    )


@query(
    "j6_result_rows",
    f"""WITH {SCORED_SQL} SELECT doc_id, CASE WHEN failed THEN 'model_error' WHEN found THEN 'pass' ELSE 'not_found' END AS status,
         CASE WHEN failed THEN 'request_error' WHEN found THEN 'verified_quote' ELSE 'model_not_found' END AS reason,
         CASE WHEN failed THEN 0 ELSE length(content) END AS input_tokens,
         CASE WHEN failed THEN 0 ELSE CAST(CAST(length(content) * 0.1 + 9 * 0.6 AS DECIMAL(24,4)) * 0.000001 AS DOUBLE) END AS cost_usd
       FROM scored""",
)
def j6(t: Tables):
    # Stored, so that the scorer runs once for outputs and errors.
    found = materialize(answers(t))
    outputs = found.where(F.col("response").isNotNull())
    errors = found.where(F.col("error").isNotNull())
    manifest = with_bodies(t).select("custom_id", "doc_id")
    rows = costs.result_rows(manifest, outputs, errors, with_bodies(t), labels.PRICES["openrouter"])
    return rows.select("doc_id", "status", "reason", "input_tokens", F.col("cost_usd").cast("double").alias("cost_usd"))


def stored_answers(t: Tables):
    """Response lines derived from the log: usage from the event, label text from its type."""
    a = t.attempts
    label = F.to_json(
        F.struct(
            F.when(F.col("status") == "pass", "YES").otherwise("NO").alias("label"),
            F.col("status").alias("reason"),
            F.lit("").alias("quote"),
            (F.col("seq") % 12).alias("confidence"),
        )
    )
    usage = F.struct(
        "input_tokens",
        "output_tokens",
        (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
        F.struct(
            F.col("cached_input_tokens").alias("cached_tokens"), F.col("cache_write_input_tokens").alias("cache_write_tokens")
        ).alias("input_tokens_details"),
        "cost_usd",
    )
    parts = F.array(
        F.struct(F.lit("reasoning").alias("type"), F.lit("x").alias("text")),
        F.struct(F.lit("output_text").alias("type"), F.substring(label, 1, 20).alias("text")),
        F.struct(F.lit("output_text").alias("type"), F.expr("substring({}, 21)".format("__label")).alias("text")),
    )
    output = F.array(F.struct(F.lit("message").alias("type"), parts.alias("content")))
    body = F.struct(
        F.when(F.col("seq") % 50 != 3, output).alias("output"),
        usage.withField("cost", F.col("cost_usd")).dropFields("cost_usd").alias("usage"),
    )
    document = F.struct(
        F.concat(F.lit("r"), "seq").alias("custom_id"),
        F.struct(F.when(F.col("status") == "retrieval_error", 500).otherwise(200).alias("status_code"), body.alias("body")).alias("response"),
    )
    return a.withColumn("__label", label).select("seq", "status", F.to_json(document).alias("value"))


@query(
    "s11_parsed_responses",
    f"""WITH {ATTEMPTS_SQL} SELECT 'r' || seq AS custom_id, CASE status WHEN 'retrieval_error' THEN CAST(500 AS INTEGER) ELSE 200 END AS status_code,
       input_tokens FROM attempts""",
)
def s11(t: Tables):
    return readers.parse_responses(stored_answers(t)).select(
        "custom_id", "response.status_code", F.col("response.body.usage.input_tokens").alias("input_tokens")
    )


@query(
    "f14_response_fields",
    f"""WITH {ATTEMPTS_SQL} SELECT 'r' || seq AS custom_id, CASE WHEN seq % 50 <> 3 THEN '{{"label":"' || CASE status WHEN 'pass' THEN 'YES' ELSE 'NO' END
         || '","reason":"' || status || '","quote":"","confidence":' || seq % 12 || '}}' END AS text, input_tokens,
         uncached_input_tokens, cached_input_tokens, cache_write_input_tokens, CAST(cost_usd AS DOUBLE) AS cost FROM attempts""",
)
def f14(t: Tables):
    parsed = readers.parse_responses(stored_answers(t))
    usage = labels.usage_fields(F.col("response.body"))
    return parsed.select("custom_id", labels.output_text(F.col("response.body")).alias("text"), usage.alias("u")).select(
        "custom_id", "text", "u.input_tokens", "u.uncached_input_tokens", "u.cached_input_tokens",
        "u.cache_write_input_tokens", F.col("u.cost").cast("double").alias("cost"),
    )


@query(
    "f10_label_fields",
    f"""WITH {ATTEMPTS_SQL} SELECT seq, CASE WHEN seq % 50 = 3 THEN 'response is not JSON' WHEN seq % 12 NOT BETWEEN 1 AND 10
         THEN 'confidence must be an integer from 1 to 10' END AS problem,
         CASE WHEN seq % 50 <> 3 THEN CASE status WHEN 'pass' THEN 'YES' ELSE 'NO' END END AS label FROM attempts""",
)
def f10(t: Tables):
    parsed = readers.parse_responses(stored_answers(t))
    fields = labels.label_fields(labels.output_text(F.col("response.body")))
    return parsed.select(F.substring("custom_id", 2, 20).cast("bigint").alias("seq"), fields.alias("f")).select(
        "seq", "f.problem", "f.label"
    )


@query(
    "f9_label_status",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'review' WHEN doc_id % 2 = 0 THEN CASE WHEN b.text IS NOT NULL AND contains(d.text, b.text)
         THEN 'pass' ELSE 'review' END WHEN b.text IS NOT NULL THEN 'review' ELSE 'not_found' END AS status,
         CASE WHEN doc_id % 5 = 4 THEN 'invalid_label' WHEN doc_id % 2 = 0 THEN CASE WHEN b.text IS NOT NULL AND contains(d.text, b.text)
         THEN 'verified_quote' ELSE 'yes_without_quote' END WHEN b.text IS NOT NULL THEN 'no_with_quote' ELSE 'model_not_found' END AS reason
       FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id""",
)
def f9(t: Tables):
    quotes = t.benchmark.select(F.col("item_id").alias("doc_id"), F.col("text").alias("quote"))
    d = t.documents.join(quotes, "doc_id", "left").withColumn("quote", F.coalesce("quote", F.lit("")))
    label = F.when(F.col("doc_id") % 5 == 4, "MAYBE").when(F.col("doc_id") % 2 == 0, "YES").otherwise("NO")
    return d.select("doc_id", labels.label_status(label, "quote", "text").alias("o")).select("doc_id", "o.*")


# ---------------------------------------------------------------- logs, streams and reports


@query("p18_report_projection", f"WITH {ATTEMPTS_SQL} SELECT custom_id, status, input_tokens, output_tokens FROM attempts")
def p18(t: Tables):
    wide = t.attempts.withColumn("provider_result", F.to_json(F.struct("*")))
    return readers.report_columns(wide, ("custom_id", "status", "input_tokens", "output_tokens"))


LOG_SQL = f"WITH {REPLAY_SQL} SELECT custom_id, seq, status FROM latest"


def log_folder(t: Tables, name: str) -> str:
    import uuid

    return f"{shared_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("s9_attempt_log_lines", f"WITH {ATTEMPTS_SQL} SELECT custom_id, seq, status, input_tokens, CAST(cost_usd AS DOUBLE) AS cost_usd FROM attempts")
def s9(t: Tables):
    folder = log_folder(t, "log")
    sinks.append_attempts(t.attempts.drop("user_id"), folder, "all")
    lines = materialize(readers.read_attempts(t.spark, folder))
    sound, broken = readers.split_torn(lines)
    assert broken.isEmpty()
    return sound.select("custom_id", "seq", "status", "input_tokens", F.col("cost_usd").cast("double").alias("cost_usd"))


@query("s15_prior_attempts", LOG_SQL)
def s15(t: Tables):
    folder = log_folder(t, "prior")
    sinks.append_attempts(t.attempts.where("status = 'pass'").drop("user_id"), folder, "pass")
    sinks.append_attempts(t.attempts.where("status <> 'pass'").drop("user_id"), folder, "other")
    prior = readers.read_attempts(t.spark, folder)
    return attempts.latest_attempts(prior.where("_corrupt_record is null"), "custom_id").select("custom_id", "seq", "status")


@query("k2_appended_attempts", f"WITH {ATTEMPTS_SQL} SELECT count(*) AS attempts, count(DISTINCT custom_id) AS ids, CAST(sum(seq) AS BIGINT) AS total FROM attempts")
def k2(t: Tables):
    folder = log_folder(t, "append")
    # The second batch is delivered twice.
    for passed in (True, False, False):
        sinks.append_attempts(t.attempts.where((F.col("status") == "pass") == passed), folder, f"passed-{passed}")
    back = t.spark.read.schema("custom_id string, seq bigint").json(folder)
    return back.agg(F.count("*").alias("attempts"), F.count_distinct("custom_id").alias("ids"), F.sum("seq").alias("total"))


@query("r1_streamed_latest", LOG_SQL)
def r1(t: Tables):
    source, state = log_folder(t, "in"), log_folder(t, "state")
    log = t.attempts.select("custom_id", "seq", "status")
    log.repartition(6).write.parquet(source)
    stream = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    streams.drain(stream, streams.upsert_latest(state, compact_every=2), log_folder(t, "offsets"))
    return streams.read_latest(t.spark, state, log.schema)


@query(
    "r2_streamed_retry_budgets",
    f"""WITH {REPLAY_SQL} SELECT custom_id, seq, status, attempt_count, model_attempt_count, retrieval_attempt_count,
       retry_exhausted FROM budgeted""",
)
def r2(t: Tables):
    """Log delivered out of order in many files, two a batch, with a third of the keys repeated."""
    source, out = log_folder(t, "in"), log_folder(t, "out")
    log = t.attempts.select("custom_id", "seq", "status")
    repeats = log.where(F.crc32("custom_id") % 3 == 0)
    log.unionByName(repeats).repartition(6, F.xxhash64("custom_id", "seq", F.rand(3))).write.parquet(source)
    stream = t.spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    counted = streams.budget_batches(out + "-state", out)
    streams.drain(stream, counted, log_folder(t, "offsets"))
    return streams.read_budgets(t.spark, out)


@query("o1_input_order", f"WITH {UNITS_SQL} SELECT input_index, name FROM units ORDER BY input_index")
def o1(t: Tables):
    return ordering.in_order(t.units.repartition(5, "name"), "input_index").select("input_index", "name")
