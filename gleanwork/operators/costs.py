"""Result rows from requests and responses, costs, and file-to-repository roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from gleanwork.functions import labels
from gleanwork.functions.labels import COST, Rates
from gleanwork.operators.attempts import CLASSIFIED_STATUSES, SKIPPED_STATUSES

# Name of the structured output and defaults of one request.
REQUEST_SCHEMA_NAME = "code_test_rule_label"
REQUEST_URL = "/v1/responses"
REPOSITORY_KEY = ["name", "lastCommitSHA"]
TOKEN_COLUMNS = (
    "input_tokens", "uncached_input_tokens", "cached_input_tokens", "cache_write_input_tokens", "output_tokens",
)


def requests(
    candidates: DataFrame,
    model: str,
    effort: str,
    max_output_tokens: int,
    instructions: str = "",
    output_schema: str = "{}",
) -> DataFrame:
    """One request document per candidate with content: ``custom_id`` and JSON ``request``.

    ``output_schema`` is the JSON schema text of the structured answer, supplied by the caller.
    """
    payload = F.to_json(
        F.struct(
            F.col("name").alias("repository"),
            F.col("lastCommitSHA").alias("revision"),
            F.col("markdown_path").alias("path"),
            "content",
        )
    )
    body = F.struct(
        F.lit(model).alias("model"),
        F.lit(instructions).alias("instructions"),
        payload.alias("input"),
        F.struct(F.lit(effort).alias("effort")).alias("reasoning"),
        F.lit(max_output_tokens).alias("max_output_tokens"),
        F.lit(False).alias("store"),
        F.struct(
            F.struct(
                F.lit("json_schema").alias("type"),
                F.lit(REQUEST_SCHEMA_NAME).alias("name"),
                F.lit(True).alias("strict"),
                F.parse_json(F.lit(output_schema)).alias("schema"),
            ).alias("format")
        ).alias("text"),
    )
    document = F.struct("custom_id", F.lit("POST").alias("method"), F.lit(REQUEST_URL).alias("url"), body.alias("body"))
    return candidates.select("custom_id", F.to_json(document).alias("request"))


def _money(rates: Rates) -> Column:
    return labels.request_cost("input_tokens", "cached_input_tokens", "cache_write_input_tokens", "output_tokens", rates)


def result_rows(
    manifest: DataFrame, outputs: DataFrame, errors: DataFrame | None, contents: DataFrame, rates: Rates
) -> DataFrame:
    """One verified, costed row per manifest request.

    ``outputs`` and ``errors`` carry the parsed response struct columns keyed by ``custom_id``;
    ``contents`` has ``custom_id, content``. A request without any answer is a missing result.
    """
    answers = outputs.select("custom_id", F.col("response").alias("__response"))
    joined = manifest.join(answers, "custom_id", "left")
    failed = F.lit(False)
    if errors is not None:
        marks = errors.select("custom_id", F.lit(True).alias("__failed"))
        joined = joined.join(marks, "custom_id", "left")
        failed = F.coalesce("__failed", F.lit(False))
    joined = joined.join(contents.select("custom_id", F.col("content").alias("__content")), "custom_id", "left")
    parsed = joined.withColumns(
        {
            "__text": labels.output_text(F.col("__response.body")),
            "__usage": labels.usage_fields(F.col("__response.body")),
        }
    ).withColumn("__label", labels.label_fields("__text"))
    answered = F.col("__response").isNotNull()
    good_status = F.coalesce(F.col("__response.status_code"), F.lit(0)) == 200
    problem = (
        F.when(~answered & failed, "request_error")
        .when(~answered, "missing_result")
        .when(~good_status, "response_status_error")
        .when(F.col("__text").isNull(), "invalid_model_response:OpenAI Responses result did not contain output_text")
        .when(
            F.col("__label.problem").isNotNull(), F.concat(F.lit("invalid_model_response:"), F.col("__label.problem"))
        )
        .when(
            F.col("__usage.uncached_input_tokens").isNull(),
            "invalid_model_response:cached and cache-write input tokens exceed total input tokens",
        )
        .when(
            F.col("__usage.cost") < 0,
            "invalid_model_response:Responses usage.cost must be a non-negative number",
        )
    )
    outcome = labels.label_status("__label.label", "__label.quote", "__content")
    checked = parsed.withColumns({"__problem": problem, "__outcome": outcome})
    ok = F.col("__problem").isNull()
    tokens = {
        name: F.when(ok, F.col(f"__usage.{name}")).otherwise(F.lit(0).cast("bigint"))
        for name in (*TOKEN_COLUMNS, "total_tokens")
    }
    rows = checked.withColumns(
        {
            "status": F.when(ok, F.col("__outcome.status")).otherwise("model_error"),
            "model_label": F.when(ok, F.col("__label.label")).otherwise(""),
            "model_reason": F.when(ok, F.col("__label.reason")).otherwise(""),
            "quote": F.when(ok, F.col("__label.quote")).otherwise(""),
            "confidence": F.when(ok, F.col("__label.confidence")).otherwise(0),
            "reason": F.when(ok, F.col("__outcome.reason")).otherwise(F.col("__problem")),
            **tokens,
        }
    )
    reported = F.when(F.col("__problem").isNull(), F.col("__usage.cost"))
    rows = rows.withColumn("cost_usd", F.coalesce(reported, _money(rates)).cast(COST))
    return rows.drop(*(c for c in rows.columns if c.startswith("__")))


def status_histogram(rows: DataFrame, column: str = "status") -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("rows"))


def cost_report(rows: DataFrame, completed: tuple[str, ...] = CLASSIFIED_STATUSES) -> DataFrame:
    """One-row token and cost totals over the latest attempts."""
    done = F.col("status").isin(*completed)
    skipped = F.col("status").isin(*SKIPPED_STATUSES)
    done_cost = F.sum(F.when(done, F.col("cost_usd")))
    return rows.agg(
        F.count("*").alias("sampled"),
        F.count_if(done).alias("completed"),
        F.count_if(~done & ~skipped).alias("errors"),
        F.count_if(skipped).alias("skipped_files"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in TOKEN_COLUMNS),
        F.coalesce(F.sum("cost_usd"), F.lit(0).cast(COST)).alias("pilot_cost_usd"),
        F.coalesce(F.try_divide(done_cost.cast("double"), F.count_if(done).cast("double")), F.lit(0.0)).alias(
            "average_completed_cost_usd"
        ),
        F.count_if(done & (F.col("input_tokens") <= labels.LONG_CONTEXT_TOKENS)).alias("short_context_requests"),
        F.count_if(done & (F.col("input_tokens") > labels.LONG_CONTEXT_TOKENS)).alias("long_context_requests"),
    )


def billed_cost(outputs: DataFrame | GroupedData, cost: str = "cost_usd") -> DataFrame:
    """Sum of reported costs, or null when any response lacks one; per group when grouped."""
    return outputs.agg(F.when(F.count(cost) == F.count("*"), F.coalesce(F.sum(cost), F.lit(0))).alias("billed_cost_usd"))


def extrapolated_cost(rows: DataFrame, strata_count: int = 5, billed: float | None = None) -> DataFrame:
    """Σ population × mean cost over the strata; null unless every stratum has a completed row."""
    done = F.col("status") != "model_error"
    per_stratum = rows.groupBy("stratum").agg(
        F.max("stratum_population").alias("population"),
        F.sum(F.when(done, F.col("cost_usd"))).alias("cost"),
        F.count_if(done).alias("completed"),
        F.sum("cost_usd").alias("all_cost"),
    )
    share = F.try_divide(F.col("population") * F.col("cost").cast("double"), F.col("completed").cast("double"))
    total = per_stratum.agg(
        F.when(
            F.count_if((F.col("completed") > 0) & F.col("stratum").between(1, strata_count)) == strata_count,
            F.sum(share),
        ).alias("estimated_full_cost_usd"),
        F.sum("all_cost").cast("double").alias("calculated_cost_usd"),
    )
    if billed is None:
        return total
    scaled = F.when(
        F.col("calculated_cost_usd") != 0, F.col("estimated_full_cost_usd") * billed / F.col("calculated_cost_usd")
    ).otherwise(F.col("estimated_full_cost_usd"))
    return total.withColumn("estimated_full_cost_usd", scaled)


# The file statuses counted per repository.
COUNTED_STATUSES = ("pass", "not_found", "review", "model_error", "retrieval_error", "input_too_large")


def repository_rollup(summary: DataFrame, files: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """File labels rolled up to repositories: counts first, then one join and a precedence status.

    ``summary`` has ``name, lastCommitSHA, status, error, candidate_file_count``; a gate state
    other than ``ready`` overrides status and error.
    """
    counted = files.groupBy(*REPOSITORY_KEY).agg(
        F.count("*").alias("classified_file_count"),
        *(F.count_if(F.col("status") == status).alias(f"{status}_count") for status in COUNTED_STATUSES),
    )
    counts = [c for c in counted.columns if c not in REPOSITORY_KEY]
    joined = summary.select(
        *REPOSITORY_KEY, F.col("status").alias("extraction_status"), "error", "candidate_file_count"
    ).join(counted, REPOSITORY_KEY, "left")
    joined = joined.fillna(0, counts)
    status = (
        F.when(F.col("extraction_status") != "completed", F.col("extraction_status"))
        .when(F.col("candidate_file_count") == 0, "no_candidates")
        .when(F.col("pass_count") + F.col("review_count") > 0, "pass")
        .when(F.col("model_error_count") + F.col("retrieval_error_count") + F.col("input_too_large_count") > 0, "unresolved")
        .when(F.col("classified_file_count") != F.col("candidate_file_count"), "unresolved")
        .otherwise("not_found")
    )
    if gate is None:
        return joined.withColumn("status", status)
    return (
        joined.join(gate, REPOSITORY_KEY, "left")
        .withColumn("__closed", F.coalesce(F.col("gate") != "ready", F.lit(False)))
        .withColumn("status", F.when(F.col("__closed"), F.col("gate")).otherwise(status))
        .withColumn("error", F.when(F.col("__closed"), F.col("gate_reason")).otherwise(F.col("error")))
        .drop("__closed", "gate", "gate_reason")
    )


def screening_status(rollup_status: Column | str) -> Column:
    """Repository outcome kept by the collection: anything not final is unresolved."""
    value = F.col(rollup_status) if isinstance(rollup_status, str) else rollup_status
    return F.when(value.isin("pass", "not_found", "no_candidates"), value).otherwise("unresolved")


def usage_totals(records: DataFrame) -> DataFrame:
    """One-row run summary: processed, selected, calls, seconds and tokens."""
    return records.agg(
        F.count("*").alias("processed"),
        F.count_if("selected").alias("selected"),
        F.count_if("model_called").alias("model_calls"),
        F.sum("checkout_seconds").alias("checkout_seconds"),
        F.sum("model_seconds").alias("model_seconds"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    )


def extraction_stats(requested: DataFrame, done_before: DataFrame, results: DataFrame) -> DataFrame:
    """One-row extraction run counts over distinct requested repositories."""
    wanted = requested.select(*REPOSITORY_KEY).distinct()
    marked = (
        wanted.join(done_before.select(*REPOSITORY_KEY, F.lit(True).alias("__done")), REPOSITORY_KEY, "left")
        .join(results.select(*REPOSITORY_KEY, "status"), REPOSITORY_KEY, "left")
    )
    incomplete = F.col("status") == "snapshot_incomplete"
    excluded = F.col("status") == "explicitly_excluded"
    return marked.agg(
        F.count("*").alias("requested"),
        F.count("__done").alias("skipped"),
        F.count_if(F.col("__done").isNull()).alias("evaluated"),
        F.count_if(incomplete).alias("incomplete_repositories"),
        F.count_if(excluded).alias("explicitly_excluded_repositories"),
        F.count_if(F.col("status").isNotNull() & ~incomplete & ~excluded).alias("processed_repositories"),
    )
