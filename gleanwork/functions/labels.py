"""Label verification, response parsing, token accounting and cost as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.text import strip

# Long-context pricing rule.
LONG_CONTEXT_TOKENS = 272_000
LONG_INPUT_MULTIPLIER = Decimal("2.0")
LONG_OUTPUT_MULTIPLIER = Decimal("1.5")

COST = T.DecimalType(18, 9)
# Fixed value: what ends a line of a quote.
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"


@dataclass(frozen=True)
class Rates:
    """US dollars per million tokens."""

    input: Decimal
    cached_input: Decimal
    cache_write_input: Decimal
    output: Decimal


# Published price lists.
PRICES = {
    "openrouter": Rates(Decimal("0.10"), Decimal("0.01"), Decimal("0.125"), Decimal("0.60")),
    "bedrock": Rates(Decimal("0.22"), Decimal("0.022"), Decimal("0.275"), Decimal("1.32")),
}

USAGE = T.StructType(
    [
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()),
        T.StructField(
            "input_tokens_details",
            T.StructType(
                [T.StructField("cached_tokens", T.LongType()), T.StructField("cache_write_tokens", T.LongType())]
            ),
        ),
        T.StructField("cost", T.DecimalType(18, 9)),
    ]
)
BODY = T.StructType(
    [
        T.StructField(
            "output",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField(
                            "content",
                            T.ArrayType(
                                T.StructType(
                                    [T.StructField("type", T.StringType()), T.StructField("text", T.StringType())]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
        T.StructField("usage", USAGE),
    ]
)
RESPONSE = T.StructType(
    [
        T.StructField("custom_id", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField(
            "response",
            T.StructType([T.StructField("status_code", T.IntegerType()), T.StructField("body", BODY)]),
        ),
        T.StructField("elapsed_seconds", T.DoubleType()),
    ]
)


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def label_status(label: Column | str, quote: Column | str, content: Column | str) -> Column:
    """Struct ``(status, reason)`` of a model label whose quote must occur verbatim."""
    label, quote, content = _c(label), _c(quote), _c(content)

    def outcome(status: str, reason: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))

    return (
        F.when((label == "YES") & (quote != "") & content.contains(quote), outcome("pass", "verified_quote"))
        .when(label == "YES", outcome("review", "yes_without_quote"))
        .when((label == "NO") & (quote != ""), outcome("review", "no_with_quote"))
        .when(label == "NO", outcome("not_found", "model_not_found"))
        .otherwise(outcome("review", "invalid_label"))
    )


def label_fields(document: Column | str) -> Column:
    """Parse one structured label; ``problem`` is null when every field has the right type.

    Fields are read as variants so that a number where text is due, or ``5.5`` where a whole
    number is due, is rejected instead of coerced.
    """
    value = F.try_parse_json(_c(document))

    def text(name: str) -> Column:
        return F.try_variant_get(value, f"$.{name}", "string")

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))

    confidence = F.try_variant_get(value, "$.confidence", "bigint")
    problem = F.when(value.isNull(), "response is not JSON").when(
        ~F.schema_of_variant(value).startswith("OBJECT"), "response is not an object"
    )
    for name in ("label", "reason", "quote", "confidence"):
        problem = problem.when(kind(name).isNull(), f"'{name}'")
    for name in ("label", "reason", "quote"):
        problem = problem.when(kind(name) != "STRING", f"{name} must be a string")
    problem = problem.when(
        (kind("confidence") != "BIGINT") | ~confidence.between(1, 10), "confidence must be an integer from 1 to 10"
    )
    return F.struct(
        problem.alias("problem"),
        text("label").alias("label"),
        text("reason").alias("reason"),
        text("quote").alias("quote"),
        confidence.cast("int").alias("confidence"),
    )


def output_text(body: Column | str) -> Column:
    """Concatenated ``output_text`` parts of a response body; null when there are none."""
    parts = F.flatten(
        F.transform(
            F.coalesce(_c(body)["output"], F.array().cast(BODY["output"].dataType)),
            lambda item: F.transform(
                F.filter(
                    F.coalesce(item["content"], F.array().cast("array<struct<type:string,text:string>>")),
                    lambda part: part["type"] == "output_text",
                ),
                lambda part: part["text"],
            ),
        )
    )
    # The one-element transform binds the parts, so they are built once.
    joined = F.transform(F.array(parts), lambda p: F.when(F.size(p) > 0, F.array_join(p, "")))
    return F.get(joined, F.lit(0))


def usage_fields(body: Column | str) -> Column:
    """Token usage with zeros for absent counts, and the reported cost (null when absent)."""
    usage = _c(body)["usage"]
    zero = F.lit(0).cast("long")
    cached = F.coalesce(usage["input_tokens_details"]["cached_tokens"], zero)
    written = F.coalesce(usage["input_tokens_details"]["cache_write_tokens"], zero)
    tokens = F.coalesce(usage["input_tokens"], zero)
    return F.struct(
        tokens.alias("input_tokens"),
        uncached_tokens(tokens, cached, written).alias("uncached_input_tokens"),
        cached.alias("cached_input_tokens"),
        written.alias("cache_write_input_tokens"),
        F.coalesce(usage["output_tokens"], zero).alias("output_tokens"),
        F.coalesce(usage["total_tokens"], zero).alias("total_tokens"),
        usage["cost"].alias("cost"),
    )


def uncached_tokens(tokens: Column | str, cached: Column | str, written: Column | str) -> Column:
    """Input tokens billed at the full rate; null when the parts exceed the whole."""
    value = _c(tokens) - _c(cached) - _c(written)
    return F.when(value >= 0, value)


def request_cost(
    tokens: Column | str, cached: Column | str, written: Column | str, output: Column | str, rates: Rates
) -> Column:
    """Exact decimal cost of one request, nine places, with the long-context multipliers."""
    tokens, cached, written, output = map(_c, (tokens, cached, written, output))
    long_context = tokens > LONG_CONTEXT_TOKENS

    def part(count: Column, rate: Decimal, multiplier: Decimal) -> Column:
        price = F.when(long_context, F.lit(rate * multiplier)).otherwise(F.lit(rate)).cast("decimal(9,4)")
        return count.cast("decimal(18,0)") * price

    total = (
        part(tokens - cached - written, rates.input, LONG_INPUT_MULTIPLIER)
        + part(cached, rates.cached_input, LONG_INPUT_MULTIPLIER)
        + part(written, rates.cache_write_input, LONG_INPUT_MULTIPLIER)
        + part(output, rates.output, LONG_OUTPUT_MULTIPLIER)
    )
    return (total.cast("decimal(24,4)") * F.lit(Decimal("0.000001"))).cast(COST)


def excerpt(content: Column | str, limit: Column | int) -> Column:
    """Head two thirds, a marker and the tail third when ``content`` is longer than ``limit``.

    A limit below the marker's own length leaves no room: the cut points then count back from the
    other end, as slices with negative bounds do, and the result is longer than the limit.
    """
    text = _c(content)
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    # Fixed value: the marker between head and tail.
    marker = "\n...[middle truncated by evaluator]...\n"
    room = limit - len(marker)
    head = F.floor(room * 2 / 3).cast("int")
    tail = (room - head).cast("int")
    size = F.length(text)
    crowded_head = F.when(head == 0, F.lit("")).otherwise(F.left(text, F.greatest(size + head, F.lit(0))))
    return (
        F.when(limit <= 0, F.lit(""))
        .when(size <= limit, text)
        .when(room <= 0, F.concat(crowded_head, F.lit(marker), F.substring(text, 1 - tail, size)))
        .otherwise(F.concat(F.substring(text, F.lit(1), head), F.lit(marker), F.right(text, tail)))
    )


def _newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def line_range(content: Column | str, quote: Column | str) -> Column:
    """``L3`` or ``L3-L5``: the lines a verbatim quote covers; null when it does not occur."""
    content, quote = _c(content), _c(quote)
    at = F.position(quote, content)
    start = _newlines(F.substring(content, F.lit(1), at - 1)) + 1
    end = start + _newlines(quote)
    return F.when(
        at > 0,
        F.when(start == end, F.concat(F.lit("L"), start)).otherwise(F.concat(F.lit("L"), start, F.lit("-L"), end)),
    )


def binary_outcome(model: Column | str, human: Column | str) -> Column:
    """TP / FP / FN / TN name of a (model, human) pair, null outside the 2×2 table."""
    model, human = _c(model), _c(human)
    return (
        F.when((model == "pass") & (human == "pass"), "true_positive")
        .when((model == "pass") & (human == "not_found"), "false_positive")
        .when((model == "not_found") & (human == "pass"), "false_negative")
        .when((model == "not_found") & (human == "not_found"), "true_negative")
    )


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Null when the denominator is zero."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def f1(precision: Column | str, recall: Column | str) -> Column:
    precision, recall = _c(precision), _c(recall)
    return F.try_divide(2 * precision * recall, precision + recall)


def review_round(origin: Column | str) -> Column:
    """Round number of an ``added_round_N`` origin, else null."""
    digits = F.regexp_extract(_c(origin), r"\Aadded_round_([1-9][0-9]*)\z", 1)
    return digits.try_cast("int")


def final_origin(origin: Column | str) -> Column:
    """``baseline`` or ``new``; null for an unknown origin."""
    value = strip(_c(origin))
    return F.when(value == "baseline", "baseline").when(
        value.isin("new", "new_confirmed", "new_pending"), "new"
    )


def quoted_reason(decision: Column | str, reason: Column | str, quote: Column | str, content: Column | str) -> Column:
    """Checklist note: line range, one-line quote and reason for a pass; reason alone otherwise."""
    decision, reason, quote, content = map(_c, (decision, reason, quote, content))
    # Fixed value: the label before the reason.
    label = F.concat(F.lit("理由："), reason)
    # A line break at the end begins no line of its own.
    one_line = F.regexp_replace(F.regexp_replace(quote, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK, " ")
    return F.when(decision == "not_found", label).otherwise(
        F.concat(F.lit("Evidence ("), line_range(content, quote), F.lit("): "), one_line, F.lit(" "), label)
    )


def difficulty(
    documents_json: Column | str, candidate_count: Column | str, status: Column | str, path: Column | str
) -> Column:
    """Difficulty score of a classified repository from its nested candidate documents."""
    documents = F.from_json(
        F.when(F.coalesce(_c(documents_json), F.lit("")) == "", F.lit("[]")).otherwise(_c(documents_json)),
        "array<struct<strong_matches:string,normative_matches:string,code_matches:string>>",
    )

    def best(name: str) -> Column:
        counts = F.transform(documents, lambda d: F.coalesce(d[name].try_cast("bigint"), F.lit(0).cast("bigint")))
        return F.coalesce(F.array_max(counts), F.lit(0).cast("bigint"))

    low = F.lower(F.coalesce(_c(path), F.lit("")))
    obvious = F.lit(False)
    for token in ("contribut", "style", "guideline", "develop", "hacking"):
        obvious = obvious | low.contains(token)
    ambiguity = F.when(low.contains("readme"), 20).when(obvious, 0).otherwise(8)
    return (
        best("strong_matches") * 10
        + best("normative_matches") * 4
        + F.least(best("code_matches"), F.lit(25).cast("bigint"))
        + F.coalesce(_c(candidate_count).try_cast("bigint"), F.lit(0).cast("bigint"))
        + F.when(_c(status) == "pass", ambiguity).otherwise(0)
    )
