"""Model labels against human labels: joins, matrices and metrics (all unrounded)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.labels import binary_outcome, f1, ratio
from gleanwork.functions.text import strip

# Label domains.
STATUSES = ("pass", "review", "not_found")
HUMAN_DECISIONS = ("pass", "not_found")
MODEL_DECISIONS = ("pass", "not_found", "review", "model_error", "missing_prediction")
OUTCOMES = (
    "true_positive", "false_positive", "false_negative", "true_negative", "review", "model_error", "missing_prediction",
)


def evaluated_files(checklist: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per human-labelled file with its outcome.

    A model status outside the known decisions drops the row, though it still counts as labelled.
    """
    human = checklist.select(
        strip("repository").alias("repository"),
        strip("github_url").alias("github_url"),
        strip("human_decision").alias("human_decision"),
        strip(F.col("note") if "note" in checklist.columns else F.lit("")).alias("human_note"),
    ).where(F.col("human_decision").isin(*HUMAN_DECISIONS))
    optional = {
        name: (strip(F.col(name).cast("string")) if name in predictions.columns else F.lit(""))
        for name in ("markdown_path", "confidence", "model_reason", "quote")
    }
    model = predictions.select(
        strip("markdown_url").alias("github_url"),
        strip("status").alias("llm_decision"),
        *(value.alias(name) for name, value in optional.items()),
        F.lit(True).alias("__found"),
    )
    joined = human.join(model, "github_url", "left")
    outcome = F.when(F.col("__found").isNull(), "missing_prediction").otherwise(
        F.coalesce(
            binary_outcome("llm_decision", "human_decision"),
            F.when(F.col("llm_decision").isin("review", "model_error"), F.col("llm_decision")),
        )
    )
    return (
        joined.withColumn("outcome", outcome)
        .where(F.col("outcome").isNotNull())
        .drop("__found")
        .fillna("", ["llm_decision", *optional])
    )


def _outcome_count(*names: str):
    return F.count_if(F.col("outcome").isin(*names))


def _counts() -> list:
    plural = {"review": "review_decisions", "model_error": "model_errors"}
    return [_outcome_count(name).alias(plural.get(name, f"{name}s")) for name in OUTCOMES]


def binary_metrics(files: DataFrame, human_labeled: DataFrame | None = None) -> DataFrame:
    """Counts and the nine metrics in one row.

    ``human_labeled`` is the one-row count of labelled files (``human_labeled_files``) when some
    of them were dropped from ``files``; otherwise the rows themselves are counted.
    """
    counted = files.agg(*_counts(), F.count("*").alias("human_labeled_files"))
    if human_labeled is not None:
        total = human_labeled.select("human_labeled_files").scalar()
        counted = counted.withColumn("human_labeled_files", total)
    tp, fp, fn, tn = (F.col(f"{name}s") for name in OUTCOMES[:4])
    resolved = tp + fp + fn + tn
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return counted.withColumns(
        {
            "resolved_predictions": resolved,
            "resolved_accuracy": ratio(tp + tn, resolved),
            "strict_accuracy": ratio(tp + tn, "human_labeled_files"),
            "resolution_rate": ratio(resolved, "human_labeled_files"),
            "precision": precision,
            "recall": recall,
            "specificity": ratio(tn, tn + fp),
            "f1": f1(precision, recall),
            "false_positive_rate": ratio(fp, fp + tn),
            "false_negative_rate": ratio(fn, fn + tp),
        }
    )


def labeled_count(checklist: DataFrame) -> DataFrame:
    """Checklist rows and how many carry a human decision."""
    return checklist.agg(
        F.count("*").alias("checklist_rows"),
        F.count_if(strip("human_decision").isin(*HUMAN_DECISIONS)).alias("human_labeled_files"),
    )


def decision_matrix(files: DataFrame) -> DataFrame:
    """2×5 matrix in long form, zero-filled; the cell list is fixed by the two domains."""
    observed = files.groupBy(
        "human_decision",
        F.when(F.col("llm_decision") == "", "missing_prediction").otherwise(F.col("llm_decision")).alias("llm_decision"),
    ).agg(F.count("*").alias("files"))
    cells = files.sparkSession.createDataFrame(
        [(h, m) for h in HUMAN_DECISIONS for m in MODEL_DECISIONS], "human_decision string, llm_decision string"
    )
    return cells.join(observed, ["human_decision", "llm_decision"], "left").fillna(0, ["files"])


def repository_metrics(files: DataFrame) -> DataFrame:
    """Per-repository counts and accuracies; sort with :func:`worst_first` at the sink."""
    counted = files.groupBy("repository").agg(F.count("*").alias("human_labeled_files"), *_counts())
    tp, fp, fn, tn = (F.col(f"{name}s") for name in OUTCOMES[:4])
    resolved = tp + fp + fn + tn
    return counted.withColumns(
        {
            "resolved_predictions": resolved,
            "resolved_accuracy": ratio(tp + tn, resolved),
            "strict_accuracy": ratio(tp + tn, "human_labeled_files"),
        }
    )


def worst_first(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("false_positives"), F.desc("false_negatives"), F.lower("repository"))


def repository_scope(files: DataFrame) -> DataFrame:
    """Distinct repositories: labelled, human-pass, model-pass."""
    return files.agg(
        F.count_distinct("repository").alias("human_labeled_repositories"),
        F.count_distinct(F.when(F.col("human_decision") == "pass", F.col("repository"))).alias("human_pass_repositories"),
        F.count_distinct(F.when(F.col("llm_decision") == "pass", F.col("repository"))).alias("llm_pass_repositories"),
    )


def input_repositories(rows: DataFrame) -> DataFrame:
    """One-row count of distinct non-blank names in the evaluated input."""
    name = F.nullif(strip("name"), F.lit(""))
    return rows.agg(F.count_distinct(name).alias("input_repositories"))


def matched_labels(gold: DataFrame, predictions: DataFrame, split: str | None = None) -> DataFrame:
    """Gold ⋈ prediction on (repository, revision); see :func:`gleanwork.operators.gates.unmatched_gold`."""
    rows = gold if split is None else gold.where(F.col("split") == split)
    model = predictions.select(
        F.col("name").alias("repository"),
        F.col("lastCommitSHA").alias("revision"),
        F.col("guideline_status").alias("predicted"),
        *(
            (F.col(source) if source in predictions.columns else F.lit("")).alias(target)
            for source, target in (
                ("guideline_reason", "reason"), ("guideline_path", "evidence_path"), ("guideline_evidence", "evidence_quote"),
            )
        ),
    )
    return rows.select("repository", "revision", F.col("status").alias("expected")).join(
        model, ["repository", "revision"]
    )


def confusion_matrix(matched: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Square matrix in long form, zero-filled."""
    observed = matched.groupBy("expected", "predicted").agg(F.count("*").alias("rows"))
    cells = matched.sparkSession.createDataFrame(
        [(e, p) for e in statuses for p in statuses], "expected string, predicted string"
    )
    return cells.join(observed, ["expected", "predicted"], "left").fillna(0, ["rows"])


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Per class: precision, recall, F1 (zero for empty denominators) and support."""
    cells = confusion.select(
        F.explode(F.array(F.struct(F.col("expected").alias("status"), F.lit(True).alias("truth")),
                          F.struct(F.col("predicted").alias("status"), F.lit(False).alias("truth")))).alias("side"),
        "rows",
        (F.col("expected") == F.col("predicted")).alias("hit"),
    ).select("side.*", "rows", "hit")
    zero = F.lit(0.0)
    sums = cells.groupBy("status").agg(
        F.sum(F.when(F.col("hit") & F.col("truth"), F.col("rows")).otherwise(0)).alias("hits"),
        F.sum(F.when(~F.col("truth"), F.col("rows")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("truth"), F.col("rows")).otherwise(0)).alias("support"),
    )
    return sums.select(
        "status",
        F.coalesce(ratio("hits", "predicted"), zero).alias("precision"),
        F.coalesce(ratio("hits", "support"), zero).alias("recall"),
        "support",
    ).withColumn("f1", F.coalesce(f1("precision", "recall"), zero))


def label_report(matched: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Samples, accuracy and macro-F1 in one row."""
    confusion = confusion_matrix(matched, statuses)
    macro = class_metrics(confusion).agg((F.sum("f1") / len(statuses)).alias("macro_f1")).scalar()
    return confusion.agg(
        F.sum("rows").alias("samples"),
        F.coalesce(
            ratio(F.sum(F.when(F.col("expected") == F.col("predicted"), F.col("rows")).otherwise(0)), F.sum("rows")),
            F.lit(0.0),
        ).alias("accuracy"),
    ).withColumn("macro_f1", macro)


def label_errors(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("expected") != F.col("predicted"))


def split_rows(rows: DataFrame, split: str, column: str = "calibration_split") -> DataFrame:
    """Rows of one evaluation split."""
    return rows.where(F.col(column) == split)
