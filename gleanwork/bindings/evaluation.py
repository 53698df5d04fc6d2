"""Model labels against human labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanwork.bindings.registry import query
from gleanwork.bindings.tables import Tables
from gleanwork.functions import labels
from gleanwork.operators import evaluate, gates

MODEL_SQL = """CASE WHEN contains(text, 'license') THEN 'pass' WHEN doc_id % 13 = 0 THEN 'review' WHEN doc_id % 17 = 0 THEN 'model_error'
    WHEN doc_id % 19 = 0 THEN 'retrieval_error' ELSE CASE WHEN n_chars > 900 THEN 'pass' ELSE 'not_found' END END"""
EVAL_SQL = f"""human AS (SELECT doc_id, source AS repository, 'u/' || doc_id AS github_url, CASE WHEN doc_id % 23 = 0 THEN ''
    WHEN quality = 1 THEN 'pass' ELSE 'not_found' END AS human_decision FROM documents JOIN labels USING (doc_id)),
  model AS (SELECT 'u/' || doc_id AS github_url, {MODEL_SQL} AS status FROM documents WHERE doc_id % 29 <> 0),
  joined AS (SELECT h.*, m.status, m.github_url IS NULL AS missing FROM human h LEFT JOIN model m USING (github_url)
    WHERE human_decision <> ''),
  evaluated AS (SELECT repository, github_url, human_decision, coalesce(status, '') AS llm_decision,
    CASE WHEN missing THEN 'missing_prediction' WHEN status = 'pass' AND human_decision = 'pass' THEN 'true_positive'
      WHEN status = 'pass' THEN 'false_positive' WHEN status = 'not_found' AND human_decision = 'pass' THEN 'false_negative'
      WHEN status = 'not_found' THEN 'true_negative' WHEN status IN ('review', 'model_error') THEN status END AS outcome FROM joined),
  files AS (SELECT * FROM evaluated WHERE outcome IS NOT NULL)"""


def model_status():
    return (
        F.when(F.col("text").contains("license"), "pass")
        .when(F.col("doc_id") % 13 == 0, "review")
        .when(F.col("doc_id") % 17 == 0, "model_error")
        .when(F.col("doc_id") % 19 == 0, "retrieval_error")
        .when(F.col("n_chars") > 900, "pass")
        .otherwise("not_found")
    )


def checklist(t: Tables):
    decision = F.when(F.col("doc_id") % 23 == 0, "").when(F.col("quality") == 1, " pass").otherwise("not_found ")
    return t.documents.join(t.labels, "doc_id").select(
        F.col("source").alias("repository"),
        F.concat(F.lit("u/"), "doc_id").alias("github_url"),
        decision.alias("human_decision"),
    )


def predictions(t: Tables):
    return t.documents.where("doc_id % 29 <> 0").select(
        F.concat(F.lit("u/"), "doc_id").alias("markdown_url"), model_status().alias("status")
    )


def evaluated(t: Tables):
    return evaluate.evaluated_files(checklist(t), predictions(t))


@query("j3_evaluated_files", f"WITH {EVAL_SQL} SELECT * FROM files")
def j3(t: Tables):
    return evaluated(t).select("repository", "github_url", "human_decision", "llm_decision", "outcome")


@query(
    "f19_binary_outcome",
    f"""SELECT doc_id, CASE WHEN m = 'pass' AND quality = 1 THEN 'true_positive' WHEN m = 'pass' THEN 'false_positive'
       WHEN m = 'not_found' AND quality = 1 THEN 'false_negative' WHEN m = 'not_found' THEN 'true_negative' END AS outcome
       FROM (SELECT *, {MODEL_SQL} AS m FROM documents JOIN labels USING (doc_id))""",
)
def f19(t: Tables):
    human = F.when(F.col("quality") == 1, "pass").otherwise("not_found")
    return t.documents.join(t.labels, "doc_id").select("doc_id", labels.binary_outcome(model_status(), human).alias("outcome"))


@query(
    "f23_null_safe_ratio",
    """SELECT source, count(*) FILTER (lang = 'en') / nullif(count(*) FILTER (lang <> 'es'), 0) AS share,
       coalesce(count(*) FILTER (lang = 'fr' AND n_chars > 100000) / nullif(count(*) FILTER (n_chars > 100000), 0), 0.0) AS zero_share
       FROM documents GROUP BY 1""",
)
def f23(t: Tables):
    counts = t.documents.groupBy("source").agg(
        F.count_if(F.col("lang") == "en").alias("en"),
        F.count_if(F.col("lang") != "es").alias("rest"),
        F.count_if((F.col("lang") == "fr") & (F.col("n_chars") > 100_000)).alias("fr_long"),
        F.count_if(F.col("n_chars") > 100_000).alias("long"),
    )
    return counts.select(
        "source",
        labels.ratio("en", "rest").alias("share"),
        F.coalesce(labels.ratio("fr_long", "long"), F.lit(0.0)).alias("zero_share"),
    )


@query("p20_false_positives", f"WITH {EVAL_SQL} SELECT repository, github_url FROM files WHERE outcome = 'false_positive'")
def p20(t: Tables):
    return evaluated(t).where("outcome = 'false_positive'").select("repository", "github_url")


COUNTS_SQL = """count(*) FILTER (outcome = 'true_positive') AS true_positives, count(*) FILTER (outcome = 'false_positive') AS false_positives,
    count(*) FILTER (outcome = 'false_negative') AS false_negatives, count(*) FILTER (outcome = 'true_negative') AS true_negatives,
    count(*) FILTER (outcome = 'review') AS review_decisions, count(*) FILTER (outcome = 'model_error') AS model_errors,
    count(*) FILTER (outcome = 'missing_prediction') AS missing_predictions"""


@query(
    "a10_binary_metrics",
    f"""WITH {EVAL_SQL}, c AS (SELECT {COUNTS_SQL}, (SELECT count(*) FROM human WHERE human_decision <> '') AS human_labeled_files FROM files),
       r AS (SELECT *, true_positives + false_positives + false_negatives + true_negatives AS resolved_predictions,
         true_positives / nullif(true_positives + false_positives, 0) AS precision, true_positives / nullif(true_positives + false_negatives, 0) AS recall FROM c)
       SELECT *, (true_positives + true_negatives) / resolved_predictions AS resolved_accuracy,
         (true_positives + true_negatives) / human_labeled_files AS strict_accuracy, resolved_predictions / human_labeled_files AS resolution_rate,
         true_negatives / (true_negatives + false_positives) AS specificity, 2 * precision * recall / (precision + recall) AS f1,
         false_positives / (false_positives + true_negatives) AS false_positive_rate,
         false_negatives / (false_negatives + true_positives) AS false_negative_rate FROM r""",
)
def a10(t: Tables):
    return evaluate.binary_metrics(evaluated(t), evaluate.labeled_count(checklist(t)))


@query(
    "a11_decision_matrix",
    f"""WITH {EVAL_SQL}, cells AS (SELECT h.human_decision, m.llm_decision FROM (VALUES ('pass'), ('not_found')) h(human_decision),
         (VALUES ('pass'), ('not_found'), ('review'), ('model_error'), ('missing_prediction')) m(llm_decision)),
       seen AS (SELECT human_decision, CASE llm_decision WHEN '' THEN 'missing_prediction' ELSE llm_decision END AS llm_decision, count(*) AS n
         FROM files GROUP BY 1, 2)
       SELECT human_decision, llm_decision, coalesce(n, 0) AS files FROM cells LEFT JOIN seen USING (human_decision, llm_decision)""",
)
def a11(t: Tables):
    return evaluate.decision_matrix(evaluated(t))


REPO_SQL = f"""{EVAL_SQL}, repo AS (SELECT repository, count(*) AS human_labeled_files, {COUNTS_SQL} FROM files GROUP BY 1),
  metric AS (SELECT *, true_positives + false_positives + false_negatives + true_negatives AS resolved_predictions,
    (true_positives + true_negatives) / nullif(true_positives + false_positives + false_negatives + true_negatives, 0) AS resolved_accuracy,
    (true_positives + true_negatives) / human_labeled_files AS strict_accuracy FROM repo)"""


@query("a12_repository_metrics", f"WITH {REPO_SQL} SELECT * FROM metric")
def a12(t: Tables):
    return evaluate.repository_metrics(evaluated(t))


@query("o5_worst_first", f"WITH {REPO_SQL} SELECT repository, false_positives, false_negatives FROM metric ORDER BY 2 DESC, 3 DESC, 1")
def o5(t: Tables):
    return evaluate.worst_first(evaluate.repository_metrics(evaluated(t))).select(
        "repository", "false_positives", "false_negatives"
    )


@query(
    "a13_repository_scope",
    f"""WITH {EVAL_SQL} SELECT count(DISTINCT repository) AS human_labeled_repositories,
       count(DISTINCT CASE WHEN human_decision = 'pass' THEN repository END) AS human_pass_repositories,
       count(DISTINCT CASE WHEN llm_decision = 'pass' THEN repository END) AS llm_pass_repositories FROM files""",
)
def a13(t: Tables):
    return evaluate.repository_scope(evaluated(t))


@query("a13_input_repositories", "SELECT count(DISTINCT source) AS input_repositories FROM documents")
def a13_input(t: Tables):
    return evaluate.input_repositories(t.documents.select(F.concat("source", F.lit(" ")).alias("name")))


GOLD_SQL = """gold AS (SELECT source AS repository, CAST(doc_id AS VARCHAR) AS revision, CASE WHEN quality = 0 THEN 'not_found' WHEN toxic = 1
    THEN 'review' ELSE 'pass' END AS expected, CASE WHEN doc_id % 2 = 0 THEN 'tuning' ELSE 'holdout' END AS split
    FROM documents JOIN labels USING (doc_id)),
  pred AS (SELECT source AS repository, CAST(doc_id AS VARCHAR) AS revision, CASE WHEN contains(text, 'license') THEN 'pass'
    WHEN n_chars > 900 THEN 'review' ELSE 'not_found' END AS predicted FROM documents),
  matched AS (SELECT repository, revision, expected, predicted, split FROM gold JOIN pred USING (repository, revision)),
  cells AS (SELECT e.s AS expected, p.s AS predicted FROM (VALUES ('pass'), ('review'), ('not_found')) e(s),
    (VALUES ('pass'), ('review'), ('not_found')) p(s)),
  confusion AS (SELECT expected, predicted, coalesce(n, 0) AS rows FROM cells LEFT JOIN
    (SELECT expected, predicted, count(*) AS n FROM matched GROUP BY 1, 2) USING (expected, predicted)),
  class AS (SELECT s.status, CAST(sum(rows) FILTER (expected = s.status AND predicted = s.status) AS BIGINT) AS hits,
    CAST(sum(rows) FILTER (predicted = s.status) AS BIGINT) AS predicted_n, CAST(sum(rows) FILTER (expected = s.status) AS BIGINT) AS support
    FROM confusion, (VALUES ('pass'), ('review'), ('not_found')) s(status) GROUP BY 1),
  metrics AS (SELECT status, coalesce(hits / nullif(predicted_n, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall, support FROM class),
  scored AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM metrics)"""


def gold(t: Tables):
    status = F.when(F.col("quality") == 0, "not_found").when(F.col("toxic") == 1, "review").otherwise("pass")
    return t.documents.join(t.labels, "doc_id").select(
        F.col("source").alias("repository"),
        F.col("doc_id").cast("string").alias("revision"),
        status.alias("status"),
        F.when(F.col("doc_id") % 2 == 0, "tuning").otherwise("holdout").alias("split"),
    )


def predicted(t: Tables):
    status = F.when(F.col("text").contains("license"), "pass").when(F.col("n_chars") > 900, "review").otherwise("not_found")
    return t.documents.select(
        F.col("source").alias("name"), F.col("doc_id").cast("string").alias("lastCommitSHA"), status.alias("guideline_status")
    )


def matched(t: Tables, split: str | None = None):
    return evaluate.matched_labels(gold(t), predicted(t), split)


@query("j4_matched_labels", f"WITH {GOLD_SQL} SELECT repository, revision, expected, predicted FROM matched WHERE split = 'holdout'")
def j4(t: Tables):
    return matched(t, "holdout").select("repository", "revision", "expected", "predicted")


@query("a8_confusion_matrix", f"WITH {GOLD_SQL} SELECT * FROM confusion")
def a8(t: Tables):
    return evaluate.confusion_matrix(matched(t))


@query("a9_class_metrics", f"WITH {GOLD_SQL} SELECT status, precision, recall, f1, support FROM scored")
def a9(t: Tables):
    return evaluate.class_metrics(evaluate.confusion_matrix(matched(t)))


@query(
    "a9_label_report",
    f"""WITH {GOLD_SQL} SELECT (SELECT CAST(sum(rows) AS BIGINT) FROM confusion) AS samples, (SELECT count(*) FILTER (expected = predicted) / count(*) FROM matched) AS accuracy,
       round(sum(f1) / 3, 12) AS macro_f1 FROM scored""",
)
def a9_report(t: Tables):
    return evaluate.label_report(matched(t)).withColumn("macro_f1", F.round("macro_f1", 12))


@query("p20_label_errors", f"WITH {GOLD_SQL} SELECT repository, revision, expected, predicted FROM matched WHERE expected <> predicted")
def p20_errors(t: Tables):
    return evaluate.label_errors(matched(t)).select("repository", "revision", "expected", "predicted")


@query("p15_split_rows", f"WITH {GOLD_SQL} SELECT repository, revision FROM gold WHERE split = 'tuning'")
def p15(t: Tables):
    return evaluate.split_rows(gold(t), "tuning", "split").select("repository", "revision")


@query(
    "j4_unmatched_gold",
    f"""WITH {GOLD_SQL} SELECT 'missing_prediction' AS rule, repository || '@' || revision AS key, '' AS detail FROM gold
         WHERE repository = 'src5'
       UNION ALL SELECT 'duplicate_prediction', repository || '@' || revision, '2' FROM pred WHERE repository = 'src7'
       UNION ALL SELECT 'predicted_status', repository || '@' || revision, 'model_error' FROM pred WHERE repository = 'src7'""",
)
def j4_gate(t: Tables):
    model = predicted(t).where("name <> 'src5'")
    again = model.where("name = 'src7'").withColumn("guideline_status", F.lit("model_error"))
    return gates.unmatched_gold(gold(t), model.unionByName(again))


@query(
    "v5_value_domain",
    "SELECT 'status' AS rule, CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS detail FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
)
def v5(t: Tables):
    return gates.value_domain(t.orders, "o_orderstatus", ("F", "O"), "o_orderkey", "status")


@query(
    "s14_gold_rows",
    f"WITH {GOLD_SQL} SELECT repository, revision, expected AS status, split FROM gold",
)
def s14(t: Tables):
    from gleanwork.bindings.attempts import log_folder
    from gleanwork.sources import readers

    folder = log_folder(t, "gold")
    gold(t).write.option("header", True).option("escape", '"').csv(folder)
    return readers.read_csv(t.spark, folder, ["repository", "revision", "status", "split"]).drop("file_name")
