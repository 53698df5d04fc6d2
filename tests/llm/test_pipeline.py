"""The pipeline stage by stage on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanwork.llm import queries
from gleanwork.session import materialize

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER))
        out[name] = docs
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_columns_and_only_remove_rows(stages):
    frames = list(stages.values())
    for before, after in zip(frames, frames[1:]):
        assert ids(after) <= ids(before)
    for df in frames[1:-1]:
        assert df.columns == frames[0].columns
    assert set(frames[0].columns) <= set(frames[-1].columns)


def test_decisions_take_effect(spark, stages):
    low = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 0")
    assert not ids(stages["quality_classifier"]) & ids(low)
    names = list(stages)
    dropped = ids(stages["quality_classifier"]) - ids(stages["near_duplicates"])
    assert dropped, names
    assert not stages["secret_scans"].where(F.col("text").rlike("AKIA[A-Z0-9]{16}|[0-9a-f]{24}")).count()
    assert stages["secret_scans"].where("n_chars != length(text)").isEmpty()
    assert stages["source_mixing"].where("copies < 1 or taken != copies * size").isEmpty()


def test_run_equals_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "copies")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["source_mixing"].select("doc_id", "copies").collect()))


@pytest.fixture(scope="module")
def awkward(spark):
    """Documents with null ids and texts, empty, repeated and very long ones, and columns named as inside the operators."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(40)
    names = given.columns
    extra = [
        (None, "A text without an id, which says little but is a text", "en", "web", 53),
        (90_001, None, "en", "web", None),
        (90_002, "", None, None, 0),
        (90_003, " \t\n ", "en", None, 4),
        (90_004, "word " * 40_000, "en", "web", 200_000),
        (None, None, None, None, None),
    ]
    assert names == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = given.unionByName(spark.createDataFrame(extra, given.schema))
    rows = rows.unionByName(rows.where("doc_id < 3 or doc_id > 90000"))
    for name in ("copies", "size", "score", "component_id", "n_words", "__id", "__key", "__kept"):
        rows = rows.withColumn(name, F.lit("clash"))
    return materialize(rows)


@pytest.mark.parametrize("at", range(5))
def test_stages_take_awkward_rows(spark, awkward, at):
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, awkward, FOLDER)
    if name != "source_mixing":
        assert out.columns == awkward.columns
    got = {(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()}
    assert {r[0] for r in got} <= {r["doc_id"] for r in awkward.select("doc_id").collect()}
    if name in ("near_duplicates", "benchmark_decontamination"):
        # Rows without words are copies of nothing and hold no passage; rows without an id stay.
        assert {(90_001, None), (90_002, ""), (90_003, " \t\n "), (None, None)} <= got
    if name == "near_duplicates":
        assert out.where("doc_id = 90001").count() == 1 and out.where("doc_id = 1").count() <= 1
    if name == "secret_scans":
        assert out.count() == awkward.count() and out.where("text is null").count() == awkward.where("text is null").count()
    assert stage(spark, awkward.limit(0), FOLDER).isEmpty()


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
