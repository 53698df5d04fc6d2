import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gleanwork import session
from gleanwork.functions import labels
from gleanwork.operators import attempts, scoring
from gleanwork.plans import classification, collection
from gleanwork.sources import readers, sinks
from gleanwork.streaming import attempts as streams


def test_population_files_in_name_order(spark, tmp_path):
    header = "name,lastCommitSHA,lastCommit,defaultBranch,license,mainLanguage\n"
    (tmp_path / "b.csv").write_text(header + "o/b1,s,t,main,MIT,Python\n" + 'o/b2,s,t,main,"MIT, or\nother",Python\n')
    (tmp_path / "a.csv").write_text("extra," + header + "x,o/a1,s,t,main,,Java\n")
    (tmp_path / "notes.txt").write_text("no")
    got = readers.load_population(spark, str(tmp_path)).orderBy("input_index")
    assert [(r["input_index"], r["name"], r["source_file"], r["license"]) for r in got.collect()] == [
        (0, "o/a1", "a.csv", ""),
        (1, "o/b1", "b.csv", "MIT"),
        (2, "o/b2", "b.csv", "MIT, or\nother"),
    ]
    assert got.first()["extra"] == "x"
    assert readers.extra_fields(got).first()["fields"]["mainLanguage"] == "Java"
    (tmp_path / "c.csv").write_text("name,license\no/c,MIT\n")
    with pytest.raises(ValueError, match="missing required columns"):
        readers.load_population(spark, str(tmp_path))


def test_population_plan_grows_with_headers_not_files(spark, tmp_path):
    header = "name,lastCommitSHA,lastCommit,defaultBranch,license"
    for k in range(12):
        quoted = header.replace("license", '"license"') + ',"note\n""x"""' if k % 4 == 0 else header
        row = f"o/{k},s,t,main,MIT" + (",n" if k % 4 == 0 else "")
        (tmp_path / f"f{k:02d}.csv").write_text(f"{quoted}\n{row}\n{row}b\n")
    got = readers.load_population(spark, str(tmp_path))
    assert [(r["name"], r["source_file"]) for r in got.orderBy("input_index").collect()] == [
        (f"o/{k}", f"f{k:02d}.csv") for k in range(12) for _ in range(2)
    ]
    assert 'note\n"x"' in got.columns
    assert [len(h) for h in readers.csv_headers(spark, str(tmp_path / "f00.csv"))] == [6]
    assert [len(files) for files in readers.csv_headers(spark, str(tmp_path)).values()] == [3, 9]
    (tmp_path / "f12.csv").write_text("")
    with pytest.raises(ValueError, match="missing required columns"):
        readers.load_population(spark, str(tmp_path))


def test_a_csv_may_be_a_folder_of_parts(spark, tmp_path):
    folder = str(tmp_path / "gold parts+1")
    gold = spark.createDataFrame([(f"o/{i}", "f", "GU" if i % 2 else "", 'a "b",\nc') for i in range(40)], "repository string, revision string, status string, split string")
    gold.repartition(7).write.option("header", True).option("escape", '"').csv(folder)
    assert rows(readers.read_csv(spark, folder, gold.columns).drop("file_name")) == rows(gold)
    assert readers.read_csv(spark, folder).columns == [*gold.columns, "file_name"]
    (tmp_path / "gold parts+1" / "part-zz.csv").write_text("status,revision,repository,split,more\n\"GU\",f,o/x,t,1\n")
    both = readers.read_csv(spark, folder, gold.columns).where("repository = 'o/x'")
    assert rows(both) == [("o/x", "f", "GU", "t", "part-zz.csv")]
    with pytest.raises(ValueError, match="missing required columns: more"):
        readers.read_csv(spark, folder, ["repository", "more"])
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no CSV files"):
        readers.read_csv(spark, str(tmp_path / "none"))
    assert readers.read_csv(spark, str(tmp_path / "none"), ["a"]).isEmpty()


def test_earlier_screenings_are_carried_behind_the_gates(spark):
    columns = "sample_order bigint, round_number bigint, language string, repository string, revision string"
    schedule = spark.createDataFrame([(1, 1, "a", "o/A", "F0"), (2, 1, "b", "o/b", "f1"), (3, 2, "a", "o/c", "f2")], columns)
    before = schedule.limit(2).withColumn("status", F.lit("pass")).withColumn("repository", F.lower("repository"))

    def settings(**values):
        return spark.createDataFrame([(k, str(v)) for k, v in values.items()], "name string, value string")

    old, new = settings(input_fingerprints='{"x": "1", "y": "2"}', note=1), settings(input_fingerprints='{"z": "2", "v": "1"}', note=2)
    kept = collection.carried_screenings(before, schedule, old, schedule, new, spark.createDataFrame([("O/B",)], "repository string"))
    assert rows(kept, "repository") == [("o/b",)]
    moved = before.withColumn("round_number", F.lit(2).cast("bigint"))
    for args, rule in (
        ((moved, schedule, old, schedule, new), "schedule_mismatch"),
        ((before, schedule.limit(2), old, schedule, new), "schedule_mismatch: o/c"),
        ((before, schedule, old, schedule.limit(2), new), "schedule_mismatch: o/c"),
        ((before, schedule, old, schedule, settings(input_fingerprints='{"z": "3"}')), "setting_changed"),
    ):
        with pytest.raises(ValueError, match=rule):
            collection.carried_screenings(*args)


def test_exclusion_lists(spark):
    a = spark.createDataFrame([(" o/a ",), ("",)], "name string")
    b = spark.createDataFrame([("o/b", "x"), ("o/a", "y")], "repository string, note string")
    assert rows(readers.exclusion_names(a, b)) == [("o/a",), ("o/b",)]
    with pytest.raises(ValueError, match="name or repository"):
        readers.exclusion_names(a.withColumnRenamed("name", "other"))


def test_exact_columns(spark):
    df = spark.createDataFrame([("r", "l")], "repository string, license_name string")
    readers.require_columns(df, ["repository", "license_name"], exact=True)
    with pytest.raises(ValueError, match="columns must be"):
        readers.require_columns(df, ["license_name", "repository"], exact=True)


def test_torn_tail_is_ignored_and_inner_damage_reported(spark, tmp_path):
    good = [json.dumps({"custom_id": "x", "status": "pass", "seq": i}) for i in range(3)]
    (tmp_path / "a.json").write_text("\n".join([*good, '{"custom_id": "x", "sta']))
    (tmp_path / "b.json").write_text("\n".join([good[0], '{"broken', good[1]]))
    lines = session.materialize(readers.read_attempts(spark, str(tmp_path)))
    sound, broken = readers.split_torn(lines)
    assert sound.count() == 5
    assert [r["source_file"].rpartition("/")[2] for r in broken.collect()] == ["b.json"]


def test_markdown_tree(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.MD").write_bytes(b"caf\xff\xc3\xa9")
    (tmp_path / "b.md").write_text("x")
    (tmp_path / "c.txt").write_text("x")
    (tmp_path / ".md").write_text("x")
    got = readers.scan_file_tree(spark, str(tmp_path))
    expected = b"caf\xff\xc3\xa9".decode(errors="replace")
    assert rows(got, "path", "size", "content") == [("b.md", 1, "x"), ("docs/a.MD", 6, expected)]


def test_report_and_bundle(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("A", 1)], "name string, n int")
    sinks.write_report(df, str(tmp_path / "r"), ["n", "name"], [F.lower("name")], "csv")
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "r")).orderBy("n").collect()] == [("1", "A"), ("2", "b")]
    record = sinks.publish({"t": df}, {"in": df}, str(tmp_path / "bundle"))
    by_role = {r["role"]: r["rows"] for r in record.collect()}
    assert by_role == {"t": 2, "in": 2}
    assert spark.read.json(str(tmp_path / "bundle" / "provenance")).count() == 2


def test_materialize_reads_the_session_folder(spark):
    df = session.materialize(spark.range(5).withColumn("x", F.lit("a")))
    assert df.columns == ["id", "x"] and df.count() == 5
    assert session.shared_dir(spark).rstrip("/") in df.inputFiles()[0]


# ---------------------------------------------------------------- streams

LOG = [
    ("a", 1, "model_error"), ("b", 2, "retrieval_error"), ("a", 3, "model_error"), ("b", 4, "retrieval_error"),
    ("a", 5, "model_error"), ("c", 6, "pass"), ("b", 7, "pass"), ("a", 8, "review"),
]
SCHEMA = "custom_id string, seq bigint, status string"


def stream_of(spark, folder, batches):
    for index, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))


def expected_budgets(spark):
    return rows(attempts.replay(spark.createDataFrame(LOG, SCHEMA)), "custom_id", "seq", "attempt_count", "model_attempt_count",
                "retrieval_attempt_count", "retry_exhausted")


BUDGET_COLUMNS = ("custom_id", "seq", "attempt_count", "model_attempt_count", "retrieval_attempt_count", "retry_exhausted")


def test_streamed_latest_equals_batch(spark, tmp_path):
    stream = stream_of(spark, tmp_path, [LOG[:3], LOG[3:5], LOG[:4], LOG[5:]])
    streams.drain(stream, streams.upsert_latest(str(tmp_path / "state"), compact_every=2), str(tmp_path / "offsets"))
    got = streams.read_latest(spark, str(tmp_path / "state"), stream.schema)
    assert rows(got) == rows(attempts.latest_attempts(spark.createDataFrame(LOG, SCHEMA)).select("custom_id", "seq", "status"))
    # A repeated batch replaces its own delta.
    writer = streams.upsert_latest(str(tmp_path / "state"), compact_every=2)
    writer(spark.createDataFrame(LOG[5:], SCHEMA), 3)
    assert rows(streams.read_latest(spark, str(tmp_path / "state"), stream.schema)) == rows(got)


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_path):
    log = streams._budget_log(str(tmp_path / "state"), buckets=16, compact_every=2)
    many = spark.range(400).select(F.col("id").cast("string").alias("custom_id"), F.lit(1).cast("bigint").alias("seq"), F.lit("pass").alias("status"))
    log.commit(0, many)
    log.commit(1, many.where("custom_id < '2'").withColumn("seq", F.lit(2).cast("bigint")))
    log.commit(2, many.where("custom_id = '7'").withColumn("seq", F.lit(3).cast("bigint")))
    one = many.where("custom_id = '7'")
    (bucket,) = log.touched(one)
    files = log.read(spark, [bucket]).inputFiles()
    assert {f.split("/state/")[1].split("/part")[0] for f in files} == {f"base-{1:012d}/bucket={bucket}", f"delta-{2:012d}"}
    assert rows(log.read(spark, [bucket]).where("custom_id = '7'"), "seq") == [(1,), (3,)]
    # Another bucket has no rows in the last delta, which is not opened for it.
    other = next(k for k in range(16) if k != bucket)
    assert all("delta" not in f for f in log.read(spark, [other]).inputFiles())
    assert log.read(spark).count() == 400 + many.where("custom_id < '2'").count() + 1


def test_replaced_versions_are_removed_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    folder = tmp_path / "state"
    log = streams._latest_log(str(folder), spark.createDataFrame([], SCHEMA).schema, buckets=8, compact_every=3)
    for batch in range(8):
        data = [(f"k{j}", batch, "pass") for j in range(20) if batch == 0 or j % 8 == batch % 3]
        for _ in range(2):
            log.commit(batch, spark.createDataFrame(data, SCHEMA))
    assert log.versions(spark) == [5, 6, 7]
    kept = [log.manifest(spark, v + 1) for v in (5, 6, 7)]
    assert {int(p.name.split("-")[1]) for p in folder.glob("delta-*")} == {v for m in kept for v in m.deltas}
    on_disk = {(int(p.parent.name.split("-")[1]), int(p.name.split("=")[1])) for p in folder.glob("base-*/bucket=*")}
    assert on_disk == {(v, k) for m in kept for k, v in m.base.items()}
    newest = {f"k{j}": max(b for b in range(8) if b == 0 or j % 8 == b % 3) for j in range(20)}
    got = streams.read_latest(spark, str(folder), log.schema)
    assert {r["custom_id"]: r["seq"] for r in got.collect()} == newest
    # A batch that comes again after a crash starts from the state before it.
    assert log.read(spark, below=7).where("seq = 7").isEmpty() and not log.read(spark).where("seq = 7").isEmpty()


def test_an_appended_batch_is_written_once(spark, tmp_path):
    path = str(tmp_path / "log")
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (LOG[:3], LOG[3:]))
    assert sinks.append_attempts(first, path, "0") and sinks.append_attempts(second, path, "1")
    assert not sinks.append_attempts(second, path, "1")
    assert rows(readers.read_attempts(spark, path, SCHEMA), "custom_id", "seq", "status") == sorted(LOG, key=repr)
    # What a broken run left behind is replaced.
    (tmp_path / "log" / "batch=2").mkdir()
    (tmp_path / "log" / "batch=2" / "part-0.json").write_text('{"custom_id":"half"}\n')
    assert sinks.append_attempts(first, path, "2")
    assert rows(readers.read_attempts(spark, path, SCHEMA), "custom_id", "seq", "status") == sorted(LOG + LOG[:3], key=repr)
    with pytest.raises(ValueError, match="batch name"):
        sinks.append_attempts(first, path, "a/b")


def test_steps_of_a_stream_leave_no_copies(spark):
    with session.temporary(spark):
        copy = session.materialize(spark.range(3))
        path = copy.inputFiles()[0].removeprefix("file://")
        assert Path(path).exists() and copy.count() == 3
    assert not Path(path).exists()


@pytest.mark.parametrize("limit", [None, 1])
def test_streamed_budget_batches_equal_replay(spark, tmp_path, limit):
    stream = stream_of(spark, tmp_path, [LOG[:4], LOG[:4], LOG[4:]])
    writer = streams.budget_batches(str(tmp_path / "state"), str(tmp_path / "out"), max_group_rows=limit)
    streams.drain(stream, writer, str(tmp_path / "offsets"))
    assert rows(streams.read_budgets(spark, str(tmp_path / "out")), *BUDGET_COLUMNS) == expected_budgets(spark)


@pytest.mark.parametrize("every", [1, 20])
def test_late_attempts_are_counted(spark, tmp_path, every):
    # The last attempts come first, some twice: nothing is lost and later rows are corrected.
    stream = stream_of(spark, tmp_path, [LOG[4:], LOG[2:5], LOG[:1], LOG[:3]])
    writer = streams.budget_batches(str(tmp_path / "state"), str(tmp_path / "out"), compact_every=every)
    streams.drain(stream, writer, str(tmp_path / "offsets"))
    assert rows(streams.read_budgets(spark, str(tmp_path / "out")), *BUDGET_COLUMNS) == expected_budgets(spark)


def test_stateful_budgets_equal_replay(spark, tmp_path):
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    stream = stream_of(spark, tmp_path, [LOG[3:], LOG[2:4], LOG[:3]])
    streams.drain(streams.retry_budgets(stream), streams.append_batches(str(tmp_path / "out")), str(tmp_path / "offsets"))
    got = streams.read_budgets(spark, str(tmp_path / "out"))
    assert rows(got, *BUDGET_COLUMNS) == expected_budgets(spark)


# ---------------------------------------------------------------- plans


def scorer_for(fail):
    def answer(request):
        document = json.loads(request["body"]["input"])
        if document["path"] in fail:
            raise RuntimeError("boom")
        found = "style" in document["content"]
        label = {"label": "YES" if found else "NO", "reason": "r", "quote": "style" if found else "", "confidence": 9}
        text = {"type": "output_text", "text": json.dumps(label)}
        return {"output": [{"content": [text]}], "usage": {"input_tokens": 100, "output_tokens": 10, "total_tokens": 110}}

    return answer


def corpus(spark):
    entries = spark.createDataFrame(
        [
            ("o/a", "r1", "README.md", "s1", 20, "100644"),
            ("o/a", "r1", "docs/guide.md", "s2", 20, "100644"),
            ("o/b", "r2", "rules.md", "s1", 20, "100644"),
            ("o/c", "r3", "STYLE.md", "s3", 20, "100644"),
        ],
        readers.ENTRY,
    )
    contents = spark.createDataFrame(
        [("s1", "our style rules"), ("s2", "the design"), ("s3", "style")], "sha string, content string"
    )
    repositories = spark.createDataFrame(
        [("o/a", "r1", "completed", ""), ("o/b", "r2", "completed", ""), ("o/c", "r3", "retrieval_error", "gone")],
        "name string, lastCommitSHA string, status string, error string",
    )
    nothing = spark.createDataFrame([], "name string, lastCommitSHA string, markdown_path string")
    return entries, contents, repositories, nothing


def test_extract_classify_report(spark):
    entries, contents, repositories, nothing = corpus(spark)
    out = classification.extract_candidates(entries, contents, repositories, nothing)
    assert rows(out.unique, "name", "markdown_path") == [("o/a", "README.md"), ("o/a", "docs/guide.md")]
    assert out.dedup_summary.first()["redundant_files"] == 1
    gate = attempts.repository_gate(repositories)
    log = spark.createDataFrame([], "custom_id string, status string, seq bigint")
    rates = labels.PRICES["openrouter"]
    first = classification.classify_candidates(out.unique, contents, gate, log, scorer_for({"docs/guide.md"}), rates, "m")
    first = session.materialize(first)
    assert rows(first, "markdown_path", "status", "reason") == [
        ("README.md", "pass", "verified_quote"),
        ("docs/guide.md", "model_error", "request_error"),
    ]
    assert sorted(r["seq"] for r in first.collect()) == [1, 2]
    # On resume only the failed file is asked again.
    again = session.materialize(classification.classify_candidates(out.unique, contents, gate, first, scorer_for(set()), rates, "m"))
    assert rows(again, "markdown_path", "status", "seq") == [("docs/guide.md", "not_found", 3)]
    reports = classification.report_files(first.unionByName(again), out.audit)
    assert rows(reports.statuses) == [("not_found", 1), ("pass", 1)]
    assert reports.cost.first()["completed"] == 2
    status = {r["name"]: r["status"] for r in reports.repositories.collect()}
    assert status == {"o/a": "pass", "o/b": "unresolved", "o/c": "retrieval_error"}


def test_scorer_failures_become_rows(spark):
    requests = spark.createDataFrame([("1", json.dumps({"x": 1})), ("2", json.dumps({"x": 0}))], "custom_id string, request string")
    got = scoring.parsed_answers(scoring.score(requests, lambda r: {"output": [], "usage": {"input_tokens": 1 // r["x"]}}))
    assert [(r["custom_id"], r["error"]) for r in got.orderBy("custom_id").collect()] == [
        ("1", None),
        ("2", "ZeroDivisionError: integer division or modulo by zero"),
    ]


def people(spark):
    data = [(f"{lang}/r{i}", f"{i:040x}", lang, "MIT" if i % 3 else "Other", "f.csv", i) for lang in ("a", "b") for i in range(12)]
    return spark.createDataFrame(
        data, "name string, lastCommitSHA string, mainLanguage string, license string, source_file string, input_index bigint"
    )


def test_collection_replenishes_after_rejection(spark):
    population = people(spark)
    allow = spark.createDataFrame([("MIT",)], "license_name string")
    schedule = collection.eligible_schedule(population, ("a", "b"), 11, allowlist=allow)
    assert schedule.count() == 16
    targets = spark.createDataFrame([("a", 3), ("b", 2)], "language string, target bigint")
    baseline = spark.createDataFrame([("A/R0",)], "repository string")
    no_review = spark.createDataFrame([], "repository string, state string")
    by_language = {lang: [r for r in schedule.orderBy("sample_order").collect() if r["language"] == lang] for lang in ("a", "b")}
    screened = [(*r, "pass") for r in (by_language["a"][:2] + by_language["b"][:2])]
    screenings = spark.createDataFrame(screened, schedule.schema.add("status", "string"))
    state = collection.collection_state(population, schedule, screenings, baseline, no_review, targets, True)
    assert rows(state.ledger, "language", "baseline", "confirmed", "pending", "remaining") == [("a", 1, 0, 2, 0), ("b", 0, 0, 2, 0)]
    assert state.report.first()["workflow_stage"] == "needs_file_review"
    assert state.next_wave.count() == 0
    # Rejecting one positive opens its stratum again.
    reviewed = spark.createDataFrame(
        [(by_language["a"][0]["repository"], "rejected"), (by_language["b"][0]["repository"], "confirmed")],
        "repository string, state string",
    )
    state = collection.collection_state(population, schedule, screenings, baseline, reviewed, targets, True)
    assert rows(state.ledger, "language", "confirmed", "pending", "remaining") == [("a", 0, 1, 1), ("b", 1, 1, 0)]
    assert [r["repository"] for r in state.next_wave.collect()] == [by_language["a"][2]["repository"]]
    assert state.report.first()["workflow_stage"] == "needs_replenishment"
    contradicted = reviewed.unionByName(spark.createDataFrame([("b/r1", "confirmed")], reviewed.schema))
    with pytest.raises(ValueError, match="unproven_review"):
        collection.collection_state(population, schedule, screenings.limit(0), baseline, contradicted, targets, True)
    tight = collection.collection_state(population, schedule, screenings, baseline, reviewed, targets, True, budget=4)
    assert tight.next_wave.count() == 0
    origins = {r["repository"].lower(): r["origin"] for r in state.selected.collect()}
    assert origins["a/r0"] == "baseline" and sorted(origins.values()) == ["baseline", "new_confirmed", "new_pending", "new_pending"]


def test_evaluate_plan_rejects_bad_input(spark):
    checklist = spark.createDataFrame([("r", "u", "maybe")], "repository string, github_url string, human_decision string")
    model = spark.createDataFrame([("u", "pass")], "markdown_url string, status string")
    with pytest.raises(ValueError, match="human_decision"):
        collection.evaluate_labels(checklist, model)
    good = checklist.withColumn("human_decision", F.lit("pass"))
    with pytest.raises(ValueError, match="duplicate_url"):
        collection.evaluate_labels(good, model.union(model))
    assert collection.evaluate_labels(good, model).metrics.first()["precision"] == 1.0


def test_release_removes_only_this_applications_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    other = tmp_path / "gleanwork" / "other-application"
    other.mkdir(parents=True)
    session.materialize(spark.range(3))
    assert len(list((tmp_path / "gleanwork").iterdir())) == 2
    assert session.release(spark)
    assert list((tmp_path / "gleanwork").iterdir()) == [other]
    assert not session.release(spark)


def test_reports_keep_their_column_order(spark):
    wide = spark.createDataFrame([("{}", "pass", "a")], "provider_result string, status string, custom_id string")
    got = readers.report_columns(wide, wide.columns)
    assert got.columns == [c for c in readers.REPORT_COLUMNS if c in ("status", "custom_id")]
