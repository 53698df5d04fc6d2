import hashlib
import itertools
import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gleanwork.functions import labels, terms
from gleanwork.operators import attempts, costs, dedup, evaluate, evidence, files, quota, review, sampling, skew
from gleanwork.session import materialize
from gleanwork.sources import content_store, readers

CANDIDATE = "name string, lastCommitSHA string, markdown_path string, content_sha256 string, blob_sha string, status string"


def candidates(spark, data):
    return spark.createDataFrame(data, CANDIDATE)


# ---------------------------------------------------------------- dedup

COPIES = [
    ("b/two", "2", "README.md", "h1", "", "pass"),
    ("A/one", "1", "Docs/x.md", "h1", "", "review"),
    ("a/one", "1", "docs/a.md", "h1", "", ""),
    ("c/three", "3", "AGENTS.md", "", "blob", "pass"),
    ("d/four", "4", "AGENTS.md", "", "blob", "pass"),
    ("e/five", "5", "x.md", "h2", "blob", "pass"),
]


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_exact_dedup(spark, partitions):
    df = candidates(spark, random.Random(partitions).sample(COPIES, len(COPIES))).repartition(partitions)
    assert rows(dedup.canonical_rows(df), "exact_group_id", "markdown_path") == [
        ("git_blob:blob", "AGENTS.md"),
        ("sha256:h1", "docs/a.md"),
        ("sha256:h2", "x.md"),
    ]
    summary = dedup.dedup_summary(df).first().asDict()
    assert summary == {
        "input_files": 6, "unique_contents": 3, "duplicate_groups": 2, "redundant_files": 3, "decision_conflict_groups": 1,
    }
    marks = rows(dedup.occurrences(df).where("is_canonical"), "name", "group_size")
    assert marks == [("a/one", 3), ("c/three", 2), ("e/five", 1)]
    assert rows(dedup.occurrences(df, conflicts_only=True), "name") == [("A/one",), ("a/one",), ("b/two",)]


def test_dedup_needs_a_hash_column(spark):
    with pytest.raises(ValueError, match="content_sha256 or blob_sha"):
        dedup.with_group(candidates(spark, COPIES).drop("content_sha256", "blob_sha"))


# ---------------------------------------------------------------- files

ENTRIES = "repository string, revision string, path string, sha string, size bigint, mode string"


def tree(spark):
    entries = spark.createDataFrame(
        [
            ("o/a", "r1", "README.md", "s1", 10, "100644"),
            ("o/a", "r1", "docs/guide.md", "s2", 10, "100644"),
            ("o/a", "r1", "guide/notes.md", "s3", 10, "100644"),
            ("o/a", "r1", "STYLE.md", "s1", 10, "120000"),
            ("o/a", "r1", "style.txt", "s1", 10, "100644"),
            ("o/b", "r2", "rules.md", "s1", 10, "100644"),
        ],
        ENTRIES,
    )
    contents = spark.createDataFrame(
        [("s1", "Coding rules apply."), ("s2", "Nothing here"), ("s3", "a style")], "sha string, content string"
    )
    return entries, contents


def test_two_stage_filter(spark):
    entries, contents = tree(spark)
    screened = files.screen_files(entries, contents)
    assert rows(screened, "name", "markdown_path", terms.join_terms("matched_content_terms")) == [
        ("o/a", "README.md", "rule"),
        ("o/a", "docs/guide.md", ""),
        ("o/b", "rules.md", "rule"),
    ]
    evidence_rows = spark.createDataFrame(
        [("o/a", "r1", "README.md"), ("o/a", "r1", "docs/guide.md"), ("o/a", "r1", "x.txt"), ("o/c", "r3", "y.md")],
        "name string, lastCommitSHA string, guideline_path string",
    )
    known = files.merged_evidence(evidence_rows, evidence_rows)
    flagged = files.candidate_files(screened, known)
    assert rows(flagged, "name", "agent_evidence") == [("o/a", True), ("o/b", False)]
    repositories = spark.createDataFrame(
        [("o/a", "r1", "completed", ""), ("o/b", "r2", "completed", ""), ("o/c", "r3", "scan_error", "boom")],
        "name string, lastCommitSHA string, status string, error string",
    )
    coverage = files.evidence_coverage(known, screened, repositories)
    assert rows(coverage, "markdown_path", "is_markdown", "filename_match", "content_match") == [
        ("README.md", True, True, True),
        ("docs/guide.md", True, True, False),
        ("x.txt", False, False, None),
        ("y.md", True, None, None),
    ]
    audit = files.repository_audit(repositories, screened, coverage).orderBy("name").collect()
    assert [tuple(r)[4:] for r in audit] == [(2, 1, 3, 2, 2, 1, 0), (1, 1, 0, 0, 0, 0, 0), (0, 0, 1, 1, 0, 0, 1)]


def test_keyword_files_ignore_names(spark):
    entries, contents = tree(spark)
    assert rows(files.keyword_files(entries, contents), "markdown_path") == [("README.md",), ("guide/notes.md",), ("rules.md",)]


def test_candidate_contents_become_rows(spark):
    wanted = spark.createDataFrame(
        [("a", "s1", 5), ("b", "s2", 999), ("c", "s3", 5), ("d", "s4", 5)], "name string, blob_sha string, size_bytes bigint"
    )
    contents = spark.createDataFrame([("s1", "ok"), ("s2", "never read"), ("s4", "ééééé")], "sha string, content string")
    got = files.candidate_contents(wanted, contents, 8)
    assert rows(got, "name", "content", "error_status", "error") == [
        ("a", "ok", None, None),
        ("b", None, "input_too_large", "input_too_large: size_bytes=999 max_input_bytes=8"),
        ("c", None, "retrieval_error", "cached blob is absent: s3"),
        ("d", None, "input_too_large", "input_too_large: size_bytes=10 max_input_bytes=8"),
    ]


# ---------------------------------------------------------------- evidence


def stored(spark, tmp_path, bodies):
    """A content store of some bodies, and the sha of each."""
    shas = {body: hashlib.sha256(body.encode()).hexdigest()[:40] for body in bodies}
    rows_ = [(sha, body) for body, sha in shas.items()] * 2 + [(None, "x"), ("gone", None)]
    return content_store.write_contents(spark.createDataFrame(rows_, "sha string, content string"), str(tmp_path / "store"), 3), shas


def exchanged(df):
    """Columns that any exchange of the plan carries."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return {c.partition("#")[0] for columns in re.findall(r"\(\d+\) \w*Exchange[^\n]*\nInput \[\d+\]: \[(.*?)\]", text) for c in columns.split(", ")}


def test_evidence_verification(spark, tmp_path):
    store, shas = stored(spark, tmp_path, ["one two three", "four\nfive"])
    files_ = spark.createDataFrame(
        [("r", "1", "A.md", shas["one two three"]), ("r", "1", "docs/B.md", shas["four\nfive"]), ("r", "1", "D.md", "gone"), ("r", "1", "E.md", None)],
        "repository string, revision string, path string, sha string",
    )
    claims = [
        ("A.md", "absent"),
        ("./A.md", "two"),
        ("A.md", "three"),
        ("docs/../A.md", "one"),
        ("docs/B.md", "four\nfive"),
        ("../B.md", "four"),
        ("C.md", "x"),
        ("", "x"),
        ("A.md", ""),
        ("D.md", "x"),
        ("E.md", "x"),
    ]
    results = spark.createDataFrame(
        [("r", "1", json.dumps([{"path": p, "quote": q} for p, q in claims]))],
        "repository string, revision string, evidence_json string",
    )
    verified = evidence.verify_evidence(evidence.evidence_items(results), files_, store)
    reasons = [r["reason"] for r in verified.orderBy("item_index").collect()]
    duplicate = "path duplicates another verified evidence item"
    assert reasons == [
        "quote is not an exact substring of the file", None, duplicate, duplicate, None,
        "path resolves outside repository", "path is not a file", "path is empty", "quote is empty", "path is not a file", "path is not a file",
    ]
    for status, expected in (("pass", "review"), ("not_found", "review")):
        answer = spark.createDataFrame([("r", "1", status)], "repository string, revision string, status string")
        assert evidence.evidence_verdict(answer, verified).first()["status"] == expected
    clean = verified.where("reason is null")
    answer = spark.createDataFrame([("r", "1", "pass")], "repository string, revision string, status string")
    assert evidence.evidence_verdict(answer, clean).first()["status"] == "pass"


def test_bodies_stay_in_their_buckets(spark, tmp_path):
    store, shas = stored(spark, tmp_path, [f"body {i} " * 9 for i in range(50)])
    asked = spark.createDataFrame([(sha, f"body {i} body", str(i)) for i, sha in enumerate(shas.values())], "sha string, quote string, quote_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = evidence.quotes_found(asked, store)
        assert "quote" in exchanged(found) and "content" not in exchanged(found)
        assert {r["quote_found"] for r in found.collect()} == {True} and found.count() == 50
        docs = spark.createDataFrame([("r", str(i % 3), i, sha) for i, sha in enumerate(shas.values())], "repository string, revision string, rank int, sha string")
        cut = evidence.budgeted_payload(docs, store, 30, 400)
        assert "limit" in exchanged(cut) and "content" not in exchanged(cut)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_store_takes_new_bodies_and_is_found_again(spark, tmp_path):
    store, shas = stored(spark, tmp_path, ["one", "two"])
    assert rows(store, "content", "n_chars") == [("one", 3), ("two", 3)]
    more = spark.createDataFrame([(shas["two"], "two"), ("new", "three"), ("new", "three"), (None, "x")], "sha string, content string")
    content_store.add_contents(more, str(tmp_path / "store"))
    spark.sql(f"DROP TABLE {content_store._name(str(tmp_path / 'store'))}")
    again = content_store.open_contents(spark, str(tmp_path / "store"))
    assert rows(again, "content") == [("one",), ("three",), ("two",)]
    assert content_store.bucket_count(spark, str(tmp_path / "store")) == 3
    with pytest.raises(ValueError, match="no content store"):
        content_store.open_contents(spark, str(tmp_path / "nothing"))


def python_payload(bodies, per_document, per_repository):
    from test_functions import python_excerpt

    remaining, kept = per_repository, []
    for body in bodies:
        text = python_excerpt(body, min(per_document, remaining))
        if not text:
            break
        kept.append(text)
        remaining -= len(text)
    return kept


@pytest.mark.parametrize("heavy", [None, 3])
def test_payload_budget_matches_the_loop(spark, tmp_path, heavy):
    rng = random.Random(3)
    repositories = {
        f"r{i}": ["".join(rng.choices("ab\n", k=rng.choice([0, 3, 40, 90, 200, 400]))) for _ in range(rng.randint(1, 9))]
        for i in range(40)
    }
    # One body is shared by many documents.
    for bodies in list(repositories.values())[::2]:
        bodies.insert(1, "shared body " * 20)
    store, shas = stored(spark, tmp_path, {body for bodies in repositories.values() for body in bodies})
    data = [(r, "1", k, f"p{k}", shas[body]) for r, bodies in repositories.items() for k, body in enumerate(bodies)]
    df = spark.createDataFrame(data, "repository string, revision string, rank int, path string, sha string")
    got = evidence.budgeted_payload(df, store, 150, 420, min_rows=heavy).collect()
    for name, bodies in repositories.items():
        mine = [r["content"] for r in sorted((r for r in got if r["repository"] == name), key=lambda r: r["rank"])]
        assert mine == python_payload(bodies, 150, 420), name


def test_top_documents(spark):
    paths_ = ["README.md", "CONTRIBUTING.md", "docs/style.md", "x.md", "vendor/CONTRIBUTING.md"]
    df = spark.createDataFrame([("r", "1", p, 10) for p in paths_], "repository string, revision string, path string, size bigint")
    assert rows(evidence.top_documents(df, 2), "rank", "path") == [(1, "CONTRIBUTING.md"), (2, "docs/style.md")]


# ---------------------------------------------------------------- attempts


def history(spark, statuses):
    data = [("x", i, s) for i, s in enumerate(statuses)]
    return spark.createDataFrame(data, "custom_id string, seq bigint, status string")


def test_replay_counts_and_budgets(spark):
    log = history(spark, ["model_error", "retrieval_error", "model_error", "retrieval_error", "model_error", "pass"])
    got = attempts.replay(log).orderBy("seq").collect()
    assert [r["model_attempt_count"] for r in got] == [1, 1, 2, 2, 3, 4]
    assert [r["retrieval_attempt_count"] for r in got] == [0, 1, 1, 2, 2, 2]
    assert [r["retry_exhausted"] for r in got] == [False, False, False, True, True, False]
    assert attempts.attempt_state(log).first()["attempt_count"] == 6


@pytest.mark.parametrize(
    ("statuses", "done"),
    [
        (["model_error"], False),
        (["model_error"] * 3, True),
        (["retrieval_error"] * 2, True),
        (["retrieval_error", "model_error"], False),
        (["snapshot_incomplete"] * 9, False),
        (["model_error", "review"], True),
        (["input_too_large"], True),
    ],
)
def test_completed(spark, statuses, done):
    assert bool(attempts.completed(attempts.attempt_state(history(spark, statuses))).count()) is done


def test_gate_priority(spark):
    sources = spark.createDataFrame(
        [("O/A", "1", "completed", ""), ("o/b", "1", "scan_error", "boom"), ("o/c", "1", "completed", ""), ("o/d", "1", "completed", "")],
        "name string, lastCommitSHA string, status string, error string",
    )
    excluded = spark.createDataFrame([("o/a",)], "name string")
    snapshots = spark.createDataFrame(
        [("O/A", "1", "complete", "", True), ("o/c", "1", "missing_objects", "3 blobs", False), ("o/d", "1", "complete", "", True)],
        "name string, lastCommitSHA string, state string, detail string, complete boolean",
    )
    assert rows(attempts.repository_gate(sources, excluded, snapshots), "name", "gate", "gate_reason") == [
        ("O/A", "explicitly_excluded", "explicitly_excluded"),
        ("o/b", "scan_error", "boom"),
        ("o/c", "snapshot_incomplete", "missing_objects: 3 blobs"),
        ("o/d", "ready", ""),
    ]


# ---------------------------------------------------------------- sampling


def population(spark, counts):
    data = [(f"{lang}/r{i}", f"{i:040x}", lang, "MIT", "f.csv", i) for lang, n in counts.items() for i in range(n)]
    return spark.createDataFrame(
        data, "name string, lastCommitSHA string, mainLanguage string, license string, source_file string, input_index bigint"
    )


def test_schedule_rounds(spark):
    people = population(spark, {"Java": 5, "Python": 3, "Go": 9})
    drop = spark.createDataFrame([("PYTHON/R0",)], "name string")
    plan = sampling.schedule(people, ("Java", "Python"), 7, drop)
    got = plan.orderBy("sample_order").collect()
    assert [r["sample_order"] for r in got] == [1, 2, 3, 4]
    assert [r["sampling_language"] for r in got] == ["Java", "Python"] * 2
    assert {r["language_population"] for r in got if r["sampling_language"] == "Python"} == {2}
    assert rows(sampling.schedule(people.repartition(9), ("Java", "Python"), 7, drop), "sample_order", "name") == rows(
        plan, "sample_order", "name"
    )
    assert sampling.schedule(people, ("Java", "Rust"), 7).count() == 0


def test_stratified_sample_quotas(spark):
    people = population(spark, {"Java": 9, "Python": 9, "Go": 9})
    got = sampling.stratified_sample(people, ("Java", "Python", "Go"), 8, 1).collect()
    assert sorted(r["sample_order"] for r in got) == list(range(1, 9))
    sizes = {r["sampling_language"]: r["language_sample_size"] for r in got}
    assert sorted(sizes.values()) == [2, 3, 3]
    assert all(r["inclusion_probability"] == r["language_sample_size"] / 9 for r in got)
    with pytest.raises(ValueError, match="at least the number"):
        sampling.stratified_sample(people, ("Java", "Python", "Go"), 2, 1)


@pytest.mark.parametrize("n", [5, 7, 23, 101])
def test_size_strata_boundaries(spark, n):
    data = [("o/r", "1", f"p{i:04d}", i // 3) for i in range(n)]
    df = spark.createDataFrame(data, "name string, lastCommitSHA string, markdown_path string, size_bytes bigint")
    got = [r["stratum"] for r in sampling.size_strata(df).orderBy("size_bytes", "markdown_path").collect()]
    expected = [s + 1 for s in range(5) for _ in range(n * s // 5, n * (s + 1) // 5)]
    assert got == expected


def test_size_sample_and_select_all(spark):
    data = [("o/r", "1", f"p{i:04d}", i) for i in range(53)]
    df = spark.createDataFrame(data, "name string, lastCommitSHA string, markdown_path string, size_bytes bigint")
    got = sampling.size_sample(df, 10, 3).orderBy("custom_id").collect()
    assert [r["custom_id"] for r in got] == [f"candidate-{i:04d}" for i in range(1, 11)]
    assert [r["stratum"] for r in got] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    whole = sampling.select_all(df).orderBy("markdown_path").collect()
    assert whole[52]["custom_id"] == "candidate-0053" and whole[0]["stratum_population"] == 53
    with pytest.raises(ValueError, match="multiple"):
        sampling.size_sample(df, 12, 3)


def test_hard_cases_never_reuse_an_owner_or_project(spark):
    data = [
        ("o1/p1", "Java", "pass", "1"), ("o2/p2", "Java", "pass", "2"), ("o1/p3", "Java", "review", "9"),
        ("o3/P1", "Java", "review", "8"), ("o3/p4", "Java", "review", "7"), ("o4/p5", "Java", "review", "1"),
    ]
    df = spark.createDataFrame(
        [(n, lang, s, c, "[]", "style.md", "false") for n, lang, s, c in data],
        "name string, mainLanguage string, guideline_status string, candidate_count string, "
        "candidate_documents_json string, guideline_path string, tree_truncated string",
    )
    got = rows(sampling.hard_cases(df, ["Java"], (1, 1, 1)), "sampling_stratum", "name", "difficulty_score")
    assert got == [("dense_unconfirmed", "o3/p4", 7), ("subtle_confirmed", "o1/p1", 1), ("weak_unconfirmed", "o4/p5", 1)]
    with pytest.raises(ValueError, match="not enough diverse"):
        sampling.hard_cases(df, ["Java"], (3, 1, 1))
    # A repeated name is one case.
    twice = df.unionByName(df).unionByName(df.withColumn("guideline_path", F.lit("a.md")))
    assert rows(sampling.hard_cases(twice, ["Java"], (1, 1, 1)), "sampling_stratum", "name", "difficulty_score") == got


@pytest.mark.parametrize("seed", [3, 4])
def test_hard_cases_equal_one_pick_at_a_time(spark, seed):
    rng = random.Random(seed)
    data = [(f"o{rng.randint(0, 30) if i % 3 else 0}/p{rng.randint(0, 40)}-{i % 50}", rng.choice("ab"), rng.choice(["pass", "review", "x"]), str(rng.randint(0, 9))) for i in range(400)]
    data = list({row[0]: row for row in data}.values())
    df = spark.createDataFrame(data, "name string, mainLanguage string, guideline_status string, candidate_count string").selectExpr(
        "*", "'[]' candidate_documents_json", "'style.md' guideline_path", "'false' tree_truncated"
    )
    score = dict(rows(df.select("name", labels.difficulty("candidate_documents_json", "candidate_count", "guideline_status", "guideline_path"))))
    used, want = set(), []
    for language in "ab":
        for (stratum, status, descending, _), quota in zip(sampling.HARD_STRATA, (1, 2, 2)):
            for _ in range(quota):
                open_rows = [r[0] for r in data if r[1:3] == (language, status) and not used & set(r[0].lower().split("/")[:1] + ["/" + r[0].lower().split("/")[1]])]
                best = min(open_rows, key=lambda n: (-score[n] if descending else score[n], n.lower(), n))
                used |= {best.lower().split("/")[0], "/" + best.lower().split("/")[1]}
                want.append((stratum, best, score[best]))
    assert rows(sampling.hard_cases(df, ["a", "b"]), "sampling_stratum", "name", "difficulty_score") == sorted(want, key=repr)


# ---------------------------------------------------------------- quota


def test_only_small_tables_of_strata_are_broadcast(spark, monkeypatch):
    strata = spark.createDataFrame([("a", 1), ("b", 2)], "language string, quota bigint")
    screenings = spark.createDataFrame([(i, "ab"[i % 2], f"o/{i}", "pass") for i in range(8)], "sample_order bigint, language string, repository string, status string")
    want = [("a", 0), ("b", 1), ("b", 3)]
    assert rows(quota.selected_by_stratum(screenings, strata), "language", "sample_order") == want
    monkeypatch.setattr(quota, "MAX_STRATA", 1)
    assert rows(quota.selected_by_stratum(screenings, strata), "language", "sample_order") == want


def loop_screen(schedule, quotas, budget):
    """The sequential wave loop, row by row."""
    done, have = [], {k: 0 for k in quotas}
    for number in sorted({r[1] for r in schedule}):
        active = {k for k in quotas if have[k] < quotas[k]}
        if not active:
            break
        wave = [r for r in schedule if r[1] == number and r[2] in active]
        if budget is not None and len(done) + len(wave) > budget:
            break
        for row in wave:
            done.append(row[0])
            have[row[2]] += row[4] == "pass"
    return sorted(done)


@pytest.mark.parametrize("seed", range(2))
def test_screened_prefix_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    languages = ["a", "b", "c"]
    schedule = [
        (i + 1, i // 3 + 1, languages[i % 3], f"{languages[i % 3]}/r{i}", rng.choice(["pass", "not_found", "unresolved"]))
        for i in range(60)
    ]
    quotas = {"a": rng.randint(0, 4), "b": rng.randint(1, 8), "c": rng.randint(0, 30)}
    df = spark.createDataFrame(schedule, "sample_order bigint, round_number bigint, language string, repository string, status string")
    q = spark.createDataFrame(list(quotas.items()), "language string, quota bigint")
    for budget in (None, 10, 33, 500):
        got = sorted(r["sample_order"] for r in quota.screened_prefix(df, q, budget).collect())
        assert got == loop_screen(schedule, quotas, budget), budget


def test_licence_rules(spark):
    rows_ = spark.createDataFrame([("a", " MIT "), ("b", "mit"), ("c", ""), ("d", "Other"), ("e", "BSD")], "n string, license_name string")
    allow = spark.createDataFrame([("MIT",), ("other",), ("",)], "license_name string")
    assert rows(quota.allowed(rows_, allow), "n") == [("a",)]
    assert rows(quota.rejected(rows_, allow), "n") == [("b",), ("c",), ("d",), ("e",)]


@pytest.mark.parametrize(
    ("applied", "reached", "human", "stage"),
    [
        (False, False, False, "provisional_screening"),
        (False, True, False, "needs_license_review"),
        (True, False, False, "needs_replenishment"),
        (True, True, False, "needs_file_review"),
        (True, True, True, "ready_to_finalize"),
        (True, False, True, "ready_to_finalize"),
    ],
)
def test_workflow_stage(spark, applied, reached, human, stage):
    got = spark.range(1).select(quota.workflow_stage(F.lit(applied), F.lit(reached), F.lit(human))).first()[0]
    assert got == stage and got in quota.NEXT_ACTIONS


# ---------------------------------------------------------------- costs and roll-up


@pytest.mark.parametrize(
    ("extraction", "candidates_", "statuses", "expected"),
    [
        ("scan_error", 0, [], "scan_error"),
        ("completed", 0, [], "no_candidates"),
        ("completed", 2, ["pass", "model_error"], "pass"),
        ("completed", 1, ["review"], "pass"),
        ("completed", 2, ["not_found", "input_too_large"], "unresolved"),
        ("completed", 2, ["not_found"], "unresolved"),
        ("completed", 2, ["not_found", "not_found"], "not_found"),
    ],
)
def test_repository_precedence(spark, extraction, candidates_, statuses, expected):
    summary = spark.createDataFrame(
        [("a", "1", extraction, "", candidates_)],
        "name string, lastCommitSHA string, status string, error string, candidate_file_count bigint",
    )
    labelled = spark.createDataFrame([("a", "1", s) for s in statuses], "name string, lastCommitSHA string, status string")
    assert costs.repository_rollup(summary, labelled).first()["status"] == expected


def test_extrapolation_needs_every_stratum(spark):
    data = [(s, 10 * s, "pass", "0.5") for s in range(1, 6)] + [(1, 10, "model_error", "9")]
    df = spark.createDataFrame(data, "stratum int, stratum_population bigint, status string, cost_usd string").withColumn(
        "cost_usd", F.col("cost_usd").cast("decimal(18,9)")
    )
    assert costs.extrapolated_cost(df).first()["estimated_full_cost_usd"] == 75.0
    assert costs.extrapolated_cost(df, billed=23.0).first()["estimated_full_cost_usd"] == 75.0 * 23.0 / 11.5
    assert costs.extrapolated_cost(df.where("stratum <> 3")).first()["estimated_full_cost_usd"] is None


# ---------------------------------------------------------------- evaluation


def test_three_class_report(spark):
    gold = spark.createDataFrame(
        [("a", "1", "pass"), ("b", "1", "review"), ("c", "1", "not_found")], "repository string, revision string, status string"
    )
    model = spark.createDataFrame(
        [("a", "1", "pass"), ("b", "1", "not_found"), ("c", "1", "not_found")],
        "name string, lastCommitSHA string, guideline_status string",
    )
    report = evaluate.label_report(evaluate.matched_labels(gold, model)).first()
    assert report["samples"] == 3
    assert report["accuracy"] == pytest.approx(2 / 3)
    assert report["macro_f1"] == pytest.approx(5 / 9)
    assert evaluate.confusion_matrix(evaluate.matched_labels(gold, model)).count() == 9


def test_binary_report_drops_unknown_statuses_but_counts_them(spark):
    checklist = spark.createDataFrame(
        [("r", "u1", "pass"), ("r", "u2", "not_found"), ("r", "u3", "pass"), ("r", "u4", "not_found"), ("q", "u5", "pass"),
         ("q", "u6", "pass"), ("q", "u7", ""), ("q", "u8", "pass")],
        "repository string, github_url string, human_decision string",
    )
    model = spark.createDataFrame(
        [("u1", "pass"), ("u2", "pass"), ("u3", "not_found"), ("u4", "not_found"), ("u5", "review"), ("u6", "retrieval_error"), ("u7", "pass")],
        "markdown_url string, status string",
    )
    rows_ = evaluate.evaluated_files(checklist, model)
    report = evaluate.binary_metrics(rows_, evaluate.labeled_count(checklist)).first()
    assert (report["true_positives"], report["false_positives"], report["false_negatives"], report["true_negatives"]) == (1, 1, 1, 1)
    assert report["resolved_accuracy"] == 0.5
    assert report["human_labeled_files"] == 7
    assert report["strict_accuracy"] == pytest.approx(2 / 7)
    assert report["missing_predictions"] == 1 and report["review_decisions"] == 1
    assert rows_.count() == 6
    scope = evaluate.repository_scope(rows_).first()
    assert tuple(scope) == (2, 2, 1)


def test_empty_metrics_are_null(spark):
    rows_ = spark.createDataFrame([("r", "pass", "", "missing_prediction")], "repository string, human_decision string, llm_decision string, outcome string")
    report = evaluate.binary_metrics(rows_).first()
    assert report["resolved_accuracy"] is None and report["precision"] is None and report["f1"] is None
    assert report["strict_accuracy"] == 0.0


# ---------------------------------------------------------------- review


def greedy_batches(documents, max_documents, max_characters):
    """(repository, position) → first position of its batch."""
    starts = {}
    for repository, group in itertools.groupby(documents, key=lambda d: d[0]):
        count = characters = start = 0
        for position, (_, _, length) in enumerate(group, start=1):
            if count and (count >= max_documents or characters + length > max_characters):
                count = characters = 0
            if not count:
                start = position
            count, characters = count + 1, characters + length
            starts[repository, position] = start
    return starts


@pytest.mark.parametrize(("segment", "seed"), [(12, 1), (13, 2), (30, 1), (10_000, 2)])
def test_packing_equals_the_greedy_loop(spark, segment, seed):
    rng = random.Random(seed)
    documents = [
        (repository, key, rng.choice([0, 1, 5, 20, 60, 130]))
        for repository, size in (("a", 1), ("b", 12), ("c", 13), ("hot", 211), ("d", 40))
        for key in range(size)
    ]
    df = spark.createDataFrame(
        [(r, k, f"{r}{k}", n) for r, k, n in documents],
        "repository string, position_key int, custom_id string, characters int",
    ).repartition(5)
    packed = review.pack_batches(df, 12, 100, segment, max_group_rows=50)
    got = {(r["repository"], r["position"]): r["batch_start"] for r in packed.collect()}
    assert got == greedy_batches(documents, 12, 100)


def loop_names(bases, used):
    """Names only ever get taken, so the search for a base's next name goes on where it last ended."""
    taken, out, tried = {u.lower() for u in used}, [], {}
    for base in bases:
        stem, dot, ext = base.rpartition(".") if "." in base else (base, "", "")
        number = tried.get(base.lower(), 1)
        name = f"{stem}__{number}{dot}{ext}" if number > 1 else base
        while name.lower() in taken:
            number += 1
            name = f"{stem}__{number}{dot}{ext}"
        tried[base.lower()] = number
        taken.add(name.lower())
        out.append(name)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_unused_filenames_equal_the_probe_loop(spark, seed):
    rng = random.Random(seed)
    pool = ["a.md", "A.md", "a__2.md", "a__2__2.md", "b.md", "b c.md", "b:c.md", "d__7.md"]
    paths_ = [rng.choice(pool) for _ in range(60)]
    used = ["o--r/a__3.md", "o--r/B.md", "o--r/b__2.md", "o--r/b__4.md", "o--r/d__7__2.md", "o--r/b__03.md"]
    df = spark.createDataFrame([(i, "o/r", p) for i, p in enumerate(paths_)], "i int, name string, markdown_path string")
    taken = spark.createDataFrame([(u,) for u in used], "file string")
    got = review.unused_filenames(df, taken, ["i"], ["i"]).orderBy("i").collect()
    bases = ["o--r/" + re.sub(r"[^A-Za-z0-9._-]+", "_", p) for p in paths_]
    assert [r["file"] for r in got] == loop_names(bases, used)


def test_numbered_filenames(spark):
    df = spark.createDataFrame(
        [(1, "o/r", "README.md"), (2, "o/r", "readme.md"), (3, "o/r", "x y"), (4, "o/r", "x-y"), (5, "o/r", "x:y")],
        "i int, name string, markdown_path string",
    )
    got = review.numbered_filenames(df, ["i"]).orderBy("i").collect()
    assert [r["file"] for r in got] == ["o--r/README.md", "o--r/readme__2.md", "o--r/x_y", "o--r/x-y", "o--r/x_y__2"]


CHECKLIST = ", ".join(f"{c} string" for c in review.CHECKLIST_COLUMNS)


def test_merge_keeps_annotated_and_refreshes_current(spark):
    def row(repository, file, url, human="", note=""):
        return (repository, file, url, "added_round_1", "pass", human, "", "", "", note)

    existing = spark.createDataFrame(
        [row("A/x", "f1", "u1", "pass"), row("a/X", "f2", "u2"), row("b/y", "f3", "u3"), row("b/y", "f4", "u4")], CHECKLIST
    ).withColumn("position", F.monotonically_increasing_id())
    current = spark.createDataFrame(
        [("b/y", "g3", "u3", "review"), ("c/z", "g5", "u5", "pass"), ("c/z", "g6", "u6", "pass")],
        "repository string, file string, github_url string, llm_decision string",
    ).withColumn("position", F.monotonically_increasing_id())
    origin = review.next_round(existing, True).first()["review_origin"]
    assert origin == "added_round_2"
    merged = review.merge_checklist(existing, current, origin).orderBy("position").collect()
    assert [(r["github_url"], r["file"], r["llm_decision"], r["review_origin"]) for r in merged] == [
        ("u1", "f1", "pass", "added_round_1"),
        ("u2", "f2", "pass", "added_round_1"),
        ("u3", "f3", "review", "added_round_1"),
        ("u5", "g5", "pass", "added_round_2"),
        ("u6", "g6", "pass", "added_round_2"),
    ]


def test_a_merge_makes_one_outer_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_HEAVY_ROWS", 2)
    jobs = []
    monkeypatch.setattr(skew, "materialize", lambda df: jobs.append(df) or materialize(df))
    old = [("a/x", f"f{i}", f"u{i}", "o", "pass", "pass" if i == 0 else "", "", "", "", "") for i in range(40)]
    existing = spark.createDataFrame(old, CHECKLIST).withColumn("position", F.monotonically_increasing_id())
    new = [("a/x" if i < 40 else "b/y", f"g{i}", f"u{i}", "pass") for i in range(20, 70)]
    current = spark.createDataFrame(new, "repository string, file string, github_url string, llm_decision string").withColumn("position", F.monotonically_increasing_id())
    merged = review.merge_checklist(existing, current, "n")
    joins = [df._jdf.queryExecution().analyzed().toString().count("Join FullOuter") for df in [*jobs, merged]]
    assert joins == [0, 1]
    assert "a/x" in {r["__key"] for df in jobs for r in df.collect()}
    assert rows(merged, "github_url") == sorted([(f"u{i}",) for i in range(70)], key=repr)


def test_review_outcomes(spark):
    checklist = spark.createDataFrame(
        [("a", "f1", "pass", ""), ("a", "f2", "pass", "f1"), ("b", "f3", "not_found", "")],
        "repository string, file string, human_decision string, duplicate_of string",
    )
    assert rows(review.repository_outcomes(checklist)) == [("a", "accepted", 1, 1, 0), ("b", "rejected", 0, 0, 1)]
    assert rows(review.review_state(checklist)) == [("a", "confirmed"), ("b", "rejected")]


def test_upgrade_checklist(spark):
    old = spark.createDataFrame([("r", "f", "u", "pass")], "repository string, file string, github_url string, human_decision string")
    assert readers.upgrade_checklist(old).first()["duplicate_of"] == ""
    with pytest.raises(ValueError, match="missing required columns"):
        readers.upgrade_checklist(old.drop("file"))


def test_threshold_tables_equal_their_steps():
    rng = random.Random(6)
    for size in (0, 1, 2, 5, 30):
        for _ in range(40):
            steps = [rng.choice([rng.randint(-6, 12), review.NEVER]) for _ in range(size)]
            table = review.threshold_table(steps)
            assert table == sorted(set(table)) and len(table) == size
            for start in range(-10, 20):
                u = start
                for c in steps:
                    u += u < c
                assert u - start == sum(d >= start for d in table)


@pytest.mark.parametrize(("seed", "block"), [(1, 1), (2, 3), (1, 20_000)])
def test_mixed_families_equal_the_probe_loop_in_any_blocks(spark, seed, block):
    rng = random.Random(seed)
    pool = ["a.md"] * 6 + [f"a__{n}.md" for n in range(2, 14)] + ["a__2__2.md", "a__2__3.md", "a__3__2__2.md", "a__3__2.md", "A__4.MD", "a__01.md", "a__1.md", "a", "a__2"]
    paths_ = [rng.choice(pool) for _ in range(90)]
    used = ["o--r/a__5.md", "o--r/a__9.md", "o--r/a__2__3.md", "o--r/A__3__2.md", "o--r/a__40.md"] + ["o--r/a.md"] * (seed == 2)
    df = spark.createDataFrame([(i, "o/r", p) for i, p in enumerate(paths_)], "i int, name string, markdown_path string")
    taken = spark.createDataFrame([(u,) for u in used], "file string")
    got = review.unused_filenames(df, taken, ["i"], ["i"], block_rows=block).orderBy("i").collect()
    assert [r["file"] for r in got] == loop_names([f"o--r/{p}" for p in paths_], used)


def test_one_large_mixed_family_is_numbered_in_blocks(spark):
    """100,000 names of one family: half of them one base, the others each a numbered form of it."""
    n = 50_000
    numbers = spark.range(2 * n).select(
        (F.col("id") * 7919 % (2 * n)).alias("i"),
        F.lit("o/r").alias("name"),
        F.when(F.col("id") % 2 == 0, F.lit("a.md")).otherwise(F.concat(F.lit("a__"), F.expr("string(id DIV 2 + 2)"), F.lit(".md"))).alias("markdown_path"),
    )
    got = review.unused_filenames(numbers, spark.createDataFrame([], "file string"), ["i"], ["i"], block_rows=5_000)
    have = [r["file"] for r in got.orderBy("i").select("file").collect()]
    assert have == loop_names([f"o--r/{r['markdown_path']}" for r in numbers.orderBy("i").collect()], [])

