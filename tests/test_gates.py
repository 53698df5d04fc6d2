import re

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from gleanwork.bindings import all_queries, all_sql
from gleanwork.operators import gates, publish
from gleanwork.plans import collection
from gleanwork.session import materialize
from gleanwork.sources import digest_record

POPULATION = (
    "name string, lastCommitSHA string, lastCommit string, mainLanguage string, stargazers string, totalIssues string, "
    "totalPullRequests string, forks string, contributors string, isFork string"
)
GOOD = ("owner/project", "a" * 40, "2026-01-01T00:00:00+00:00", "Java", "1000", "200", "200", "200", "10", "false")
FIELDS = [part.split()[0] for part in POPULATION.split(", ")]


def changed(**values):
    return tuple(values.get(name, value) for name, value in zip(FIELDS, GOOD, strict=True))


def others():
    return [changed(name=f"o/{lang}", mainLanguage=lang) for lang in ("JavaScript", "Python", "TypeScript")]


@pytest.mark.parametrize(
    ("values", "rule"),
    [
        ({}, None),
        ({"stargazers": "999"}, "stargazers_minimum"),
        ({"totalIssues": "199"}, "totalIssues_minimum"),
        ({"totalPullRequests": "199"}, "totalPullRequests_minimum"),
        ({"forks": "199"}, "forks_minimum"),
        ({"contributors": " 9 "}, "contributors_minimum"),
        ({"contributors": " 10 "}, None),
        ({"forks": "many"}, "forks_integer"),
        ({"isFork": "True"}, "is_fork"),
        ({"isFork": " FALSE"}, None),
        ({"mainLanguage": "Go"}, "language"),
    ],
)
def test_selection_thresholds(spark, values, rule):
    df = spark.createDataFrame([changed(**values), changed(name="x/y"), *others()], POPULATION)
    found = [r["rule"] for r in gates.selection_criteria(df).collect()]
    assert found == ([rule] if rule else [])


def test_all_violations_are_reported(spark):
    df = spark.createDataFrame([changed(stargazers="1", isFork="true"), changed(name="OWNER/Project", forks="")], POPULATION)
    found = rows(gates.selection_criteria(df), "rule", "key")
    assert found == [
        ("duplicate_repository", "owner/project"),
        ("forks_integer", "OWNER/Project"),
        ("is_fork", "owner/project"),
        ("missing_stratum", "JavaScript"),
        ("missing_stratum", "Python"),
        ("missing_stratum", "TypeScript"),
        ("stargazers_minimum", "owner/project"),
    ]


@pytest.mark.parametrize(
    ("values", "rule"),
    [
        ({}, None),
        ({"name": "no-slash"}, "name_format"),
        ({"name": "a/b/c"}, "name_format"),
        ({"lastCommitSHA": "abc"}, "revision_format"),
        ({"lastCommitSHA": "g" * 40}, "revision_format"),
        ({"lastCommit": "2025-12-31T23:59:59+00:00"}, "snapshot_window"),
        ({"lastCommit": "2025-12-31T23:59:59-01:00"}, None),
        ({"lastCommit": "2026-01-01T00:30:00+01:00"}, "snapshot_window"),
        ({"lastCommit": "2026-01-01"}, None),
        ({"lastCommit": "2026-01-01T00:00:00"}, None),
        ({"lastCommit": "2025-12-31 23:59:59.999"}, "snapshot_window"),
        ({"lastCommit": "2026"}, "timestamp_format"),
        ({"lastCommit": "2026-13-01"}, "timestamp_format"),
        ({"lastCommit": ""}, "timestamp_format"),
    ],
)
def test_population_format(spark, values, rule):
    df = spark.createDataFrame([changed(**values)], POPULATION)
    assert [r["rule"] for r in gates.population_format(df).collect()] == ([rule] if rule else [])


CHECKLIST = "file string, human_decision string, duplicate_of string"


@pytest.mark.parametrize(
    ("data", "rules"),
    [
        ([("a", "pass", ""), ("b", "pass", "a"), ("c", "not_found", "")], []),
        ([("a", "", "")], ["human_decision"]),
        ([("a", "maybe", "")], ["human_decision"]),
        ([("a", "pass", ""), ("a", "pass", "")], ["file_not_unique"]),
        ([("a", "pass", "x")], ["duplicate_target_absent"]),
        ([("a", "pass", ""), ("b", "not_found", "a")], ["duplicate_not_pass"]),
        ([("a", "not_found", ""), ("b", "pass", "a")], ["duplicate_target_not_pass"]),
        ([("a", "pass", ""), ("b", "pass", "a"), ("c", "pass", "b")], ["duplicate_target_not_pass"]),
    ],
)
def test_checklist_integrity(spark, data, rules):
    found = gates.checklist_integrity(spark.createDataFrame(data, CHECKLIST))
    assert [r["rule"] for r in found.collect()] == rules


# ---------------------------------------------------------------- final bundle

SELECTED = "repository string, revision string, sampling_language string, license_name string, origin string, sample_order bigint"
REVIEW = "repository string, file string, github_url string, human_decision string, duplicate_of string, review_origin string"
R1, R2 = "1" * 40, "2" * 40


def bundle(spark, selected=None, new=None, targets=None, allow=None, baseline=None):
    selected = selected or [("O/base", R1, "Java", "MIT", "baseline", None), ("O/new", R2, "Python", "MIT", "new_pending", 4)]
    new = new or [("o/new", "n1", f"https://github.com/O/new/blob/{R2}/a.md", "pass", "", "added_round_1")]
    old = [
        ("o/base", "b1", f"https://github.com/O/base/blob/{R1}/a.md", "pass", "", "existing"),
        ("o/base", "b2", f"https://github.com/O/base/blob/{R1}/b.md", "pass", "b1", "existing"),
        ("o/gone", "b3", f"https://github.com/O/gone/blob/{R1}/b.md", "not_found", "", "existing"),
    ]
    return dict(
        selected=spark.createDataFrame(selected, SELECTED),
        checklists={"baseline": spark.createDataFrame(old, REVIEW), "new": spark.createDataFrame(new, REVIEW)},
        targets=spark.createDataFrame(targets or [("Java", 1), ("Python", 1)], "language string, target bigint"),
        allowlist=spark.createDataFrame([(a,) for a in (allow or ["MIT"])], "license_name string"),
        baseline=spark.createDataFrame([(b,) for b in (baseline or ["o/BASE"])], "repository string"),
    )


def test_finalize_clean_bundle(spark):
    out = collection.finalize(**bundle(spark))
    assert rows(out.repositories, "repository", "origin", "guideline_file_count") == [("O/base", "baseline", 1), ("O/new", "new", 1)]
    assert rows(out.files, "repository", "file", "revision") == [("O/base", "b1", R1), ("O/new", "n1", R2)]
    assert ("files_by_origin", "new", 1) in rows(out.totals)


GOOD_NEW = ("O/new", R2, "Python", "MIT", "new_pending", 4)
GOOD_BASE = ("O/base", R1, "Java", "MIT", "baseline", None)
URL = f"https://github.com/O/new/blob/{R2}/a.md"


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"targets": [("Java", 1), ("Python", 2)]}, "repository_count"),
        ({"targets": [("Java", 2), ("Go", 0)]}, "quota_mismatch"),
        ({"allow": ["BSD"]}, "license_not_allowed"),
        ({"baseline": ["o/other"]}, "baseline_set"),
        ({"selected": [GOOD_BASE, ("O/new", "abc", "Python", "MIT", "new", 4)]}, "revision_format"),
        ({"selected": [GOOD_BASE, (*GOOD_NEW[:4], "odd", 4)]}, "unknown_origin"),
        ({"selected": [GOOD_BASE, ("O/else", R2, "Python", "MIT", "new", 4)]}, "accepted_set"),
        ({"selected": [GOOD_BASE, ("o/BASE", R1, "Python", "MIT", "new", 4)]}, "duplicate_selected"),
        ({"new": [("o/new", "n1", f"https://github.com/O/new/blob/{R1}/a.md", "pass", "", "x")]}, "revision_mismatch"),
        ({"new": [("o/new", "n1", URL, "pass", "", "x"), ("o/new", "n2", URL, "pass", "", "x")]}, "github_url_duplicate"),
        ({"new": [("o/new", "n1", URL, "pass", "", "x"), ("o/new", "n1", URL + "2", "pass", "", "x")]}, "file_not_unique"),
        ({"new": [("o/new", "b1", URL, "pass", "", "x")]}, "file_duplicate"),
        ({"new": [("o/new", "n1", URL, "", "", "x")]}, "human_decision"),
    ],
)
def test_every_broken_invariant_stops_the_bundle(spark, change, message):
    with pytest.raises(ValueError) as caught:
        collection.finalize(**bundle(spark, **change))
    assert message in str(caught.value)


def test_the_bundle_gate_scans_each_input_once(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(gates, "materialize", lambda df: seen.append(df) or materialize(df))
    inputs = bundle(spark, selected=[GOOD_BASE, GOOD_NEW, ("O/new", R2, "Go", "X", "odd", 5), ("O/new", R2, "Go", "X", "odd", 6)])
    tables = {k: inputs[k] for k in ("selected", "targets", "allowlist", "baseline")}
    new = inputs["checklists"]["new"].withColumn("origin", F.lit("new"))
    tables["files"] = new.unionByName(new.withColumns({"file": F.lit(None).cast("string"), "github_url": F.lit("https://github.com/o/new/blob/x/y.md")}))
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    found = gates.final_bundle(tables["selected"], tables["files"], tables["files"], tables["targets"], tables["allowlist"], tables["baseline"])
    (entries,) = seen
    scans = re.findall(r"Scan parquet", entries._jdf.queryExecution().executedPlan().toString())
    assert len(scans) == len(tables)
    assert rows(found) == sorted([
        ("repository_count", "total", "4"), ("quota_mismatch", "Go", "2"), ("duplicate_selected", "o/new", "3"),
        ("accepted_set", "o/base@baseline", "left_only"), ("file_blank", "", "1"),
        ("license_not_allowed", "o/new", "X"), ("license_not_allowed", "o/new", "X"), ("unknown_origin", "o/new", "odd"), ("unknown_origin", "o/new", "odd"),
        *[("revision_mismatch", "o/new", "https://github.com/o/new/blob/x/y.md")],
    ], key=repr)


def test_settings_gates(spark):
    def settings(**values):
        return publish.settings_table(spark, values)

    pending = settings(seed=1, license_policy_status="pending", license_allowlist=[])
    applied = settings(seed=1, license_policy_status="applied", license_allowlist=["MIT"])
    raw = "json_value"
    old = pending.withColumn("value", F.expr("replace(value, '\"', '')")).withColumnRenamed("json", raw)
    new = applied.withColumn("value", F.expr("replace(value, '\"', '')"))
    assert gates.incompatible_settings(old, new).count() == 0
    assert rows(gates.incompatible_settings(new, old), "key") == [("license_allowlist",), ("license_policy_status",)]
    moved = settings(seed=2, license_policy_status="applied", license_allowlist=[]).withColumn("value", F.expr("replace(value, '\"', '')"))
    assert rows(gates.incompatible_settings(old, moved), "key") == [("seed",)]
    assert rows(gates.incompatible_prior(settings(sample_seed=1, note="a"), settings(sample_seed=2, note="b")), "key") == [("sample_seed",)]


def test_bound_settings_are_whole_numbers_as_in_sql(spark, tmp_path):
    balances = [0.5, 1.5, 2.5, -0.5, -1.5, -2.5, 1658.5, 2.49, 2.51, 7.0]
    names = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
    customers = [((i + 1) * 25, f"c{i}", 1, b) for i, b in enumerate(balances)]
    spark.createDataFrame(customers, names).write.parquet(f"{tmp_path}/customer.parquet")
    duckdb.execute(f"CREATE OR REPLACE TEMP VIEW customer AS SELECT * FROM read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    want = duckdb.sql(all_sql()["v9_incompatible_settings"]).fetchall()
    got = all_queries()["v9_incompatible_settings"](spark, str(tmp_path))
    assert rows(got, "rule", "key", "detail") == sorted(want)
    assert ("setting_changed", "c2", "3") in want



def test_digest_sees_every_change(spark):
    base = spark.createDataFrame([(1, "a", None), (2, None, "b")], "i int, x string, y string")

    def digest(df):
        return publish.table_digest(df, "t").first()["digest"]

    assert digest(base) == digest(base.repartition(5).select("y", "x", "i"))
    assert digest(base) != digest(base.union(base.limit(1)))
    swapped = spark.createDataFrame([(1, None, "a"), (2, None, "b")], "i int, x string, y string")
    assert digest(base) != digest(swapped)
    assert digest(base) != digest(base.withColumnRenamed("x", "z"))
    assert digest(base.limit(0)) != digest(base)


def test_recorded_digests_read_changed_files_only(spark, tmp_path):
    table, single, record = str(tmp_path / "a table"), str(tmp_path / "one"), str(tmp_path / "record")
    data = spark.createDataFrame([(i, f"t{i}", i % 2) for i in range(20)], "i int, x string, part int")
    data.repartition(3).write.partitionBy("part").parquet(table)
    data.drop("part").limit(0).coalesce(1).write.parquet(single)

    def run():
        out = {r["role"]: r for r in digest_record.recorded_digests(spark, {"t": table, "empty": single}, record).collect()}
        for role, path in (("t", table), ("empty", single)):
            whole = publish.table_digest(spark.read.parquet(path), role).first()
            assert (out[role]["rows"], out[role]["digest"]) == (whole["rows"], whole["digest"])
        return {role: (r["files"], r["files_read"]) for role, r in out.items()}

    first = run()
    assert first["t"][0] == first["t"][1] > 2 and first["empty"] == (1, 1)
    assert run() == {"t": (first["t"][0], 0), "empty": (1, 0)}
    data.limit(1).write.mode("append").partitionBy("part").parquet(table)
    assert run()["t"] == (first["t"][0] + 1, 1)
    # A file that goes leaves the sums; a version that broke off is passed over.
    gone = next(p for p in (tmp_path / "a table").rglob("*.parquet"))
    gone.unlink()
    (tmp_path / "record" / "version-000000000009").mkdir()
    assert run()["t"] == (first["t"][0], 0)
    # Another schema: every file is read again, versions before the last whole one are gone.
    data.withColumn("y", F.lit(1)).write.mode("overwrite").partitionBy("part").parquet(table)
    files, read = run()["t"]
    assert files == read
    assert sorted(p.name[-2:] for p in (tmp_path / "record").iterdir()) == ["10", "11"]


def test_recorded_digest_of_a_single_file(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t"))
    path = str(next((tmp_path / "t").glob("*.parquet")))
    out = digest_record.recorded_digests(spark, {"t": path}, str(tmp_path / "record")).first()
    assert (out["rows"], out["files"], out["digest"]) == (5, 1, publish.table_digest(spark.read.parquet(path), "t").first()["digest"])


def test_review_consistency(spark):
    screenings = spark.createDataFrame(
        [(1, "O/a", "pass"), (2, "o/b", "not_found"), (3, "o/c", "pass")], "sample_order bigint, repository string, status string"
    )
    prior = spark.createDataFrame([(1, "o/d", "pass"), (2, "o/e", "pass")], "sample_order bigint, repository string, status string")
    reviewed = spark.createDataFrame([("o/A",), ("o/b",), ("o/d",), ("o/zz",)], "repository string")
    assert rows(gates.review_consistency(reviewed, screenings, prior), "rule", "key") == [
        ("contradictory_review", "o/b"),
        ("unproven_review", "o/b"),
        ("unproven_review", "o/zz"),
        ("unreviewed_prior_positive", "o/e"),
    ]


@pytest.mark.parametrize("name", ["f24_table_digests", "f24_digest_is_order_free", "f24_recorded_digests"])
def test_copies_for_digests_have_as_many_partitions_as_the_scan(spark, monkeypatch, name):
    frame = type(spark.range(1))
    deal, dealt = frame.repartition, []

    def seen(df, count, *keys):
        dealt.append((count, df.rdd.getNumPartitions()))
        return deal(df, count, *keys)

    monkeypatch.setattr(frame, "repartition", seen)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    try:
        folder = "/root/testdata/sf0.001"
        got = [r.asDict() for r in all_queries()[name](spark, folder).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert max(scan for _, scan in dealt) > 7
    assert all(count >= scan for count, scan in dealt)
    assert got and all(r["same_digest"] for r in got)
