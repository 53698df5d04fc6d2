import re

import __spark_entry__ as entry
from gleanwork.bindings import all_queries, all_sql
from gleanwork.operators import ordering


def test_every_sql_has_a_query_and_names_follow_the_ids():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # The optional part has names of its own, and operators that SQL cannot express.
    queries, sql = all_queries(), all_sql()
    assert set(queries) <= set(entry.queries())
    assert all(re.fullmatch(r"[a-z]\d+_[a-z0-9_]+", name) for name in queries)
    assert set(queries) == set(sql)


def test_flagship_runs_on_the_smallest_tables(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "files", "canonical_files", "redundant_files"]
    rows = df.collect()
    assert rows and all(r["files"] == r["canonical_files"] + r["redundant_files"] for r in rows)


def test_many_large_groups_use_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MAX_BROADCAST_GROUPS", 1)
    df = spark.range(60).selectExpr("id", "id % 3 AS g")
    got = ordering.running(df, ["g"], ["id"], rank="r", max_group_rows=5)
    assert sorted(r["r"] for r in got.collect()) == sorted(list(range(1, 21)) * 3)
