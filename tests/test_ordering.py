
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanwork.operators import ordering, skew


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key; ties everywhere."""
    return (
        spark.range(600)
        .select(
            "id",
            F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 11).cast("string")).alias("g"),
            (F.col("id") * 7 % 13).alias("v"),
        )
        .cache()
    )


def plain(hot):
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id").rowsBetween(Window.unboundedPreceding, 0)
    return hot.withColumn("s", F.sum("v").over(w)).withColumn("r", F.count("*").over(w))


@pytest.mark.parametrize("limit", [10**6, 60, 1])
@pytest.mark.parametrize("partitions", [1, 7])
def test_running_splits_hot_groups_exactly(hot, limit, partitions):
    got = ordering.running(
        hot.repartition(partitions), ["g"], [F.desc("v"), "id"], {"s": F.col("v")}, "r", max_group_rows=limit
    )
    assert rows(got, "id", "s", "r") == rows(plain(hot), "id", "s", "r")


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_dense_index_is_the_global_row_number(hot, partitions):
    got = ordering.dense_index(hot.repartition(partitions), [F.desc("v"), "id"], start=1)
    expected = [r["id"] for r in hot.orderBy(F.desc("v"), "id").collect()]
    assert [r["id"] for r in sorted(got.collect(), key=lambda r: r["input_index"])] == expected
    assert sorted(r["input_index"] for r in got.collect()) == list(range(1, 601))


def test_bucketed_rank_equals_row_number(hot):
    got = ordering.bucketed_rank(hot, ["g"], F.floor(F.col("id") / 50), ["id"], "r", "n")
    w = Window.partitionBy("g").orderBy("id")
    expected = hot.withColumn("r", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("g")))
    assert rows(got, "id", "r", "n") == rows(expected, "id", "r", "n")


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_draw_rank_ignores_input_order(hot, partitions):
    first = rows(ordering.draw_rank(hot, ["g"], F.col("id").cast("string"), 3, "r"), "id", "r")
    again = ordering.draw_rank(hot.repartition(partitions), ["g"], F.col("id").cast("string"), 3, "r")
    assert rows(again, "id", "r") == first
    other = rows(ordering.draw_rank(hot, ["g"], F.col("id").cast("string"), 4, "r"), "id", "r")
    assert other != first


@pytest.mark.parametrize("quota", [0, 1, 5, 60, 10**6])
def test_first_k(hot, quota):
    got = ordering.first_k(hot, ["g"], F.floor(F.col("id") / 50), ["id"], F.lit(quota), "r")
    expected = plain_rank(hot).where(F.col("r") <= quota)
    assert rows(got, "id", "r") == rows(expected, "id", "r")


def plain_rank(hot):
    return hot.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("id")))


def test_first_and_last_rows(hot):
    firsts = {r["g"]: r["id"] for r in ordering.first_rows(hot, ["g"], [F.col("v"), F.col("id")]).collect()}
    lasts = {r["g"]: r["id"] for r in ordering.last_rows(hot, ["g"], [F.col("v"), F.col("id")]).collect()}
    data = hot.collect()
    for group in firsts:
        members = sorted((r["v"], r["id"]) for r in data if r["g"] == group)
        assert (firsts[group], lasts[group]) == (members[0][1], members[-1][1])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_with_and_without_heavy_keys(spark, hot, how):
    facts = spark.createDataFrame([("hot", "x"), ("1", "y"), ("2", "z")], "g string, fact string")
    expected = rows(hot.join(facts, "g", how), "id", "g", "fact")
    assert rows(skew.attach(hot, facts, ["g"], how), "id", "g", "fact") == expected
    assert rows(skew.attach(hot, facts, ["g"], how, salts=5, min_rows=10), "id", "g", "fact") == expected
    heavy = [r["__key"] for r in skew.heavy_keys(hot, ["g"], min_rows=100).collect()]
    assert heavy == ["hot"]


def test_attach_on_two_columns_and_empty_sides(spark, hot):
    pairs = hot.withColumn("h", F.col("v") % 2)
    facts = spark.createDataFrame([("hot", 1, "x")], "g string, h bigint, fact string")
    assert rows(skew.attach(pairs, facts, ["g", "h"], "left", 3, 5), "id", "fact") == rows(
        pairs.join(facts, ["g", "h"], "left"), "id", "fact"
    )
    assert skew.attach(hot.limit(0), facts.drop("h"), ["g"], "left").count() == 0
    assert rows(skew.attach(hot, facts.drop("h").limit(0), ["g"], "left", 3, 5), "id") == rows(hot, "id")


def test_null_keys_are_kept(spark):
    data = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "id int, g string")
    facts = spark.createDataFrame([("a", "x")], "g string, fact string")
    assert skew.attach(data, facts, ["g"], "left", 3, 2).count() == 20
    got = ordering.running(data, ["g"], ["id"], rank="r", max_group_rows=3)
    assert got.count() == 20


def test_running_treats_null_as_zero_in_both_forms(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 1), ("a", 3, 1), ("b", 1, None)], "g string, i int, x bigint")
    ordinary = rows(ordering.running(df, ["g"], ["i"], {"s": F.col("x")}), "g", "i", "s")
    split = rows(ordering.running(df, ["g"], ["i"], {"s": F.col("x")}, max_group_rows=1), "g", "i", "s")
    assert ordinary == split == [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 1, 0)]


def test_salted_join_keeps_rows_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        many = spark.range(30_000).select((F.col("id") % 7).alias("k"), "id")
        facts = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("fact"))
        joined = skew.attach(many, facts, ["k"], salts=5, min_rows=4_000)
        assert joined.count() == 30_000 and joined.where("fact is null").isEmpty()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
