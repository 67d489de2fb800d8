import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsatlas import operators as op
from newsatlas.operators.joins import heavy_keys


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, some of them exact copies."""
    random.seed(1)
    data = [(1 if n % 3 == 0 else random.randrange(2, 40), random.randrange(50)) for n in range(3000)]
    return data, spark.createDataFrame(data, "k bigint, v bigint")


@pytest.mark.parametrize("rows_per_task", [10, 100, 10_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, rows, skewed, rows_per_task, how):
    data, facts = skewed
    names = spark.createDataFrame([(k, f"name{k}") for k in range(1, 30)], "k bigint, name string")
    lookup = facts.groupBy("k").agg(F.count("*").alias("n")).join(names, "k")
    joined = op.spread_join(facts, lookup, "k", "n", ["v"], how, rows_per_task)
    got = Counter(rows(joined))
    names = {k: f"name{k}" for k in range(1, 30)}
    expected = Counter((k, v, names.get(k)) for k, v in data if how == "left" or k in names)
    assert got == expected


def test_heavy_keys_give_each_key_its_number_of_tasks(rows, skewed):
    _, facts = skewed
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(op.heavy_keys(counts, "k", "n", rows_per_task=300)) == [(1, 4)]


def test_top_n_per_group_trims_before_the_shuffle(rows, skewed):
    data, facts = skewed
    top = op.top_n_per_group(facts, ["k"], [F.desc("v")], 2, "place")
    got = {}
    for k, v, place in rows(top):
        got.setdefault(k, {})[place] = v
    for k in {k for k, _ in data}:
        best = sorted((v for key, v in data if key == k), reverse=True)[:2]
        assert [got[k][p] for p in sorted(got[k])] == best
    plan = top._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_latest_per_key_counts_null_as_oldest(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, None, "d"), (1, 7, "a")],
        "k int, t int, v string",
    )
    assert sorted(rows(op.latest_per_key(df, "k", ["t"], ["t", "v"]))) == [(1, 7, "b"), (2, None, "d")]


def test_lookup_few_keeps_rows_without_a_match(spark, rows):
    few = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, tag string")
    table = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 9, "other")], "k int, t int, v string")
    got = op.lookup_few(few, table, "k", ["t"], ["v"])
    assert got.columns == ["k", "tag", "v"]
    assert sorted(rows(got)) == [(1, "x", "new"), (1, "y", "new"), (3, "z", None)]


def test_unpivot_scans_once(spark, rows):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "c")], "i int, x string, y string")
    out = op.unpivot_roles(df, {"X": {"v": "x"}, "Y": {"v": "y"}}, "role", ["i"])
    assert sorted(rows(out), key=str) == [("X", "a", 1), ("X", None, 2), ("Y", "b", 1), ("Y", "c", 2)]


def test_frames_follow_observed_points(spark, rows):
    df = spark.createDataFrame([(t, 1.0 * t) for t in (0, 5, 10, 11)], "t int, v double")
    df = df.withColumn("k", F.lit(1))
    out = df.select(
        "t",
        op.rolling_sum(F.col("v"), ["k"], "t", 5),
        op.moving_average(F.col("v"), ["k"], "t", 2),
        op.previous(F.col("v"), ["k"], "t"),
        op.following(F.col("v"), ["k"], "t"),
    )
    assert rows(out) == [
        (0, 0.0, 0.0, None, 5.0), (5, 5.0, 2.5, 0.0, 10.0),
        (10, 15.0, 7.5, 5.0, 11.0), (11, 21.0, 10.5, 10.0, None),
    ]


def test_explode_delimited_drops_null_text_and_keeps_blank_items(spark, rows):
    df = spark.createDataFrame([(1, "a;b;"), (2, None), (3, "")], "i int, s string")
    assert rows(op.explode_delimited(df, F.col("s"), "item", ["i"])) == [
        (1, "a"), (1, "b"), (1, ""), (3, "")
    ]


def test_every_heavy_key_is_divided(spark):
    facts = spark.range(6000).selectExpr("id % 1500 AS k", "id AS v")
    lookup = facts.groupBy("k").count().withColumnRenamed("count", "n").withColumn("name", F.col("k") * 2)
    joined = op.spread_join(facts, lookup, "k", "n", spread_by=["v"], rows_per_task=2)
    assert joined.count() == 6000 and joined.filter("name != 2 * k").isEmpty()
    assert heavy_keys(lookup, "k", "n", 2).count() == 1500
