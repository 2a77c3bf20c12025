import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from spendlens.operators import dedup, lookups, ordering, stats


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one key, a third have no key."""
    rng = random.Random(3)
    keys = ["hot"] * 100 + [None] * 100 + [f"k{rng.randrange(30)}" for _ in range(100)]
    data = [(key, rng.randrange(50), i) for i, key in enumerate(keys)]
    rng.shuffle(data)
    return data


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t int, id long").repartition(5)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))


def test_row_index_is_dense_along_the_order(frame, rows):
    ordered = ordering.ordered(frame, "k", "t", "id")
    assert ordered.select(ordering.PART).distinct().count() > 1
    got = ordering.row_index(ordered, "n").orderBy("n").select("id", "n").collect()
    assert [(r.id, r.n) for r in got] == [(row[2], i + 1) for i, row in enumerate(in_order(rows))]


def test_number_in_groups(frame, rows):
    expected = {}
    for _, group in groupby(in_order(rows), key=lambda r: r[0]):
        expected |= {row[2]: i + 1 for i, row in enumerate(group)}
    got = ordering.number_in_groups(frame, ["k"], ["t", "id"], "n").collect()
    assert {r.id: r.n for r in got} == expected


def test_cumulate(frame, rows):
    expected = {}
    for _, group in groupby(in_order(rows), key=lambda r: r[0]):
        total = 0
        for row in group:
            total += row[1]
            expected[row[2]] = total
    got = ordering.cumulate(frame, ["k"], ["t", "id"], F.col("t"), "s").collect()
    assert {r.id: r.s for r in got} == expected


def test_neighbours_cross_range_boundaries(frame, rows):
    after, before = {}, {}
    for _, group in groupby(in_order(rows), key=lambda r: r[0]):
        ids = [row[2] for row in group]
        after |= dict(zip(ids, [*ids[1:], None]))
        before |= dict(zip(ids, [None, *ids[:-1]]))
    ordered = ordering.ordered(frame, "k", "t", "id")
    assert {r.id: r.x for r in ordering.following(ordered, ["k"], "id", "x").collect()} == after
    assert {r.id: r.x for r in ordering.preceding(ordered, ["k"], "id", "x").collect()} == before


def test_exact_median(frame, rows):
    got = {r.k: r.median for r in stats.exact_median(frame, "t", ["k"]).collect()}
    for key, group in groupby(in_order(rows), key=lambda r: r[0]):
        values = sorted(row[1] for row in group)
        middle = len(values) // 2
        assert got[key] == (values[middle] + values[(len(values) - 1) // 2]) / 2


def test_median_of_everything_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (9.0,), (4.0,)], "v double")
    assert stats.exact_median(df, "v").first().median == 3.0
    assert stats.exact_median(df.where("v > 100"), "v").count() == 0


def test_keep_first_limits_each_task_before_the_shuffle(frame):
    kept = dedup.keep_first(frame, ["k"], ["t", "id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert kept.count() == frame.select("k").distinct().count()


def test_unique_by_leaves_unique_rows_alone(spark):
    unique = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert dedup.unique_by(unique, "k") is unique
    repeated = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, v string")
    assert sorted(map(tuple, dedup.unique_by(repeated, "k").collect())) == [(1, "a"), (2, "c")]


def test_insert_if_absent(spark):
    old = spark.createDataFrame([(1, "old")], "k long, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k long, v string")
    assert sorted(map(tuple, dedup.insert_if_absent(old, new, ["k"]).collect())) == [(1, "old"), (2, "a")]


def test_left_lookup_keeps_the_row_count(spark):
    facts = spark.createDataFrame([(i, None if i % 3 == 0 else f"d{i % 4}") for i in range(60)], "id long, d string")
    dim = spark.createDataFrame([("d1", "one"), ("d1", "uno"), ("d2", "two"), (None, "none")], "d string, name string")
    got = lookups.left_lookup(facts, dim, "d", "d", {"name": "label"})
    assert got.columns == ["id", "d", "label"] and got.count() == 60
    assert {(r.d, r.label) for r in got.collect()} == {(None, None), ("d0", None), ("d1", "one"), ("d2", "two"), ("d3", None)}


@pytest.mark.parametrize("hot", ["hot", None])
def test_spread_join_divides_hot_and_missing_keys(spark, hot):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 20_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 != 0, F.concat(F.lit("k"), F.col("id"))).otherwise(F.lit(hot)).alias("k"))
        keys = spark.range(0, 20_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
        side = keys.groupBy("k").agg(F.count("*").alias("v"))
        got = lookups.spread_join(facts, side, ["k"])
        assert len(got.collect()) == 20_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_orphan_keys_ignores_missing_texts(spark):
    child = spark.createDataFrame([(v,) for v in ["1", " 1 ", "9", "9", "", "None", "nan", "NULL", None]], "p string")
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    assert [tuple(r) for r in lookups.orphan_keys(child, "p", parent, "id").collect()] == [("9", 2)]


def test_hot_key_of_two_stored_tables_is_split_by_the_adaptive_skew_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 20_000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key")
        )
        dim = spark.range(0, 20_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit("x").alias("name"))
        got = facts.join(dim, "key", "left")
        assert len(got.collect()) == 20_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
