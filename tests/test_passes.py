import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from spendlens.operators import lookups, ordering, temporal
from spendlens.plans import quality
from spendlens.sources import writers


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_as_of_merge_equals_the_join(spark):
    rnd = random.Random(7)
    versions, key = [], 0
    for k in ("a", "b", "c", "hot", None):
        at = 0
        for _ in range(60 if k == "hot" else 4):
            length = rnd.randrange(0, 6)
            key += 1
            versions.append((k, key, day(at), day(at + length)))
            at += length + rnd.randrange(0, 3)
    probes = [(rnd.choice(["a", "b", "hot", "hot", "hot", "nobody", None]), day(rnd.randrange(-5, 250))) for _ in range(600)] + [("a", None)]
    v = spark.createDataFrame(versions, "k string, v long, valid_from date, valid_to date")
    p = spark.createDataFrame(probes, "key string, day date").repartition(7)
    merged = temporal.as_of(p, v, "key", "day", "k", "v").collect()
    joined = temporal.point_in_time(p, v, "key", "day", "k", "v").collect()
    assert sorted(merged) == sorted(joined) and len(merged) > 50


def test_last_known_over_ranges(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.choice([None, None, None, None, i])) for g in ("a", "b", None) for i in range(80 if g == "a" else 5)]
    frame = ordering.ordered(spark.createDataFrame(rows, "g string, i int, x int").repartition(6), "g", "i")
    found = {(r.g, r.i): r.y for r in ordering.last_known(frame, ["g"], F.col("x"), "y").collect()}
    for g in ("a", "b", None):
        last = None
        for _, i, x in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            last = x if x is not None else last
            assert found[g, i] == last
    assert len(found) == len(rows)


@pytest.mark.parametrize("bits", [1, 64, 1 << 15, 1 << 20])
def test_filter_rejects_no_known_key(spark, bits):
    parents = spark.range(0, 400, 3).select(F.concat(F.lit("k"), F.col("id")).alias("p"))
    child = spark.range(0, 400).select(F.concat(F.lit(" k"), F.col("id"), F.lit(" ")).alias("c")).unionByName(
        spark.createDataFrame([(None,), ("",), ("None",), ("k1",)], "c string"))
    plain = sorted(map(tuple, lookups.orphan_keys(child, "c", parents, "p").collect()))
    assert sorted(map(tuple, lookups.orphan_keys(child, "c", parents, "p", bits).collect())) == plain
    assert lookups.key_filter(parents, "p", bits).agg(F.sum(F.length("_bits"))).first()[0] <= max(4096, bits // 8)
    empty = parents.limit(0)
    assert lookups.orphan_keys(child, "c", empty, "p", bits).count() == lookups.orphan_keys(child, "c", empty, "p").count()


def test_key_rules_share_one_pass(spark):
    people = spark.createDataFrame([("1", "x"), ("2", "x"), (None, "y"), ("2", None)], "id string, team string")
    jobs = spark.createDataFrame([(1, "1", "1"), (2, " 2 ", "7"), (3, "9", None), (3, None, "")], "job int, owner string, backup string")
    rules = {
        "people": {"pk_columns": ["id"], "dominant_values": {"team": 40.0}},
        "jobs": {"pk_columns": ["job"], "foreign_keys": {"owner": ("people", "id"), "backup": ("people", "id")}},
    }
    together = quality.run_all({"people": people, "jobs": jobs}, rules)
    found = {(r.dataset, r.check): (r.passed, r.failed_rows) for r in together.collect()}
    assert found == {("people", "primary_key:id"): (False, 2), ("people", "dominant_value:team"): (False, 2),
                     ("jobs", "primary_key:job"): (False, 1), ("jobs", "foreign_key:owner"): (False, 1), ("jobs", "foreign_key:backup"): (False, 1)}
    alone = [r for name, df in (("people", people), ("jobs", jobs)) for r in quality.run_suite(name, df, rules[name], {"people": people, "jobs": jobs}).collect()]
    assert sorted(map(str, alone)) == sorted(map(str, together.collect()))
    none = quality.run_all({"people": people.limit(0), "jobs": jobs.limit(0)}, rules).collect()
    assert all(r.passed and r.failed_rows == 0 for r in none) and len(none) == 5
    # the checks read the one stored row, not the tables again
    plan = together._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [rule#" not in plan


def test_digest_finds_what_is_missing_or_changed(spark, tmp_path):
    rows = spark.range(50).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("t"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    digest = writers.write_verified(rows.repartition(5), f"{tmp_path}/t")
    assert digest["rows"] == 50
    writers.check_digest(rows.repartition(2), digest, "same rows")
    for other in (rows.where("id <> 7"), rows.unionByName(rows.where("id = 7")), rows.withColumn("t", F.coalesce("t", F.lit("")))):
        with pytest.raises(ValueError):
            writers.check_digest(other, digest, "t")
    assert writers.write_verified(rows.limit(0), f"{tmp_path}/e")["rows"] == 0
