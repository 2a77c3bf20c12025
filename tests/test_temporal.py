import datetime as dt
import random

import pytest

from spendlens.operators import temporal


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


VERSIONS = "id string, v long, valid_from date, valid_to date"


def test_point_in_time_is_closed_open(spark):
    versions = spark.createDataFrame([
        ("a", 1, day(0), day(10)), ("a", 2, day(10), day(10)), ("a", 3, day(10), dt.date(9999, 12, 31)),
    ], VERSIONS)
    facts = spark.createDataFrame(
        [(1, "a", day(0)), (2, "a", day(9)), (3, "a", day(10)), (4, "a", day(-1)), (5, "b", day(0)),
         (6, None, day(0)), (7, "a", None), (8, "a", day(9))], "n long, who string, d date")
    got = temporal.temporal_left_join(facts, versions, "who", "d", "id", "v").collect()
    assert {r.n: r.v for r in got} == {1: 1, 2: 1, 3: 3, 4: None, 5: None, 6: None, 7: None, 8: 1}


def test_overlapping_versions_never_multiply_rows(spark):
    versions = spark.createDataFrame([
        ("a", 1, day(0), day(10)), ("a", 2, day(5), day(7)), ("a", 3, day(5), day(6)),
    ], VERSIONS)
    facts = spark.createDataFrame([(n, "a", day(n)) for n in range(12)], "n long, who string, d date")
    got = temporal.temporal_left_join(facts, versions, "who", "d", "id", "v").collect()
    assert {r.n: r.v for r in got} == {**{n: 1 for n in range(10)}, 5: 2, 6: 2, 10: None, 11: None}


def test_overlaps_match_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for v in range(150):
        start = rng.randrange(40)
        rows.append((rng.choice("aaab"), v, day(start), day(start + rng.choice([0, 0, 1, 3, 15]))))
    expected = {
        (a[0], a[1], b[1]) for a in rows for b in rows
        if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and a[3] > b[2]
    }
    got = temporal.overlaps(spark.createDataFrame(rows, VERSIONS), "id", "v").collect()
    assert {(r.id, r.ver_1_key, r.ver_2_key) for r in got} == expected and len(got) == len(expected)


def test_touching_versions_do_not_overlap(spark):
    rows = [("a", 1, day(0), day(5)), ("a", 2, day(5), day(9)), ("b", 3, day(0), day(5))]
    assert temporal.overlaps(spark.createDataFrame(rows, VERSIONS), "id", "v").count() == 0
