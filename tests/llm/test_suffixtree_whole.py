import math

import pytest
from spendlens.llm import suffixtree
from tests.llm.test_suffixtree import brute, sample, spark_rows


@pytest.mark.parametrize("frequent", [3, 30])
def test_dealing_out_frequent_contexts_changes_no_score(spark, frequent):
    rows, learned = sample(2)
    rows, learned = rows + ["mr smith", "mr jones", "mr smith"] * 20, learned + [True] * 60
    found, expected = spark_rows(spark, rows, learned, frequent=frequent), spark_rows(spark, rows, learned)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    for f, e in zip(found, expected):
        assert f[3:] == pytest.approx(e[3:], rel=1e-9)


def test_unknown_words_are_smoothed_by_the_context_before_them(spark):
    rows = ["the a", "the b", "the a", "the b", "the c", "c the"] * 10 + ["the zebra", "the yak", "the"]
    found = spark_rows(spark, rows, [True] * 60 + [False] * 3, depth=1)
    total, distinct = 180, 5
    # the begin mark: 60 sightings, followed by "the" and "c"; "the": 60 sightings, followed by a, b, c and the end mark
    first = (50 + 2 * 61 / (total + distinct + 1)) / (60 + 2)
    unknown = 4 * 1 / (total + distinct + 1) / (60 + 4)
    last = 61 / (total + distinct + 1)  # nothing is known of what follows an unknown word
    for row in found[60:62]:
        assert row[4] == pytest.approx(math.log10(first) + math.log10(unknown) + math.log10(last), rel=1e-9)


@pytest.mark.parametrize(("depth", "block", "frequent"), [(2, 600, 100_000), (2, 8 << 20, 30)])
def test_matches_the_rules_without_shortcuts(spark, depth, block, frequent):
    rows, learned = sample(depth)
    rows, learned = rows + ["the of unseen a", "unseen unheard", None, "é É"], learned + [False] * 4
    found = spark_rows(spark, rows, learned, depth=depth, block=block, frequent=frequent)
    expected = brute(rows, learned, depth)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    for f, e in zip(found, expected):
        assert f[3:] == pytest.approx(e[3:], rel=1e-9)
