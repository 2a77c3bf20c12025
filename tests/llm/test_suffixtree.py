import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from spendlens.llm import suffixtree

SF_DIR = "/root/testdata/sf0.01"


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return ["<", *re.findall(r"[^\x20\x09-\x0D]+", low), ">"]


def brute(rows, learned, depth):
    """Base score and score of each text by the rules of the module, from nested counts."""
    train = [split(t) for t, y in zip(rows, learned) if y]
    c = Counter(w for t in train for w in t[1:])
    total, distinct = sum(c.values()), len(c)
    counts = [defaultdict(Counter) for _ in range(depth + 1)]
    for t in train:
        for i in range(1, len(t)):
            for d in range(1, min(depth, i) + 1):
                counts[d][tuple(t[i - d:i])][t[i]] += 1
    kept = [{} for _ in range(depth + 1)]

    def p(context, w, d):
        value = (c[w] + 1) / (total + distinct + 1)
        for e in range(1, min(d, len(context)) + 1):
            s = tuple(context[-e:])
            if s in kept[e]:
                n, k = kept[e][s]
                value = (counts[e][s][w] + k * value) / (n + k)
        return value

    for d in range(1, depth + 1):
        tested = {s: f for s, f in counts[d].items() if d == 1 or sum(counts[d - 1][s[1:]].values()) >= suffixtree.EXTEND}
        twice = [len(f) for f in tested.values() if sum(f.values()) == 2]
        for s, follow in tested.items():
            n, types, gain = sum(follow.values()), len(follow), 0
            if n == 1:
                kept[d][s] = (1, (twice.count(2) + 1) / (twice.count(1) + 1))
                continue
            for w, m in follow.items():
                q = 2 ** -(round(-math.log2(p(s, w, d - 1)) * 8) / 8)
                k = types - (m == 1)
                gain += m * math.log2((m - 1 + k * q) / (n - 1 + k) / q)
            if gain > suffixtree.LEAST:
                kept[d][s] = (n, types)
    out = []
    for text in rows:
        t = split(text)
        base = sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in t[1:])
        out.append((len(t) - 1, sum(c[w] > 0 for w in t[1:]), total, base, sum(math.log10(p(t[:i], t[i], depth)) for i in range(1, len(t)))))
    return out


def spark_rows(spark, rows, learned, **kw):
    docs = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(rows, learned))], "doc_id long, text string, y boolean")
    found = suffixtree.scores(docs.repartition(3), F.col("y"), **kw).collect()
    return [tuple(r)[1:] for r in sorted(found)]


def sample(seed):
    rnd = random.Random(seed)
    common, rare = ["the", "of", "and", "a"], [f"w{i}" for i in range(150)]
    rows = []
    for _ in range(40):
        words = [rnd.choice(common) if rnd.random() < 0.6 else rnd.choice(rare) for _ in range(rnd.randrange(0, 60))]
        rows.append(" ".join(words))
        if rnd.random() < 0.4:
            rows.append("\n".join(w for w in words if rnd.random() < 0.95).title())
    return rows, [rnd.random() < 0.8 for _ in rows]


@pytest.mark.parametrize(("depth", "block", "frequent"), [(1, 8 << 20, 100_000), (2, 600, 100_000), (3, 2000, 60), (2, 8 << 20, 30)])
def test_matches_brute_force(spark, depth, block, frequent):
    rows, learned = sample(depth)
    found = spark_rows(spark, rows, learned, depth=depth, block=block, frequent=frequent)
    expected = brute(rows, learned, depth)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    for f, e in zip(found, expected):
        assert f[3:] == pytest.approx(e[3:], rel=1e-9)


def test_edge_cases(spark):
    rows = [None, "", " \t", "A", "a", "a a a a", "x " * 20_000, "é É"]
    learned = [True, True, True, True, False, True, True, False]
    found, expected = spark_rows(spark, rows, learned), brute(rows, learned, 2)
    for f, e in zip(found, expected):
        assert f == pytest.approx(e, rel=1e-9)
    assert [f[3:] for f in spark_rows(spark, rows, [False] * 8)] == [(0.0, 0.0)] * 8
    assert [f[3:] for f in spark_rows(spark, rows, [None] * 8)] == [(0.0, 0.0)] * 8
    assert spark_rows(spark, [], []) == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_held_out_texts_score_above_the_base(spark):
    rows = [r for r in suffixtree.op2(spark, SF_DIR).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.02 * sum(r["n_tokens"] for r in rows)
