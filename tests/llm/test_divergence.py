import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from spendlens.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=30, top=50):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
             for text, lang, source in rows]
    docs, counts, groups = Counter(), defaultdict(Counter), {(lang, source) for lang, source, _ in terms}
    for lang, source, found in terms:
        docs.update((lang, t) for t in set(found))
        counts[lang, source].update(found)
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].append(t)

    def shares(lang, count):
        total = sum(count[t] for t in kept[lang])
        return {t: 1 + 10 ** 9 * (count[t] + 5) // (total + 5 * len(kept[lang])) for t in kept[lang]}

    out = []
    for lang, source in groups:
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())
        p, q = shares(lang, counts[lang, source]), shares(lang, whole)
        pairs = [(sum(abs(p[t] - o[t]) for t in p), other) for k, other in groups if k == lang and other != source
                 for o in [shares(lang, counts[lang, other])]]
        best = [(p[t] - q[t], t) for t in p if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", best)):
            found = sorted(found, key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def spark_rows(spark, rows, **kw):
    docs = rows if not isinstance(rows, list) else spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    return sorted(tuple(r) for r in divergence.audit(docs, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, docs=300, sources=9, words=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdéÀZ") for _ in range(rnd.randrange(1, 6))) for _ in range(words)]
    rows = []
    for _ in range(docs):
        s = rnd.randrange(sources)
        found = [vocabulary[min(int(rnd.expovariate(0.08)), words - 1)] for _ in range(rnd.randrange(40))] + vocabulary[s::sources][:s % 3]
        rows.append((rnd.choice([" ", ", ", "1", "_"]).join(found), rnd.choice(["en", "de", None]), f"s{s}"))
    return rows


@pytest.mark.parametrize("kw", [{}, {"segment": 8}, {"chunk": 2}, {"segment": 4, "chunk": 3, "held": 10}, {"min_docs": 1, "segment": 16},
                                {"top": 3, "segment": 8}])
def test_matches_brute_force(spark, kw):
    rows = corpus(len(kw))
    own = {k: kw[k] for k in ("min_docs", "top") if k in kw}
    assert spark_rows(spark, rows, **kw) == brute(rows, **own)


def test_equal_subtrees_are_one_node():
    leaves = np.zeros((3, 64), np.int64)
    leaves[1, 5] = leaves[2, 5] = 7
    forest = divergence.Forest(leaves)
    assert forest.roots[1] == forest.roots[2] != forest.roots[0]
    # per level, the subtree of zeros and the one that holds the seven
    assert all(len(left) <= 2 for left, _ in forest.children)
    which, one, two, times = forest.meet(np.array([0, 1]), np.array([1, 2]))
    assert sorted(zip(which.tolist(), forest.counts[one].tolist(), forest.counts[two].tolist(), times.tolist())) == [
        (0, 0, 0, 63), (0, 0, 7, 1), (1, 0, 0, 63), (1, 7, 7, 1)]


def test_walk_is_complete():
    rnd = np.random.default_rng(3)
    for width in (1, 2, 7, 33):
        leaves = rnd.integers(0, 3, (5, width))
        forest = divergence.Forest(leaves)
        which, one, two, times = forest.meet(np.array([0, 1, 4]), np.array([1, 3, 4]))
        for i, (a, b) in enumerate([(0, 1), (1, 3), (4, 4)]):
            own = which == i
            found = Counter({(int(x), int(y)): int(n) for x, y, n in zip(forest.counts[one[own]], forest.counts[two[own]], times[own])})
            assert found == Counter(zip(leaves[a].tolist(), leaves[b].tolist()))


def test_edge_cases(spark):
    rows = [(None, None, None), ("", "en", "a"), ("12 ..", "en", "b"), ("x " * 100_000, "en", "b"), ("x", "en", "c"), ("X y", "en", None)] * 2
    for min_docs in (1, 30):
        assert spark_rows(spark, rows, min_docs=min_docs) == brute(rows, min_docs)
    assert spark_rows(spark, rows[:1]) == brute(rows[:1]) == []
    assert spark_rows(spark, []) == []


def test_counts_beyond_64_bits_of_product():
    counts = np.array([0, 10 ** 12, 9 * 10 ** 15])
    assert divergence._prices(counts, 10 ** 16, 3).tolist() == [1 + 10 ** 9 * (c + 5) // (10 ** 16 + 15) for c in counts.tolist()]


def test_clashing_columns(spark):
    rows = corpus(11, 120)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    for c in ("term", "n", "docs", "total", "kept", "chunk", "segment", "cell", "first", "second", "places", "counts", "terms", "rare", "id", "value"):
        docs = docs.withColumn(c, F.lit("x"))
    assert spark_rows(spark, docs) == brute(rows)
