import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from spendlens.llm import tries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(own)] for c, own in given.items()}
    whole = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = given.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[c] for c in children[k]) or 1
        saved[k] = sum(saved[c] for c in children[k]) + (len(members[k]) - 1) * (len(k[-1][1]) if k else 0)
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(k)).encode()).hexdigest())
                  for k, m in members.items())


def spark_rows(spark, rows, **kw):
    frame = rows if not isinstance(rows, list) else spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = tries.trie(*tries.shared_starts(tries.turns(frame)), **kw)
    return sorted(tuple(r) for r in found.select(COLUMNS).collect())


def talks(seed, convs=150, texts=3, turns=7):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(600), convs):
        rows += [(c, t, rnd.choice(["user", "assistant"]), "é" * rnd.randrange(texts)) for t in range(rnd.randrange(1, turns))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard", "band"), [(512, 64), (7, 64), (512, 2), (16, 1)])
def test_matches_brute_force(spark, shard, band):
    rows = talks(shard + band)
    assert spark_rows(spark, rows, shard=shard, band=band) == brute(rows)


def test_one_long_conversation_and_many_copies(spark):
    long = [(5, t, "user", f"t{t}") for t in range(1000)] + [(6, t, "user", f"t{t}") for t in range(700)]
    copies = [(c, t, "user", "again" * (t + 1)) for c in range(1000, 1400) for t in range(4)]
    assert spark_rows(spark, long + copies, shard=50, band=16) == brute(long + copies)


def test_edge_cases(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, -3, "user", ""), (1, None, None, "both null"),
            (0, 2, "b", "tie"), (0, 2, "a", "tie"), (0, 2, "a", "tie"), (-7, 0, "user", "below"), (-107, 0, "user", "below"),
            (200, 0, "user", "no base"), (300, 1, "x:", "y"), (301, 1, "x", ":y"), (2 ** 62, 5, "user", "x" * 100_000)]
    assert spark_rows(spark, rows) == brute(rows)
    assert spark_rows(spark, rows, shard=2, band=1) == brute(rows)


def test_repeated_rows_are_turns(spark):
    rows = [(c, 0, "user", "same") for c in range(12) for _ in range(3)]
    assert spark_rows(spark, rows, shard=5) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert spark_rows(spark, []) == []
    rows = talks(9, 40)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("n", "digest", "chars", "shard", "member", "length", "size", "heads", "base", "taken", "name", "i", "_part", "_position", "_value"):
        frame = frame.withColumn(c, F.lit("x"))
    assert spark_rows(spark, frame) == brute(rows)
