import os
import random

import pytest
from pyspark.sql import functions as F
from spendlens.llm import secrets

SF_DIR = "/root/testdata/sf0.01"


def known():
    import numpy as np

    return secrets.Corpus(frozenset({"the", "house", "water"}), np.ones((37, 37)))


def test_coverage():
    words = frozenset({"the", "house", "water"})
    assert secrets.coverage("TheHouse1water", words) == pytest.approx(13 / 14)
    assert secrets.coverage("9f8a7c", words) == 0


def test_features():
    found = secrets.features("a1b2c3d4e5f6a7b8", 'api token = "', '" and', known())
    assert len(found) == secrets.FEATURES
    assert found[0] == 16 and found[1] == found[2] == 0.5 and found[5] == 1
    assert found[13:17] == [1, 1, 1, 0]


def sample(n=400):
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice("the house water tree green".split()) for _ in range(30))
        secret = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
        kind = i % 4
        text += {0: f' token = "{secret}" ', 1: f" sha256 {secret} ", 2: f" see /the/house/{i}/water/tree.html ", 3: f" {10 ** 16 + i} "}[kind]
        rows.append((i, text + "end", "x"))
    return rows


def test_forest_removes_false_positives(spark):
    docs = spark.createDataFrame(sample() + [(900, None, "x"), (901, "", "x"), (None, "the z9x8c7v6b5n4m3a2s1", "x"),
                                             (902, "the " * 20_000, "x")], "doc_id long, text string, value string")
    found = secrets.candidates(docs, secrets.corpus(docs)).cache()
    judged = {r["key"]: r["probability"] for r in secrets.judge(found, secrets.train(found)).collect()}
    assert all((judged[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    assert None in judged and 902 not in judged
    spans = {r["key"]: (r["start"], r["end"], r["value"]) for r in found.collect()}
    texts = {k: t for k, t, _ in sample()}
    assert all(texts[k][a:b] == v for k, (a, b, v) in spans.items() if k is not None and k < 400)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "the z9x8c7v6b5n4m3a2s1")], "doc_id long, text string")
    found = secrets.candidates(docs, secrets.corpus(docs))
    assert secrets.train(found) == 0.0
    assert [r["probability"] for r in secrets.judge(found, 0.25).collect()] == [0.25]
    empty = docs.limit(0)
    assert secrets.candidates(empty, secrets.corpus(empty)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_query_finds_assigned_tokens(spark):
    found = secrets.op6(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = docs.select("doc_id", F.explode(F.expr("regexp_extract_all(text, 'token = \"([0-9a-f]{40})\"', 1)")).alias("v"))
    expected = {(r[0], r[1]) for r in expected.select("doc_id", F.sha2("v", 256)).collect()}
    caught = {(r["doc_id"], r["value_sha256"]) for r in found.where("secret").collect()}
    assert expected and len(expected & caught) >= 0.95 * len(expected)
    assert len(caught - expected) <= 0.05 * len(caught)
