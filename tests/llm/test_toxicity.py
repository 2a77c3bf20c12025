import os
import random

import numpy as np
import pytest
from spendlens.llm import toxicity

SF_DIR = os.environ.get("TOXIC_SF_DIR", "/root/testdata/sf0.1")


def test_nearest_matches_brute_force():
    rnd = np.random.default_rng(3)
    def vector():
        ids = np.sort(rnd.choice(20, rnd.integers(0, 6), replace=False))
        w = rnd.random(len(ids)).round(2) + 0.01
        return ids, w / max(np.linalg.norm(w), 1e-12)

    vectors = [vector() for _ in range(500)]
    index = toxicity.Index(vectors, 20)
    dense = np.zeros((500, 20))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    for _ in range(50):
        ids, w = vector()
        query = np.zeros(20)
        query[ids] = w
        cosines = np.sort(dense @ query)[::-1][:7]
        found = index.nearest(ids, w, 7)
        assert [s for s, _ in found] == pytest.approx([c for c in cosines if c > 0], abs=1e-8)
        assert all(dense[i] @ query == pytest.approx(s, abs=1e-8) for s, i in found)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = [r for r in toxicity.op5(spark, SF_DIR).collect() if r["held_out"] and r["doc_id"] in labels]
    caught = [r["predicted"] for r in rows if labels[r["doc_id"]] == 1]
    wrong = [r["predicted"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(caught) > 0.85  # a few toxic labels stand on junk without words
    assert np.mean(wrong) < 0.02
    brier = np.mean([(r["score"] - labels[r["doc_id"]]) ** 2 for r in rows])
    assert brier < 0.03


def test_edge_cases(spark):
    rnd = random.Random(6)
    text = lambda bad: " ".join(rnd.choice("red blue green tree house water".split()) for _ in range(30)) + " badword" * bad
    docs = spark.createDataFrame(
        [(i, text(i % 3 == 0), 9) for i in range(300)] + [(900, None, 9), (901, "", 9), (901, "BADWORD", 9), (None, "a badword here", 9),
                                                          (902, "x " * 50_000 + "badword", 9)], "doc_id long, text string, key int")
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(250)] + [(5, None), (None, 1), (6, 0), (6, 0), (12345, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 305
    assert all((r["score"] >= 0.5) == (r["key"] % 3 == 0) for r in found[:300])
    assert [r["score"] >= 0.5 for r in found[300:]] == [False, False, True, True, True]
    assert found[0]["evidence"][0]["toxic"] == 1
    assert toxicity.fit(docs, labels.limit(0)) == 0.0
    assert toxicity.fit(docs, labels.where("toxic = 1")) == 1.0
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert {r["score"] for r in toxicity.score(docs, 0.25).collect()} == {0.25}
