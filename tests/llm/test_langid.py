import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from spendlens.llm import langid

SF_DIR = "/root/testdata/sf0.01"


def slow_counts(text):
    folded = [b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b > 127 else 32 for b in b" " + text.encode() + b" "]
    out = np.zeros(langid.BINS, int)
    for n in (2, 3):
        for i in range(len(folded) - n + 1):
            gram = folded[i:i + n]
            if any(a == b == 32 for a, b in zip(gram, gram[1:])):
                continue
            code = sum(b << 8 * (n - 1 - j) for j, b in enumerate(gram))
            out[(code * 2654435761 & 0xFFFFFFFF) >> 19] += 1
    return out


def test_counts():
    texts = ["", "a", "Ab  c.d", "é à", "x y z " * 5, "  ", "word"]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    found = langid.counts(np.frombuffer(b"".join(data), np.uint8), offsets)
    for text, row in zip(texts, found):
        assert (row == slow_counts(text)).all(), text


def test_long_texts_in_pieces(monkeypatch):
    data = np.frombuffer(("ab cé d  e." * 50).encode(), np.uint8)
    whole = langid.counts(data, np.array([0, len(data)]))
    monkeypatch.setattr(langid, "_PIECE", 7)
    pieces = langid.counts(data, np.array([0, len(data)]))
    assert np.abs(whole - pieces).sum() <= 4  # the padding before and after the text


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_held_out_accuracy(spark):
    found = langid.op3(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    again = langid.op3(spark, SF_DIR).agg(F.sum("score")).first()[0]
    assert again == pytest.approx(found.agg(F.sum("score")).first()[0])


def test_edge_cases(spark):
    rows = [(1, "the cat and the hat " * 5, "en"), (2, "le chat et la souris " * 5, "fr"), (3, None, "en"), (4, "", "fr"),
            (5, "12 !?", "en"), (6, "the cat " * 20_000, None), (6, "le chat", "fr"), (None, "the hat", "en"), (8, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = [tuple(r) for r in langid.predict(docs, langid.fit(docs)).collect()]
    assert [f[1] for f in found][:8] == ["en", "fr", "und", "und", "und", "en", "fr", "en"]
    assert found[8][1] in ("en", "fr")
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(unlabelled) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(docs.limit(0), langid.fit(docs)).collect() == []
