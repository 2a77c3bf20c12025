import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from spendlens.llm import covers
from spendlens.llm.kernels import sequence_hashes, word_hashes


def brute(rows, length=35):
    """(doc_id, words, removed, digest of what is left) per row, from the definition."""
    lists = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    seen = Counter(tuple(w[i:i + length]) for w in lists for i in range(len(w) - length + 1))
    found = []
    for (key, _), own in zip(rows, lists):
        gone = [False] * len(own)
        for i in range(len(own) - length + 1):
            if seen[tuple(own[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        found.append((key, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


def spark_rows(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    return sorted(((r["key"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
                   for r in covers.deduplicate(docs, **kw).collect()), key=str)


def corpus(seed, docs=60, size=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefé") for _ in range(rnd.randrange(1, 9))) for _ in range(40)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passages = [text(rnd.randrange(10, size)) for _ in range(8)]
    rows = []
    for i in range(docs):
        words = text(rnd.randrange(0, size))
        for _ in range(rnd.randrange(4)):
            passage = rnd.choice(passages)
            cut = rnd.randrange(len(passage))
            words += (passage[:cut] if rnd.random() < 0.3 else passage[cut // 3:]) + text(rnd.randrange(0, 10))
        rows.append((i, "".join(w + rnd.choice([" ", "  ", "\n", "\t", "\x0b"]) for w in words)))
        if rnd.random() < 0.2:
            rows.append((1000 + i, rows[-1][1]))
    return rows


@pytest.mark.parametrize("period", [1, 3, 7, 13, 21])
def test_cover_reaches_every_difference(period):
    cover = covers.difference_cover(period)
    assert all(any((p + s) % period in cover and (q + s) % period in cover for s in range(period))
               for p in range(period) for q in range(period))
    assert len(cover) * (len(cover) - 1) == period - 1  # no difference occurs twice


@pytest.mark.parametrize(("length", "many"), [(35, 64), (35, 1), (8, 64), (8, 1), (3, 2), (1, 64)])
def test_matches_brute_force(spark, length, many):
    rows = corpus(length + many)
    assert spark_rows(spark, rows, length=length, many=many) == brute(rows, length)


def test_one_passage_in_most_documents(spark):
    rnd = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join([*(f"x{rnd.randrange(10 ** 9)}" for _ in range(rnd.randrange(30))), passage, f"y{i}"])) for i in range(300)]
    assert spark_rows(spark, rows) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 35), (5, "b " * 36), (6, "c " * 34), (7, "x" * 50_000), (8, long),
            (9, " ".join(long.split()[777:990])), (10, "A" + " a" * 40)]
    assert spark_rows(spark, rows) == brute(rows)
    # repeated rows, ids and null ids are documents of their own
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(1, text), (1, text), (1, "other " * 3), (None, text[:150]), (None, None), (None, None), (2, text[9:])]
    assert spark_rows(spark, rows) == brute(rows)
    assert spark_rows(spark, [(1, text), (1, text)]) == brute([(1, text), (1, text)])


def test_empty_table_and_clashing_columns(spark):
    assert spark_rows(spark, []) == []
    rows = [(i, " ".join(f"t{j}" for j in range(i, i + 40))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("doc", "key", "runs", "low", "high", "bucket", "kind", "copies", "sent", "near", "gone", "doc_", "spans", "kept"):
        docs = docs.withColumn(c, F.lit("x"))
    found = sorted((r["key"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
                   for r in covers.deduplicate(docs).collect())
    assert found == brute(rows)


def test_hashes_follow_the_bytes_alone():
    words = [b"", b"a", b"b", b"ab", b"abcdefgh", b"abcdefghi", b"a" * 5000, b"a" * 4999 + b"b"]
    for pad in (b"", b"zz", b"1234567"):
        data = np.frombuffer(pad + b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words]) + len(pad)
        found = word_hashes(data, ends - [len(w) for w in words], ends)
        assert len(set(found.tolist())) == len(words)
        assert found.tolist() == word_hashes(np.frombuffer(b"".join(words), np.uint8), ends - len(pad) - [len(w) for w in words], ends - len(pad)).tolist()
    # two words that every polynomial modulo 2**64 takes for equal
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024)).encode()
    both = np.frombuffer(thue + thue.translate(bytes.maketrans(b"ab", b"ba")), np.uint8)
    assert len(set(word_hashes(both, np.array([0, 1024]), np.array([1024, 2048])).tolist())) == 2
    items = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 5, 6], np.uint64)
    for length in range(1, 6):
        own = sequence_hashes(items, length)
        assert own[0] == own[5] and len(own) == len(items) - length + 1 and len(set(own.tolist())) == min(len(items) - length + 1, 6 if length == 1 else len(own) - (6 - length))
