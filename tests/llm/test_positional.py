import hashlib
import os
import random
import re
import tracemalloc

import duckdb
import numpy as np
import pytest
from spendlens.llm import positional

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    found = {}
    for key, text in docs:
        own, marked, hit = split(text), set(), set()
        for item, passage in items:
            words = split(passage)
            for i in range(max(1, len(words) - size + 1) if words and item is not None else 0):
                window = words[i:i + size]
                for j in range(len(own) - len(window) + 1):
                    if own[j:j + len(window)] == window:
                        marked |= set(range(j, j + len(window)))
                        hit.add(str(item))
        found[key] = (len(own), len(marked), sorted(hit))
    return found


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def case():
    rnd = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(30)] + ["the"] * 20
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, text(rnd.choice([3, 9, 10, 14, 40]))) for i in range(12)]
    docs = []
    for i in range(60):
        words = text(rnd.randrange(0, 80))
        for _ in range(rnd.randrange(3)):
            own = rnd.choice(items)[1]
            cut = rnd.randrange(len(own))
            at = rnd.randrange(len(words) + 1)
            words[at:at] = own[max(0, cut - 12):cut + 1]
        docs.append((i, ", ".join(words).upper() if i % 2 else "\n".join(words)))
    return docs, [(i, " - ".join(words)) for i, words in items]


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 40}, {"TERMS": 0}, {"_WORDS": 20}])
def test_matches_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(positional, name, value)
    docs, items = case()
    rows = positional.hits(positional.contamination(*frames(spark, docs, items))).collect()
    assert {r["key"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == brute(docs, items)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "Alpha"), (4, "alpha beta"), (None, "beta ALPHA"), (6, "x " * 50_000 + "alpha")]
    items = [(7, "alpha"), (7, "alpha"), (8, None), (9, "!!"), (None, "beta"), (10, "x")]
    rows = positional.hits(positional.contamination(*frames(spark, docs, items))).collect()
    assert sorted(((r["key"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows), key=str) == sorted([
        (1, 0, 0, ()), (2, 0, 0, ()), (3, 0, 0, ()), (4, 1, 1, ("7",)), (4, 2, 1, ("7",)), (None, 2, 1, ("7",)),
        (6, 50_001, 50_001, ("10", "7"))], key=str)
    assert positional.contamination(*frames(spark, [], items)).collect() == []
    assert positional.contamination(*frames(spark, docs, [])).count() == len(docs)


def test_proximity(spark):
    item = "one two three four five six"
    docs = [(1, "x one two three four five six"), (2, "one two big three four five six"), (3, "two one three four six five"),
            (4, "one a b c d two three four five six"), (5, "six five four three two one")]
    rows = positional.contamination(*frames(spark, docs, [(1, item)])).collect()
    assert {r["key"]: (len(r["matches"]), len(r["near"])) for r in rows} == {
        1: (1, 1), 2: (0, 1), 3: (0, 1), 4: (0, 0), 5: (0, 0)}


def test_digest(spark):
    docs, items = frames(spark, [(1, "a b")], [(2, "b"), (10, "a")])
    assert positional.hits(positional.contamination(docs, items)).first()["items"] == ["10", "2"]
    assert hashlib.sha256(b"10,2").hexdigest()


def test_words_that_polynomial_hashes_confuse(spark):
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = thue.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"one {thue} two"), (2, f"one {other} two")], "doc_id long, text string")
    items = spark.createDataFrame([("i", other)], "item_id string, text string")
    found = {r["key"]: len(r["matches"]) for r in positional.contamination(docs, items).collect()}
    assert found == {1: 0, 2: 1}


# the columns of the contract; proximity matches have no SQL
SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[start:start + 9], ' ') AS k
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS start FROM items WHERE len(words) > 0)
), places AS (
    SELECT r, size, start, array_to_string(words[start:start + size - 1], ' ') AS k
    FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS start
          FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)
), hits AS (
    SELECT r, item_id, size, start FROM places JOIN windows USING (size, k)
), covered AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(start, start + size)) AS place FROM hits) GROUP BY r
), found AS (
    SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY encode(item_id)) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
    sha256(coalesce(f.ids, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables not present")
def test_whole_query_matches_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    found = con.execute(SQL)
    columns = [c[0] for c in found.description]
    assert sorted(map(tuple, positional.op8(spark, "/root/testdata/sf0.01").select(columns).collect())) == sorted(found.fetchall())


def test_a_rarest_term_of_many_windows_is_matched_in_portions():
    rows = [{"item": str(i), "terms": [1, 10 + i]} for i in range(2000)]
    plan = positional._Plan(rows, {1: 1, **{10 + i: 2 for i in range(2000)}})
    hashes = np.ones(2000, np.int64)
    hashes[1::2] = 10 + np.arange(1000)
    tracemalloc.start()
    exact, near = plan.match(np.array([0, 1000, 2000]), np.arange(2000), hashes, 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted((s, int(plan.items[w])) for s, w in zip(*map(np.ndarray.tolist, exact))) == [(2 * i, i) for i in range(1000)]
    expected = {(2 * p, i) for i in range(1000) for p in (i - 1, i, i + 1) if 0 <= p < 1000 and p // 500 == i // 500}
    assert set(zip(near[0].tolist(), (int(plan.items[w]) for w in near[1].tolist()))) == expected
    assert most < 60e6
