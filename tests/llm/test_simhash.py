import random

import xxhash
from spendlens.llm import simhash

WORDS = [f"w{i}" for i in range(300)]


def brute(rows, size=4, max_bits=4):
    """Fingerprints and components from the definition, all pairs compared."""
    def fp(text):
        words = [w for w in "".join(c if c not in "\t\n\v\f\r" else " " for c in text or "").split(" ") if w]
        words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
        if not words:
            return 0
        shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    found = [(key, fp(text)) for key, text in rows]
    fps = {f for _, f in found}
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= max_bits:
                parent[root(a)] = root(b)
    names = {}
    for key, f in found:
        if key is not None:
            names[root(f)] = min(names.get(root(f), key), key)
    return sorted(((key, f, names.get(root(f))) for key, f in found), key=str)


def spark_rows(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in simhash.near_duplicates(docs, **kw).collect()), key=str)


def sample():
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        words = [rnd.choice(WORDS) for _ in range(rnd.randrange(3, 400))]
        rows.append((i, " ".join(words)))
        for j in range(rnd.randrange(4)):
            copy = list(words)
            for _ in range(j):
                copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            rows.append((1000 + 10 * i + j, "\n ".join(copy).title()))
    return rows


def test_matches_all_pairs(spark):
    rows = sample()
    assert spark_rows(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (5, "a"), (None, "b c"), (7, "é x é"), (7, "y " * 30_000)]
    assert spark_rows(spark, rows) == brute(rows)
    assert spark_rows(spark, []) == []


def test_cut_entries_give_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 7)
    rnd = random.Random(1)
    base = [rnd.choice(WORDS) for _ in range(4000)]
    rows = [(i, " ".join(base[:i * 7 % 4000] + ["x"] + base[i * 7 % 4000:])) for i in range(120)] + sample()[:20]
    rows = list({key: (key, text) for key, text in rows}.values())
    assert spark_rows(spark, rows) == brute(rows)


def test_other_widths_match(spark):
    rows = sample()
    assert spark_rows(spark, rows, max_bits=6, segments=4) == brute(rows, max_bits=6)
    assert spark_rows(spark, rows, max_bits=2, segments=4) == brute(rows, max_bits=2)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x")], "doc_id long, text string, fp long, key string")
    assert simhash.near_duplicates(docs).collect()[0][0] == 1
