import hashlib
import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from spendlens.llm import suffixes
from spendlens.session import scratch_root


def brute(rows, length=100):
    """Removed bytes from the definition, rows being distinct documents in order."""
    seen, found = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            part = data[i:i + length]
            if part in seen:
                gone[i:i + length] = [True] * length
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return found


def spark_rows(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    found = suffixes.deduplicate(docs, **kw).collect()
    return [(r["key"], (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()))
            for r in found]


def corpus(seed, docs=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefé ") for _ in range(rnd.randrange(2, 9))) for _ in range(40)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passages = [text(rnd.randrange(12, 60)) for _ in range(8)]
    rows = []
    for i in range(docs):
        parts = [text(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(4)):
            passage = rnd.choice(passages)
            cut = rnd.randrange(len(passage))
            parts += [passage[:cut] if rnd.random() < 0.3 else passage[cut // 3:], text(rnd.randrange(0, 10))]
        rows.append((i, "".join(parts)))
        if rnd.random() < 0.2:
            rows.append((1000 + i, rows[-1][1]))
    return sorted(rows) + [(2000, "ab" * 300), (2001, "x" + "ab" * 200), (2002, "a" * 99), (2003, "a" * 100), (2004, "a" * 101)]


@pytest.mark.parametrize(("many", "large"), [(64, 20_000), (1, 20_000), (64, 1), (2, 3)])
def test_matches_brute_force(spark, monkeypatch, many, large):
    monkeypatch.setattr(suffixes, "LARGE", large)
    rows = corpus(many)
    assert dict(spark_rows(spark, rows, many=many)) == brute(rows)


@pytest.mark.parametrize("size", [1, 3, 50])
def test_buckets_may_span_batches(size):
    rows = corpus(size, 40)
    found = []
    for at in range(0, len(rows), 7):
        part = rows[at:at + 7]
        batch = pa.record_batch([pa.array([k for k, _ in part]), pa.array([0] * len(part)), pa.array([t for _, t in part])], names=["doc", "mark", "text"])
        found += suffixes._batch_runs([batch], 1)
    table = pa.Table.from_batches(found)
    settled = [f in (suffixes.LEFT, suffixes.GONE) for f in table["fate"].to_pylist()]
    table = table.append_column("s", pa.array(settled)).sort_by([(n, "ascending") for n in ("s", "bucket", "whole", "doc", "mark", "low")]).drop("s")
    whole = pa.Table.from_batches(suffixes._first_refinement(table.combine_chunks().to_batches()))
    pieces = pa.Table.from_batches(suffixes._first_refinement(table.combine_chunks().to_batches(max_chunksize=size)))
    order = [(n, "ascending") for n in ("bucket", "whole", "doc", "low", "fate")]
    assert pieces.sort_by(order).equals(whole.sort_by(order))


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcdefgh") for _ in range(1500))
    rows = [(1, part), (2, part[:700] + "--" + part[650:]), (3, part * 3)]
    pieces = list(suffixes._pieces(pa.array([part])))
    assert len(pieces) > 3
    assert dict(spark_rows(spark, rows)) == brute(rows)


def test_edge_cases(spark):
    text = "".join(random.Random(2).choices("abcdef", k=250))
    rows = [(1, None), (2, ""), (3, "short"), (4, text), (4, text), (5, text), (None, text), (6, "é" * 60), (7, "é" * 60)]
    found = spark_rows(spark, rows)
    alone = brute([(4, text), (5, text), (6, "é" * 60), (7, "é" * 60), (None, text), (1, None), (2, ""), (3, "short")])
    assert sorted(found, key=str) == sorted([*alone.items(), (4, alone[4])], key=str)
    assert spark_rows(spark, []) == []


def test_texts_of_one_key(spark):
    text = "".join(random.Random(3).choices("abcdef", k=150))
    found = spark_rows(spark, [(1, text + "x"), (1, text + "y")])
    assert sorted(r[1][1] for r in found) == [0, 150]


def test_long_batches_are_settled_in_portions():
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("abcdefgh", k=20_000)) for _ in range(8)]
    batch = pa.record_batch([pa.array(range(2000)), pa.array([0] * 2000), pa.array([texts[i % 8] for i in range(2000)])], names=["doc", "mark", "text"])
    tracemalloc.start()
    found = gone = 0
    for part in suffixes._batch_runs([batch], 64):
        found, gone = found + 1, gone + part["fate"].to_pylist().count(suffixes.GONE)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 1 and gone and most < 5 * batch.nbytes


def test_runs_of_large_buckets_without_objects_per_string():
    rnd = random.Random(6)
    texts = ["".join(rnd.choices("abcdefgh", k=168)) for _ in range(3000)]
    own = [[{"bucket": -5, "low": 0, "high": 68, "large": True}] for _ in texts]
    kind = pa.list_(pa.struct([("bucket", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("large", pa.bool_())]))
    batch = pa.record_batch(
        [pa.array(range(6000)), pa.array([0] * 6000), pa.array(texts + texts), pa.array(own + own, kind)], names=["doc", "mark", "text", "runs"])
    tracemalloc.start()
    parts = list(suffixes._with_bytes([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = pa.Table.from_batches(parts)
    gone = found["gone"].to_numpy()
    assert len(found) == 6000 * 69 and gone.sum() == 3000 * 69 and found["doc"].to_numpy()[gone].min() == 3000
    assert most < 150 * len(found)


@pytest.mark.parametrize("size", [1, 7, 20_000])
def test_bytes_of_runs_in_portions(monkeypatch, size):
    monkeypatch.setattr(suffixes, "_RUNS", size)
    texts = ["é" + "".join(random.Random(i % 5).choices("abcdef", k=180)) for i in range(12)]
    own = [[{"bucket": j, "low": 3 * j, "high": 3 * j + i % 4, "large": j == 1} for j in range(3)] for i in range(12)]
    kind = pa.list_(pa.struct([("bucket", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("large", pa.bool_())]))
    batch = pa.record_batch([pa.array(range(12)), pa.array([0] * 12), pa.array(texts), pa.array(own, kind)], names=["doc", "mark", "text", "runs"])
    rows = pa.Table.from_batches(suffixes._with_bytes([batch.slice(2)])).to_pylist()
    plain = {(r["doc"], r["bucket"], r["low"], r["high"]): r["bytes"] for r in rows if r["bytes"]}
    assert plain == {(i, j, 3 * j, 3 * j + i % 4): texts[i].encode()[3 * j:3 * j + i % 4 + 100] for i in range(2, 12) for j in (0, 2)}
    strings = [(r["bucket"], texts[r["doc"]].encode()[r["low"]:r["high"] + 100]) for r in rows if not r["bytes"]]
    assert len(strings) == sum(i % 4 + 1 for i in range(2, 12)) and len(set(strings)) == len({k for k, _ in strings}) == len({x for _, x in strings})
    kept = np.array([not r["gone"] for r in rows if not r["bytes"]])
    assert kept.sum() >= len(set(strings)) and (size > 7) <= (kept.sum() == len(set(strings)))


def test_few_files_are_written_and_texts_move_once(spark):
    # each file of a local file system starts two processes of an executor, whose memory is seen twice until they run
    files = lambda: {p for p in Path(scratch_root(spark)).rglob("part-*.parquet")}
    rows, before = corpus(7, 200), files()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    found = suffixes.deduplicate(docs)
    assert {r["key"]: r["n_bytes"] - len(r["kept"]) for r in found.collect()} == {k: v[1] for k, v in brute(rows).items()}
    assert len(files() - before) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("SortMergeJoin") == 2


@pytest.mark.parametrize("size", [1, 3, 50])
def test_strings_found_gone_pass_the_second_refinement(size):
    rnd = random.Random(8)
    text = "".join(rnd.choices("abcdef", k=103)).encode()
    rows = [(i, 0, i // 3, 5, 8, text, False) for i in range(9)] + [(i, 0, i % 4, 40 + i, 40 + i, b"", True) for i in range(20)]
    names = ["doc", "mark", "bucket", "low", "high", "bytes", "gone"]
    table = pa.table([pa.array(x) for x in zip(*rows)], names=names)
    found = pa.Table.from_batches(suffixes._second_refinement(table.to_batches(max_chunksize=size))).to_pylist()
    assert sorted(tuple(r.values()) for r in found) == sorted(
        [(i, 0, 5, 8) for i in range(9) if i % 3] + [(i, 0, 40 + i, 40 + i) for i in range(20)])


def test_portions_do_not_depend_on_the_order_of_runs(monkeypatch):
    monkeypatch.setattr(suffixes, "_RUNS", 5)
    text = "".join(random.Random(4).choices("ab", k=30)) * 20
    own = [{"bucket": j % 2, "low": 15 * j, "high": 15 * j + 3, "large": True} for j in range(30)]
    kind = pa.list_(pa.struct([("bucket", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("large", pa.bool_())]))

    def rows(runs):
        batch = pa.record_batch([pa.array([1, 2]), pa.array([0, 0]), pa.array([text, text]), pa.array([runs, runs], kind)],
                                names=["doc", "mark", "text", "runs"])
        return pa.Table.from_batches(suffixes._with_bytes([batch])).to_pylist()

    assert rows(own) == rows(own[::-1])
