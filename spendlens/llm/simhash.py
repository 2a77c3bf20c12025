"""Near duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints are 64-bit majority votes over the XXH64 values (seed 42) of word shingles. Two fingerprints
within ``max_bits`` differing bits agree, in one of a few segments, up to a small number of bits (the
pigeonhole rule); every fingerprint is therefore entered in a table per segment, asks for the small Hamming
ball around its own segment value, and full distances are verified within each table entry. Distinct
fingerprints alone take part, so copies cost one row each. Within an entry a breadth-first walk verifies
distances and returns a spanning forest, never all pairs; entries above ``SPLIT`` rows are cut into parts that
meet in pairs.

Null texts are empty; texts without words have fingerprint zero and link like any other. Null keys take part
but never name a component, unless it has no other key. Repeated rows stay.

A text is one value in a task, however long, with its words and the hashes of its shingles. Columns beside key and text are ignored, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import components, store
from spendlens.llm.kernels import texts

SEED = 42
BITS = 64
SPLIT = 50_000
_VOTES = 1 << 16  # shingles voted on at once


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    line, count = b" ".join(words), max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends + 1 - lengths)[:count].tolist()
    ends = ends[min(size, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends, strict=True)), np.uint64, count)


def fingerprint(text: bytes, size: int) -> int:
    """Majority bits of all shingles as a signed number; zero if there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    hashes = _hashes(words, size).astype(">u8")
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _VOTES):
        part = hashes[at:at + _VOTES]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """(key, fp): one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, offsets in texts(batch.column(1)):
                whole, edges = data.tobytes(), offsets.tolist()
                found += [fingerprint(whole[s:e], size) for s, e in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, fp long")


def plan(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(lowest bit, width, radius) of each segment: the radii add up to ``max_bits - segments + 1``."""
    radius, wider = divmod(max_bits, segments)
    radii = [radius] * (wider + 1) + [radius - 1] * (segments - wider - 1)
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    return [(sum(widths[:i]), width, r) for i, (width, r) in enumerate(zip(widths, radii)) if r >= 0]


def _masks(width: int, radius: int) -> list[int]:
    """Bit patterns of at most ``radius`` set bits: the ball around any value, as differences."""
    balls = [0]
    layer = [(0, 0)]
    for _ in range(radius):
        layer = [(mask | 1 << bit, bit + 1) for mask, low in layer for bit in range(low, width)]
        balls += [mask for mask, _ in layer]
    return balls


def _walk(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between these distinct fingerprints."""
    found, left = [], values
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(left ^ node) <= max_bits
            if near.any():
                found += [(node, other) for other in left[near]]
                queue += list(left[near])
                left = left[~near]
    return found


def _verify(max_bits: int):
    def entries(keys: np.ndarray, fps: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(edges, len(keys)))
        held = np.add.reduceat(~asked, edges) > 0
        values = fps.view(np.uint64)
        for size in range(2, 9):  # small entries, all of one size at once
            first = edges[held & (sizes == size)]
            for i in range(size if len(first) else 0):
                for j in range(i + 1, size):
                    a, b = values[first + i], values[first + j]
                    near = np.bitwise_count(a ^ b) <= max_bits
                    yield a[near], b[near]
        for first, size in zip(edges[held & (sizes > 8)], sizes[held & (sizes > 8)]):
            if links := _walk(np.unique(values[first:first + size]), max_bits):
                a, b = np.array(links, np.uint64).T
                yield a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        for batch in batches:
            new = [np.asarray(batch.column(i)) for i in (0, 1)]
            new.append(batch.column(2).to_numpy(zero_copy_only=False))
            rows = [np.concatenate(x) for x in zip(kept, new)]
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last entry may go on
            kept = [x[cut:] for x in rows]
            yield from _links(entries(*[x[:cut] for x in rows]) if cut else ())
        if len(kept[0]):
            yield from _links(entries(*kept))

    return run


def _links(found) -> Iterator[pa.RecordBatch]:
    found = list(found)
    if found:
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(fps: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``fps(fp)`` as all pairs within ``max_bits`` would.

    A difference is asked for in one direction only: by the value that lacks its lowest set bit.
    """
    asks = [(i, low, width, mask) for i, (low, width, radius) in enumerate(plan(max_bits, segments))
            for mask in _masks(width, radius)]
    ball = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(
        ask, ("segment", "low", "width", "mask"), ("int", "int", "int", "long"))]) for ask in asks])
    rows = fps.select("fp", F.explode(ball).alias("x")).select("fp", "x.*")
    value = F.expr("shiftrightunsigned(fp, low) & (shiftleft(1L, width) - 1L)")
    rows = rows.select("fp", "segment", (F.col("mask") != 0).alias("asked"), value.alias("value"), "mask")
    rows = rows.where("mask = 0 OR value & (mask & -mask) = 0")
    rows = rows.select("fp", "asked", F.expr("(value ^ mask) * 8 + segment").alias("entry"))
    # entries with more table rows than one task should walk: cut into parts, parts meet in pairs
    large = rows.where("NOT asked").groupBy("entry").count().where(F.col("count") > SPLIT)
    large = large.select("entry", F.ceil(F.col("count") / SPLIT).cast("int").alias("parts"))
    cut = rows.join(large, "entry", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.expr("pmod(xxhash64(fp), parts)").cast("int")
    cut = cut.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.withColumn("entry", F.when(F.col("parts") == 1, F.xxhash64("entry")).otherwise(
        F.xxhash64("entry", F.least("part", "other"), F.greatest("part", "other"))))
    cut = cut.select("entry", "fp", "asked").repartition("entry").sortWithinPartitions("entry")
    return cut.mapInArrow(_verify(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4,
                    max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(key, fp, component): component is the smallest key reachable over links of ``max_bits`` bits."""
    found = store(fingerprints(docs, key, text, size), "fingerprints")
    nodes = store(found.groupBy("fp").agg(F.min("key").alias("id")), "distinct-fingerprints")
    parts = components(links(nodes, max_bits, segments)).withColumnRenamed("node", "fp")
    members = nodes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = members.groupBy("component").agg(F.min("id").alias("name"))
    members = members.join(names, "component").select("fp", F.col("name").alias("component"))
    return found.join(members, "fp").select("key", "fp", "component")


def op7(spark, sf_dir: str) -> DataFrame:
    from spendlens.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))
