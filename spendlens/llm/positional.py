"""Benchmark decontamination with a positional inverted index.

The index holds, per training document, the positions and terms of its tokens (those of the benchmark's terms
alone while these are few enough to send to every task). A benchmark item is cut into windows of consecutive
words; a window is looked for from its rarest term: that term's postings, moved back by its offset, are the
candidate starts, and the postings of the other terms, from rare to frequent, are intersected with them. A
phrase match has every term at its place, a proximity match every term within ``slop`` words of it.

Terms are 64-bit hashes of whole words. Windows are worked through in blocks of ``BLOCK``, each sent to all
tasks, so a larger benchmark means more passes over the stored index, not larger messages.

Null texts have no words. Items without words, or without an id, match nothing; repeated items count once.
Document rows are treated one by one, so equal or null keys do no harm.

A long text is laid out ``_WORDS`` words at a time while it is matched. Columns beside key and text are ignored, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import store, table
from spendlens.llm.kernels import LETTER_OR_DIGIT, LOWER, ranges, texts, word_hashes, words

SIZE = 10
SLOP = 2
BLOCK = 200_000  # windows sent to the tasks at once
TERMS = 2_000_000  # benchmark terms up to which the index is limited to them
_WORDS = 1 << 19  # words laid out at once while matching
_CANDIDATES = 1 << 18  # candidate starts compared at once


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words before each text edge."""
    data = LOWER[data]
    starts, ends, edges = words(data, offsets, LETTER_OR_DIGIT)
    return word_hashes(data, starts, ends).view(np.int64), edges


def windows(benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(item, terms): the distinct windows of each item; one shorter window for an item of fewer words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for first, last, data, offsets in texts(batch.column(1)):
                hashes, edges = _terms(data, offsets)
                for row in range(first, last):
                    own = hashes[edges[row - first]:edges[row - first + 1]]
                    for i in range(max(1, len(own) - size + 1) if len(own) else 0):
                        items.append(batch.column(0)[row].as_py())
                        found.append(own[i:i + size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(found, pa.list_(pa.int64()))], names=["item", "terms"])

    rows = benchmark.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "item string, terms array<long>").distinct()


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", terms: np.ndarray | None = None) -> DataFrame:
    """(key, n_words, positions, terms): the tokens of each document, of the given sorted terms or all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in texts(batch.column(1)):
                hashes, edges = _terms(data, offsets)
                places = np.arange(len(hashes)) - np.repeat(edges[:-1], np.diff(edges))
                cuts = edges
                if terms is not None:
                    kept = np.zeros(len(hashes), bool)
                    if len(terms):
                        kept = terms[np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)] == hashes
                    cuts = np.concatenate([[0], np.cumsum(kept)])[edges]
                    hashes, places = hashes[kept], places[kept]
                cuts = pa.array(cuts.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(np.diff(edges)),
                     pa.ListArray.from_arrays(cuts, pa.array(places.astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(hashes))],
                    names=["key", "n_words", "positions", "terms"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_words long, positions array<int>, terms array<long>")


def frequencies(indexed: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(term, count) over the whole index for the wanted sorted terms; counted per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted) + 1, np.int64)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy()
            at = np.searchsorted(wanted, values)
            at[wanted[np.minimum(at, len(wanted) - 1)] != values] = len(wanted)
            total += np.bincount(at, minlength=len(total))
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(wanted[seen]), pa.array(total[seen])], names=["term", "count"])

    return indexed.select("terms").mapInArrow(run, "term long, count long").groupBy("term").agg(F.sum("count").alias("count"))


class _Plan:
    """A block of windows, ordered by their rarest term, each with its offsets from rare to frequent."""

    def __init__(self, rows: list, counts: dict[int, int]) -> None:
        self.terms = np.unique(np.concatenate([np.asarray(r["terms"], np.int64) for r in rows]))
        often = np.array([counts.get(t, 0) for t in self.terms.tolist()])
        found = []
        for row in rows:
            own = np.searchsorted(self.terms, np.asarray(row["terms"], np.int64))
            if often[own].min():  # a term that never occurs rules the window out
                found.append((row["item"], own, np.argsort(often[own], kind="stable")))
        found.sort(key=lambda x: (x[1][x[2][0]], x[0]))
        width = max((len(own) for _, own, _ in found), default=1)
        self.items = [item for item, _, _ in found]
        self.length = np.array([len(own) for _, own, _ in found], np.int64)
        self.order = np.zeros((len(found), width), np.int64)
        self.ids = np.full((len(found), width), -1, np.int32)
        for i, (_, own, order) in enumerate(found):
            self.order[i, :len(own)], self.ids[i, :len(own)] = order, own[order]
        self.first = np.searchsorted(self.ids[:, 0], np.arange(len(self.terms) + 1))

    def match(self, bounds: np.ndarray, where: np.ndarray, hashes: np.ndarray, slop: int):
        """Of texts laid out one after the other, with words [bounds[i], bounds[i + 1]): exact (start, window), near."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = self.terms[at] == hashes
        where, at = where[known], at[known].astype(np.int32)
        laid = np.full(int(bounds[-1]), -1, np.int32)
        laid[where] = at
        # candidates by portions of occurrences, as a frequent term may be the rarest of many windows
        exact, near = [], []
        total = np.cumsum(self.first[at + 1] - self.first[at])
        first = 0
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + _CANDIDATES, "right")))
            part, own = at[first:last], where[first:last]
            counts = self.first[part + 1] - self.first[part]
            window, place = ranges(self.first[part], counts), np.repeat(own, counts)
            start = place - self.order[window, 0]
            doc = np.searchsorted(bounds, place, "right") - 1
            low, high = bounds[doc], bounds[doc + 1]
            fits = (start >= low) & (start + self.length[window] <= high)
            exact.append(self._intersect(laid, start[fits], window[fits], low[fits], high[fits], 0))
            near.append(self._intersect(laid, start, window, low, high, slop) if slop else exact[-1])
            first = last
        return tuple(tuple(map(np.concatenate, zip((np.zeros(0, np.int64),) * 2, *found))) for found in (exact, near))

    def _intersect(self, laid, start, window, low, high, slop):
        for j in range(1, self.ids.shape[1]):
            if not len(start):
                break
            place, term = start + self.order[window, j], self.ids[window, j]
            ok = self.length[window] <= j
            for move in range(-slop, slop + 1):
                p = place + move
                inside = (p >= low) & (p < high)
                ok |= inside & (laid[np.where(inside, p, 0)] == term)
            start, window, low, high = start[ok], window[ok], low[ok], high[ok]
        return start, window


_FOUND = "matches array<struct<item:string,start:int,length:int>>, near array<struct<item:string,start:int>>"


def _search(indexed: DataFrame, plan: _Plan, slop: int, last_block: bool) -> DataFrame:
    """Add a block's phrase and proximity matches to those that earlier blocks have left; the last leaves out the tokens."""
    shared = indexed.sparkSession.sparkContext.broadcast(plan)
    left = indexed.drop("positions", "terms").schema if last_block else indexed.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            first = 0
            while first < len(sizes):
                part = np.cumsum(sizes[first:])
                last = first + max(1, int(np.searchsorted(part, _WORDS, "right")))
                rows = batch.slice(first, last - first)
                bounds = np.concatenate([[0], part[:last - first]])
                lengths = np.diff(rows.column(2).offsets.to_numpy())
                where = rows.column(2).flatten().to_numpy() + np.repeat(bounds[:-1], lengths)
                exact, near = plan.match(bounds, where, rows.column(3).flatten().to_numpy(), slop)
                out = [rows.column(i) for i in range(2 if last_block else 4)]
                for i, (start, window) in ((4, exact), (5, near)):
                    doc = np.searchsorted(bounds, start, "right") - 1 if i == 4 else _owner(bounds, start, window, plan)
                    order = np.lexsort((window, start, doc))
                    start, window, doc = start[order], window[order], doc[order]
                    out.append(_joined(rows.column(i), doc, start - bounds[doc], window, plan, i == 4))
                yield pa.RecordBatch.from_arrays(out, names=left.names)
                first = last

    return indexed.mapInArrow(run, left)


def _owner(bounds, start, window, plan):
    """The text of a proximity match: that of its rarest term, as its start may lie outside."""
    return np.searchsorted(bounds, start + plan.order[window, 0], "right") - 1


def _joined(before: pa.Array, doc, start, window, plan: _Plan, with_length: bool) -> pa.Array:
    counts = np.bincount(doc, minlength=len(before))
    if not len(doc):
        return before
    edges = np.concatenate([[0], np.cumsum(counts)])
    old, rows = before.to_pylist(), []
    for i in range(len(before)):
        new = [{"item": plan.items[window[j]], "start": int(start[j]),
                **({"length": int(plan.length[window[j]])} if with_length else {})} for j in range(edges[i], edges[i + 1])]
        rows.append(old[i] + new)
    return pa.array(rows, before.type)


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", size: int = SIZE, slop: int = SLOP) -> DataFrame:
    """(key, n_words, matches, near) per document row: phrase matches of whole windows, and proximity matches."""
    asked = store(windows(benchmark, item, "text", size), "windows")
    blocks = -(-asked.count() // BLOCK)
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    few = vocabulary.count() <= TERMS
    terms = np.sort(np.array([r[0] for r in vocabulary.collect()], np.int64)) if few else None
    found = store(index(docs, key, text, terms), "positional-index")
    found = found.withColumns({c.split()[0]: F.expr(f"cast(array() as {c.split(' ', 1)[1]})") for c in _FOUND.split(", ")})
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)) == block).collect() if blocks > 1 else asked.collect()
        if not rows:
            continue
        wanted = np.unique(np.concatenate([np.asarray(r["terms"], np.int64) for r in rows]))
        counts = {r["term"]: r["count"] for r in frequencies(found, wanted).collect()}
        plan = _Plan(rows, counts)
        if plan.items:
            found = _search(found, plan, slop, block == blocks - 1)
            if block < blocks - 1:
                found = store(found, "matches")
    return found.select("key", "n_words", "matches", "near")


def hits(found: DataFrame) -> DataFrame:
    """(key, n_words, n_hit, items, near_items): words inside any phrase match, and the items that match."""
    steps = F.array_sort(F.transform("matches", lambda m: F.struct(
        m["start"].alias("start"), (m["start"] + m["length"]).alias("stop"))))
    covered = F.aggregate(
        steps, F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop")),
        lambda done, m: F.struct(
            (done["n"] + F.greatest(F.lit(0), m["stop"] - F.greatest(m["start"], done["stop"]))).alias("n"),
            F.greatest(done["stop"], m["stop"]).alias("stop")),
        lambda done: done["n"].cast("long"))
    return found.select(
        "key", "n_words", covered.alias("n_hit"),
        F.array_sort(F.array_distinct("matches.item")).alias("items"),
        F.array_sort(F.array_distinct("near.item")).alias("near_items"))


def op8(spark, sf_dir: str) -> DataFrame:
    found = hits(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"))
