"""Removal of repeated word sequences by difference-cover anchors.

A window is ``LENGTH`` consecutive words of one document. Every word covered by a window whose words also start
anywhere else, in the same document too, is removed; windows may overlap.

A difference cover of a period v is a set of residues whose differences reach every residue. So for any two places
p and q some shift below v brings both onto cover positions at once. Anchors are therefore hashed at cover
positions only (5 of 21 for windows of 35 words) and are ``length - v + 1`` words long: two equal windows always share an anchor
that stands at the same place in both. Equal anchors are then extended:

1. An anchor stands for a run of windows, those that hold it at a shift below v. Where two anchors agree in all words of their runs, every window of
   both runs is repeated. This settles the inside of copies, and equal runs of a batch of documents are settled before the shuffle.
2. An anchor that meets an equal one whose run differs lies near the border of a copy. The windows of such
   runs, and of one run of each kind that step 1 settled there, are compared one by one.

Both steps count equal keys with windows over one exchange, which spill however hot a key is; no pairs are built. An anchor with
more than ``MANY`` different runs in one batch sends two of them, which show that there are others, and takes its
windows to step 2 at once. Anchors and runs are compared by two 64-bit hashes, windows by 128 bits.

Null texts have no words. Documents shorter than a window keep everything. Rows are documents, whatever their ids: null
and repeated ids are told apart by a digest of the text, and every window of a row that occurs twice is repeated. Other columns are ignored, whatever
their names. A text is one value in a task; its words take a few tens of bytes each while it is worked on. An empty table gives no rows.
"""

from collections.abc import Iterator
from functools import cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spendlens.llm.common import release, store, table
from spendlens.llm.kernels import NOT_SPACE, mix, ranges, sequence_hashes, texts, word_hashes, words

LENGTH = 35
MANY = 64
_PERIODS = (21, 13, 7, 3, 1)  # these have covers of the least possible size, in which every difference occurs once
_SECOND = 0x5851F42D4C957F2D  # salt of the second half of a window's hash


@cache
def difference_cover(period: int) -> tuple[int, ...]:
    """The smallest set of residues, with 0, whose differences reach every residue of the period."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("a period is at least 1")


def period_for(length: int) -> int:
    """The longest period that leaves anchors of at least two fifths of a window."""
    return next(v for v in _PERIODS if v == 1 or 5 * (length - v + 1) >= 2 * length)


def _hashed(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, hashes of their words, and the number of words before each text edge."""
    for first, last, data, offsets in texts(column):
        starts, ends, edges = words(data, offsets, NOT_SPACE)
        yield first, last, word_hashes(data, starts, ends), edges


def _runs(hashes: np.ndarray, edges: np.ndarray, length: int) -> list[np.ndarray]:
    """Anchors of texts at least a window long: text, anchor, identifier of its run, first and last window."""
    period = period_for(length)
    size = length - period + 1
    counts = np.diff(edges)
    counts = np.where(counts >= length, counts - size + 1, 0)
    places, text = ranges(edges[:-1], counts), np.repeat(np.arange(len(counts)), counts)
    own = places - edges[text]
    chosen = np.zeros(period, bool)
    chosen[list(difference_cover(period))] = True
    on = chosen[own % period]
    places, text, own = places[on], text[on], own[on]
    low, high = np.maximum(own - period + 1, 0), np.minimum(own, np.diff(edges)[text] - length)
    windows = sequence_hashes(hashes, length)
    base = edges[text]
    whole = mix(windows[base + low] ^ mix(windows[base + high] + ((own - low) * period + high - low).astype(np.uint64)))
    return [text, sequence_hashes(hashes, size)[places], whole, low, high]


# place holds the first and the last window, fate the copies in the batch (up to 2), whether the row is sent by its bucket, and near
_ROW = ["doc", "bucket", "kind", "place", "fate"]
_SENT, _NEAR = 4, 8


def _spread(doc: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ low.astype(np.uint64)).view(np.int64)


def _settled(bucket: np.ndarray, kind: np.ndarray, text: np.ndarray, low: np.ndarray, high: np.ndarray, twice: np.ndarray,
             many: int) -> tuple[np.ndarray, ...]:
    """Rows of a batch to exchange, those to compare anyway, and merged runs that repeat within the batch."""
    order = np.lexsort((low, text, kind, bucket))
    b, k = bucket[order], kind[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (b[1:] != b[:-1]) | (k[1:] != k[:-1])
    heads = np.flatnonzero(fresh)
    sizes = np.diff(np.append(heads, len(order)))
    again = (sizes > 1) | np.maximum.reduceat(twice[order], heads) if len(heads) else sizes > 1
    # a bucket with many kinds sends the first two
    alone = order[heads]
    _, at, counts = np.unique(bucket[alone], return_index=True, return_counts=True)
    crowd = np.repeat(counts > many, counts)
    rank = np.arange(len(alone)) - np.repeat(at, counts)
    sent = alone[~crowd | (rank < 2)]
    copies = np.where(again, 2, 1)[~crowd | (rank < 2)]
    near = alone[crowd]
    gone = order[np.repeat(again, sizes)]
    gone = gone[np.lexsort((high[gone], low[gone], text[gone]))]
    if len(gone):
        # runs of a text come in order of both ends
        new = np.ones(len(gone), bool)
        new[1:] = (text[gone[1:]] != text[gone[:-1]]) | (low[gone[1:]] > high[gone[:-1]] + 1)
        first = np.flatnonzero(new)
        last = gone[np.append(first[1:], len(gone)) - 1]
        return sent, copies, near, text[gone[first]], low[gone[first]], high[last]
    return sent, copies, near, gone, gone, gone


def _batch(batch: pa.RecordBatch, found: list[np.ndarray], many: int) -> pa.RecordBatch:
    text, bucket, kind, low, high, twice = found
    sent, copies, near, gone, gone_low, gone_high = _settled(bucket, kind, text, low, high, twice, many)
    none = np.zeros(len(near) + len(gone), np.int64)
    row = np.concatenate([text[sent], text[near], gone])
    lows = np.concatenate([low[sent], low[near], gone_low])
    highs = np.concatenate([high[sent], high[near], gone_high])
    # what is not exchanged by its bucket is dealt out evenly
    even = _spread(row[len(sent):], lows[len(sent):])
    fate = np.concatenate([copies | _SENT, np.full(len(near), _NEAR), np.full(len(gone), 2)])
    return pa.RecordBatch.from_arrays([
        batch.column(0).take(pa.array(row)), pa.array(np.concatenate([bucket[sent].view(np.int64), even])),
        pa.array(np.concatenate([kind[sent].view(np.int64), none])), pa.array(lows << 32 | highs), pa.array(fate.astype(np.int32))], names=_ROW)


def _anchors(batches: Iterator[pa.RecordBatch], length: int, many: int) -> Iterator[pa.RecordBatch]:
    """Anchors of a batch (doc, text, copies) with their runs of windows."""
    for batch in batches:
        repeated = batch.column(2).to_numpy() > 1
        found = [[] for _ in range(6)]
        for first, _, hashes, edges in _hashed(batch.column(1)):
            text, *own = _runs(hashes, edges, length)
            for out, x in zip(found, (text + first, *own, repeated[text + first])):
                out.append(x)
        if sum(map(len, found[0])):
            yield _batch(batch, [np.concatenate(x) for x in found], many)


def _windows(batches: Iterator[pa.RecordBatch], length: int, many: int) -> Iterator[pa.RecordBatch]:
    """The windows of the runs left in (doc, text, copies, runs), one by one."""
    for batch in batches:
        repeated = batch.column(2).to_numpy() > 1
        lists = batch.column(3)
        edges = lists.offsets.to_numpy()
        runs = lists.values.flatten()
        lows, highs = (np.asarray(x.to_numpy(zero_copy_only=False), np.int64) for x in runs)
        found = [[] for _ in range(6)]
        for first, last, hashes, starts in _hashed(batch.column(1)):
            own = slice(edges[first], edges[last])
            text = np.repeat(np.arange(last - first), np.diff(edges[first:last + 1]))
            counts = highs[own] - lows[own] + 1
            places = np.unique(ranges(starts[text] + lows[own], counts))
            text = np.searchsorted(starts, places, "right") - 1
            start = places - starts[text]
            one, two = (sequence_hashes(hashes, length, salt)[places] for salt in (0, _SECOND))
            for out, x in zip(found, (text + first, one, two, start, start, repeated[text + first])):
                out.append(x)
        if sum(map(len, found[0])):
            # equal windows are one kind, so no bucket is crowded but by chance
            yield _batch(batch, [np.concatenate(x) for x in found], many)


def _counted(rows: DataFrame, label: str) -> DataFrame:
    """(doc, low, high, gone, near): runs that repeat, and runs whose bucket has others."""
    fate = F.col("fate")
    dealt = rows.repartition("bucket").select(
        "doc", "bucket", "kind", F.shiftright("place", 32).cast("int").alias("low"), F.col("place").bitwiseAND((1 << 32) - 1).cast("int").alias("high"),
        fate.bitwiseAND(3).alias("copies"), (fate.bitwiseAND(_SENT) > 0).alias("sent"), (fate.bitwiseAND(_NEAR) > 0).alias("near"))
    kinds = Window.partitionBy("bucket", "sent", "kind")
    buckets = Window.partitionBy("bucket", "sent")
    counted = (
        dealt.withColumn("n", F.sum("copies").over(kinds))
        .withColumn("rank", F.row_number().over(kinds.orderBy("doc", "low")))
        .withColumn("others", F.min("kind").over(buckets) < F.max("kind").over(buckets)))
    gone = F.when(F.col("sent"), F.col("n") > 1).otherwise(F.col("copies") > 1)
    # of a kind that repeats, one run stands for all
    near = F.when(F.col("sent"), F.col("others") & (F.col("rank") == 1)).otherwise(F.col("near"))
    found = counted.select("doc", "low", "high", gone.alias("gone"), near.alias("near")).where("gone OR near")
    found = store(found, label)
    release(rows.sparkSession)
    return found


def _documents(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All rows as (doc, text), and distinct ones as (doc, text, copies)."""
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if not rows.groupBy("doc").count().where("count > 1 OR doc IS NULL").limit(1).count():
        return rows, rows.withColumn("copies", F.lit(1).cast("long"))
    rows = rows.select(F.struct(F.col("doc").alias("key"), F.sha2("text", 256).alias("digest")).alias("doc"), "text")
    return rows, rows.groupBy("doc").agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, many: int = MANY) -> tuple[DataFrame, DataFrame]:
    """The documents as (doc, text), and runs (doc, low, high) of repeated windows by the words they start at."""
    rows, own = _documents(docs, key, text)
    kind = own.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, bucket long, kind long, place long, fate int"
    inside = _counted(own.mapInArrow(partial(_anchors, length=length, many=many), schema), "cover-runs")
    near = inside.where("near").groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    asked = own.join(near.withColumnRenamed("doc", "doc_"), F.col("doc") == F.col("doc_")).select("doc", "text", "copies", "runs")
    border = _counted(asked.mapInArrow(partial(_windows, length=length, many=many), schema), "cover-windows")
    return rows, inside.where("gone").select("doc", "low", "high").unionByName(border.where("gone").select("doc", "low", "high"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, many: int = MANY) -> DataFrame:
    """(key, n_words, spans, kept): removed word spans, ends exclusive, and the words left joined by a space, per row."""
    rows, gone = repeats(docs, key, text, length, many)
    spans = gone.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("runs")).withColumnRenamed("doc", "doc_")
    joined = rows.join(spans, F.col("doc") == F.col("doc_"), "left")
    unclear = rows.schema["doc"].dataType.typeName() == "struct" and "digest" in rows.schema["doc"].dataType.names
    joined = joined.select(F.col("doc.key" if unclear else "doc").alias("key"), "text", "runs")
    kind = joined.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, kept = [], [], []
            for text, own in zip(batch.column(1).cast(pa.large_binary()), batch.column(2).to_pylist()):
                tokens = text.as_py().split()  # splits at the contract's six white-space bytes
                spans, at, left = [], 0, []
                for low, high in sorted((r["low"], r["high"] + length) for r in own or []):
                    if spans and low <= spans[-1]["end"]:
                        spans[-1]["end"] = max(high, spans[-1]["end"])
                    else:
                        spans.append({"start": low, "end": high})
                for span in spans:
                    left += tokens[at:span["start"]]
                    at = span["end"]
                sizes.append(len(tokens))
                found.append(spans)
                kept.append(b" ".join(left + tokens[at:] if spans else tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["key", "n_words", "spans", "kept"])

    return joined.mapInArrow(run, f"key {kind}, n_words long, spans array<struct<start:bigint,end:bigint>>, kept binary")


def op12(spark, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(F.col("key").alias("doc_id"), "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH rows AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT r, unnest(range(1, len(words) - 33)) AS start, words FROM rows WHERE len(words) >= 35
), keyed AS (
    SELECT r, start, sha256(array_to_string(words[start:start + 34], ' ')) AS k FROM windows
), repeated AS (
    SELECT r, start FROM (SELECT r, start, count(*) OVER (PARTITION BY k) AS n FROM keyed) WHERE n > 1
), gone AS (
    SELECT DISTINCT r, unnest(range(start, start + 35)) AS place FROM repeated
), lists AS (
    SELECT r, list(place) AS places FROM gone GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
    sha256(array_to_string(CASE WHEN places IS NULL THEN words
        ELSE list_transform(list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(places, p)), lambda p: words[p]) END, ' ')) AS kept_sha256
FROM rows LEFT JOIN lists USING (r)
"""
