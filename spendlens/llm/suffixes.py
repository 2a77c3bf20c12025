"""Removal of repeated strings of ``LENGTH`` bytes by bucket-pointer refinement of suffixes.

Suffixes that start alike share an initial bucket, named by the hash of their first ``Q`` bytes. Sorting every
suffix of a corpus is not needed to find strings of LENGTH bytes: each string is looked up through its anchor, the
suffix inside it whose q-gram has the smallest hash (the first of several). Equal strings have equal anchors at
equal places, so all copies of a string meet in one bucket. Neighbouring strings mostly share their anchor;
such a run is refined as a whole:

1. Buckets are refined by the identifier of everything the run covers on both sides of its anchor. In
   a refined bucket all runs are equal, so all but the first go, and only the first is looked at again.
2. Buckets that refinement has split are refined further, by the identifiers at each single offset, from the bytes
   of the runs that are left. The first of each refined bucket stays.

Copies inside a portion of a batch of documents are settled before anything is shuffled, and a bucket with many different
runs in one portion sends two of them, which show that it must be refined further; the rest skip that exchange.
Portions are bounded in bytes, so a task's memory does not grow with the length of the texts.
A bucket of more than ``LARGE`` runs left for the second step is dealt out by string instead.

"Earlier" is by doc_id (null last), then start. Rows equal in doc_id and text are one document and get one result;
different texts of one doc_id are put in the order of a hash. Null texts are empty. Identifiers are 64-bit hashes.

Long texts are worked on in pieces that overlap by LENGTH - 1 bytes. Columns beside key and text are ignored, whatever their names.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import release, store, table
from spendlens.llm.kernels import CHUNK, mix, prefix_sums, ranges, span_hashes, texts

LENGTH = 100
Q = 32
MANY = 64  # different runs of a bucket in one portion from which it skips the first exchange
LARGE = 20_000
PORTION = 1 << 23  # bytes of text from which a part of a batch is worked on by itself
_RUNS = 20_000  # runs whose bytes are taken at once

SENT, SHOWN, LEFT, GONE = range(4)  # what becomes of a run: exchanged; exchanged and left; left; removed


def runs(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Runs of strings by anchor: bucket, identifier, text, first and last start, and the anchor's place."""
    n, width = len(data), LENGTH - Q + 1
    counts = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    if not counts.any():
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 4
    sums, places = prefix_sums(data), np.arange(n - Q + 1)
    hashes = span_hashes(sums, places, places + Q)
    # the smallest hash of every window, with its place in the low bits
    least, size = hashes >> np.uint64(24) << np.uint64(24) | places.astype(np.uint64), 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n - LENGTH + 1], least[width - size:][:n - LENGTH + 1])
    starts, text = ranges(offsets[:-1], counts), np.repeat(np.arange(len(counts)), counts)
    anchor = (least[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    anchor, low, high = anchor[first], starts[first], starts[last]
    whole = mix(span_hashes(sums, low, high + LENGTH) + (anchor - low).astype(np.uint64))
    return [hashes[anchor], whole, text[first], low, high, anchor]


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, place of the first byte in it, bytes and offsets; long texts in pieces that share LENGTH - 1 bytes."""
    for first, _, data, offsets in texts(column):
        if len(offsets) > 2 or len(data) <= 2 * CHUNK:
            yield first, 0, data, offsets
            continue
        for at in range(0, len(data), CHUNK):
            part = data[at:at + CHUNK + LENGTH - 1]
            yield first, at, part, np.array([0, len(part)])


def portions(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows where a column of texts passes ``PORTION`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(), dtype=np.int64)
        first = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PORTION, "right")))
            yield batch.slice(first, last - first)
            first = last


def _batch_runs(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    """Runs of portions of a batch (doc, mark, text), with what becomes of each; see the module's text."""
    for batch in batches:
        rank = _ranks(batch)
        found, held = [], 0
        for first, at, data, offsets in _pieces(batch.column(2)):
            own = runs(data, offsets)
            base = offsets[:-1][own[2]] - at
            found.append((own[0], own[1], own[2] + first, own[3] - base, own[4] - base, own[5] - own[3]))
            held += len(data)
            if held >= PORTION:
                yield from _settled(batch, rank, found, many)
                found, held = [], 0
        if found:
            yield from _settled(batch, rank, found, many)


def _ranks(batch: pa.RecordBatch) -> np.ndarray:
    """The place of every row of (doc, mark, ...) in the order of documents."""
    keys = pa.table([batch.column(0), batch.column(1)], names=["doc", "mark"])
    rank = np.empty(len(keys), np.int64)
    rank[pc.sort_indices(keys, [("doc", "ascending"), ("mark", "ascending")], null_placement="at_end").to_numpy()] = np.arange(len(keys))
    return rank


def _settled(batch: pa.RecordBatch, rank: np.ndarray, found: list, many: int) -> Iterator[pa.RecordBatch]:
    bucket, whole, row, low, high, left = (np.concatenate(x) for x in zip(*found))
    if not len(bucket):
        return
    order = np.lexsort((low, rank[row], whole, bucket))
    b, w = bucket[order], whole[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (b[1:] != b[:-1]) | (w[1:] != w[:-1])
    fate = np.full(len(order), GONE, np.int8)
    alone, edges, sizes = order[fresh], *np.unique(b[fresh], return_index=True, return_counts=True)[1:]
    kept = np.full(len(alone), SENT, np.int8)
    for i in np.flatnonzero(sizes > many):
        kept[edges[i]:edges[i] + sizes[i]] = LEFT
        kept[edges[i]:edges[i] + 2] = SHOWN
    fate[alone] = kept
    # of what goes, neighbouring runs travel as one
    gone = np.flatnonzero(fate == GONE)
    gone = gone[np.lexsort((low[gone], row[gone]))]
    heads = np.ones(len(gone), bool)
    heads[1:] = (row[gone[1:]] != row[gone[:-1]]) | (low[gone[1:]] != high[gone[:-1]] + 1)
    first = np.flatnonzero(heads)
    high[gone[first]] = high[gone[np.append(first[1:], len(gone)) - 1]] if len(gone) else high[:0]
    own = np.concatenate([np.flatnonzero(fate != GONE), gone[first]])
    rows = pa.array(row[own])
    yield pa.RecordBatch.from_arrays(
        [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(bucket[own].view(np.int64)),
         pa.array(whole[own].view(np.int64)), pa.array(low[own]), pa.array(high[own]), pa.array(fate[own].astype(np.int32))],
        names=_RUN)


_RUN = ["doc", "mark", "bucket", "whole", "low", "high", "fate"]


def _first_refinement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs sorted by bucket, identifier and order: the fate of each; buckets with one identifier drop out.

    What the batches have settled comes last and passes.
    """
    held = None  # the only run so far of the bucket that the last batch ended in
    bucket = whole = None
    split = False
    for batch in batches:
        if not batch.num_rows:
            continue
        settled = pc.is_in(batch.column(6), pa.array([LEFT, GONE], pa.int32()))
        yield batch.filter(settled)
        batch = batch.filter(pc.invert(settled))
        if not batch.num_rows:
            continue
        b, w = (batch.column(i).to_numpy() for i in (2, 3))
        fate = batch.column(6).to_numpy()
        same_bucket = np.concatenate([[b[0] == bucket], b[1:] == b[:-1]])
        same = same_bucket & np.concatenate([[w[0] == whole], w[1:] == w[:-1]])
        # a bucket is split from its second identifier on; its first run is then wanted too
        other = same_bucket & ~same
        group = np.cumsum(~same_bucket)
        many = np.bincount(group[other], minlength=group[-1] + 1) > 0
        many[0] |= bool(split and same_bucket[0])
        out = []
        if held is not None and (many[0] and same_bucket[0]):
            out.append(held)
            held = None
        firsts = ~same & (fate == SENT)
        # a document's repeated row settles nothing: it is the same run
        gone = same.copy()
        wanted = gone | (firsts & many[group]) | (fate == SHOWN)
        fate = np.where(gone, GONE, LEFT).astype(np.int32)
        columns = [*batch.columns[:6], pa.array(fate)]
        whole_batch = pa.RecordBatch.from_arrays(columns, names=_RUN)
        out.append(whole_batch.filter(pa.array(wanted)))
        last_alone = not many[-1]
        if last_alone:
            start = int(np.flatnonzero(group == group[-1])[0])
            if firsts[start]:
                held = whole_batch.slice(start, 1)
            elif not (group[-1] == 0 and same_bucket[0]):
                held = None
        else:
            held = None
        bucket, whole, split = b[-1], w[-1], bool(many[-1])
        yield from out


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of all runs left in (doc, mark, text, runs); those of large buckets string by string."""
    for batch in batches:
        if not len(batch):
            continue
        text = batch.column(2).cast(pa.large_binary())
        base = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text)]
        data = np.frombuffer(text.buffers()[2], np.uint8)
        own = batch.column(3).flatten()
        bucket, low, high, large = (pc.struct_field(own, name).to_numpy(zero_copy_only=False) for name in ("bucket", "low", "high", "large"))
        row = np.repeat(np.arange(len(batch)), np.diff(batch.column(3).offsets.to_numpy()))
        plain, rank = np.flatnonzero(~large), _ranks(batch) if large.any() else None
        for at in range(0, len(plain), _RUNS):
            i = plain[at:at + _RUNS]
            sizes = high[i] + LENGTH - low[i]
            yield _asked(batch, row[i], bucket[i], low[i], high[i], data[ranges(base[row[i]] + low[i], sizes)], sizes, np.zeros(len(i), bool))
        # in order of buckets, so that copies mostly meet in one portion, and of places, so that a task run again has the same portions
        dealt = np.flatnonzero(large)
        dealt = dealt[np.lexsort((low[dealt], row[dealt], bucket[dealt]))]
        for at in range(0, len(dealt), _RUNS):
            i = dealt[at:at + _RUNS]
            sizes, counts = high[i] + LENGTH - low[i], high[i] - low[i] + 1
            sums = prefix_sums(data[ranges(base[row[i]] + low[i], sizes)])
            starts = ranges(np.cumsum(sizes) - sizes, counts)
            keys = mix(span_hashes(sums, starts, starts + LENGTH) ^ np.repeat(bucket[i].view(np.uint64), counts)).view(np.int64)
            place, owner = ranges(low[i], counts), np.repeat(row[i], counts)
            order = np.lexsort((place, rank[owner], keys))
            gone = np.zeros(len(keys), bool)
            gone[order[1:]] = keys[order[1:]] == keys[order[:-1]]
            yield _asked(batch, owner, keys, place, place, np.zeros(0, np.uint8), np.zeros(len(keys), np.int64), gone)


def _asked(batch: pa.RecordBatch, row, bucket, low, high, data: np.ndarray, sizes: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    at, edges = pa.array(row), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(at), batch.column(1).take(at), pa.array(bucket), pa.array(low), pa.array(high), parts, pa.array(gone)],
        names=["doc", "mark", "bucket", "low", "high", "bytes", "gone"])


def _repeats(batch: pa.Table) -> pa.RecordBatch:
    """Strings of whole buckets, in order, that an earlier run of the bucket has as well; as runs."""
    lists = batch["bytes"].combine_chunks().cast(pa.large_binary())
    edges = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset:lists.offset + len(lists) + 1]
    data = np.frombuffer(lists.buffers()[2], np.uint8) if lists.buffers()[2] is not None else np.zeros(0, np.uint8)
    data, edges = data[edges[0]:edges[-1]], edges - edges[0]
    sums, low = prefix_sums(data), batch["low"].to_numpy()
    counts = batch["high"].to_numpy() - low + 1
    places, row = ranges(np.zeros(len(counts), np.int64), counts), np.repeat(np.arange(len(counts)), counts)
    starts = np.minimum(edges[row] + places, len(data))
    ends = np.minimum(starts + np.where(np.diff(edges)[row] > 0, LENGTH, 0), len(data))
    keys = mix(span_hashes(sums, starts, ends) ^ mix(batch["bucket"].to_numpy().view(np.uint64))[row])
    order = np.argsort(keys, kind="stable")  # rows are in order, and places within rows
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    at = np.flatnonzero(again)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    last = at[np.append(first[1:], len(at)) - 1] if len(at) else at
    first = at[first]
    own = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [batch["doc"].combine_chunks().take(own), batch["mark"].combine_chunks().take(own),
         pa.array(low[row[first]] + places[first]), pa.array(low[row[first]] + places[last])], names=["doc", "mark", "low", "high"])


def _second_refinement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings of runs sorted by bucket and order; those found gone before come last and pass."""
    kept = None
    for batch in batches:
        gone = batch["gone"]
        if pc.any(gone).as_py():
            yield batch.filter(gone).select(["doc", "mark", "low", "high"])
            batch = batch.filter(pc.invert(gone))
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([kept, rows]) if kept is not None else rows
        if not len(rows):
            continue
        buckets = rows["bucket"].to_numpy()
        cut = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
        kept = rows.slice(cut)
        if cut:
            yield _repeats(rows.slice(0, cut))
    if kept is not None and len(kept):
        yield _repeats(kept)


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", many: int = MANY) -> tuple[DataFrame, DataFrame]:
    """The documents as (doc, mark, text), and runs (doc, mark, low, high) of repeated strings by first and last start."""
    rows = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # texts are hashed only where a key does not stand for one row
    unclear = rows.groupBy("doc").count().where("count > 1 OR doc IS NULL").limit(1).count()
    mark = F.xxhash64("text") if unclear else F.lit(0).cast("long")
    rows = rows.select("doc", mark.alias("mark"), "text")
    own = rows.dropDuplicates(["doc", "mark"]) if unclear else rows
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, mark long, bucket long, whole long, low long, high long, fate int"
    settled = F.col("fate").isin(LEFT, GONE)
    # what the batches have settled shares the exchange, dealt out evenly
    dealt = own.mapInArrow(partial(_batch_runs, many=many), schema).repartition(F.when(settled, F.xxhash64("doc", "low")).otherwise(F.col("bucket")))
    refined = dealt.sortWithinPartitions(settled, "bucket", "whole", F.col("doc").asc_nulls_last(), "mark", "low")
    refined = store(refined.mapInArrow(_first_refinement, schema), "refined-runs")
    release(docs.sparkSession)
    left, gone = refined.where(F.col("fate") == LEFT), refined.where(F.col("fate") == GONE).select("doc", "mark", "low", "high")
    large = left.groupBy("bucket").count().where(F.col("count") > LARGE).select("bucket", F.lit(True).alias("large"))
    large = store(large, "large-buckets")  # a stored side leaves the join to Spark's treatment of skew
    left = left.join(large, "bucket", "left").groupBy("doc", "mark").agg(F.collect_list(F.struct(
        "bucket", "low", "high", F.coalesce("large", F.lit(False)).alias("large"))).alias("runs"))
    # merged, never broadcast: the texts come in order, so that a task run again finds the same strings gone in a portion
    asked = own.join(left.withColumnsRenamed({"doc": "doc_", "mark": "mark_"}).hint("merge"),
                     F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("mark") == F.col("mark_")))
    asked = asked.select("doc", "mark", "text", "runs").mapInArrow(
        _with_bytes, f"doc {kind}, mark long, bucket long, low long, high long, bytes binary, gone boolean")
    # what a portion has settled shares the exchange, dealt out evenly
    dealt = asked.repartition(F.when(F.col("gone"), F.xxhash64("doc", "low")).otherwise(F.col("bucket"))).sortWithinPartitions(
        "gone", "bucket", F.col("doc").asc_nulls_last(), "mark", "low")
    again = dealt.mapInArrow(_second_refinement, f"doc {kind}, mark long, low long, high long")
    return rows, gone.unionByName(again)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", many: int = MANY) -> DataFrame:
    """(key, n_bytes, spans, kept): removed byte spans, ends exclusive, and the bytes that are left, per row."""
    rows, gone = repeats(docs, key, text, many)
    spans = gone.groupBy("doc", "mark").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    # merged like the runs before, so that both joins read one exchange of the texts
    spans = spans.withColumnsRenamed({"doc": "doc_", "mark": "mark_"}).hint("merge")
    joined = rows.join(spans, F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("mark") == F.col("mark_")), "left")
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sizes, found, kept = [], [], []
            for text, own in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
                sizes.append(len(text))
                spans = []
                for low, high in sorted((r["low"], r["high"] + LENGTH) for r in own or []):
                    if spans and low <= spans[-1]["end"]:
                        spans[-1]["end"] = max(high, spans[-1]["end"])
                    else:
                        spans.append({"start": low, "end": high})
                edges = [0, *[x for s in spans for x in (s["start"], s["end"])], len(text)]
                found.append(spans)
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["key", "n_bytes", "spans", "kept"])

    return joined.select("doc", "text", "runs").mapInArrow(
        run, f"key {kind}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")


def op10(spark, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT r, doc_id, start, md5(substr(h, 2 * start + 1, 200)) AS k
    FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS start FROM docs WHERE length(h) >= 200)
), later AS (
    SELECT r, start FROM (SELECT r, start, row_number() OVER (PARTITION BY k ORDER BY doc_id, start) AS n FROM windows) WHERE n > 1
), runs AS (
    SELECT r, min(start) AS a, max(start) + 100 AS b
    FROM (SELECT r, start, sum(fresh) OVER (PARTITION BY r ORDER BY start) AS run
          FROM (SELECT r, start, CASE WHEN start - lag(start) OVER (PARTITION BY r ORDER BY start) <= 100 THEN 0 ELSE 1 END AS fresh FROM later))
    GROUP BY r, run
), pieces AS (
    SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM runs
), kept AS (
    SELECT r, count(*) AS n, sum(b - a) AS gone, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
    FROM pieces JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
    sha256(unhex(CASE WHEN n IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
