"""Language-model scores from a probabilistic suffix tree over words.

The symbols are words and an end mark per text; the contexts of a symbol are the runs of up to ``DEPTH`` symbols before
it, a begin mark included. A context s has the smoothed distribution ``P(w|s) = (n(s,w) + k P(w|s')) / (n(s) + k)``, s' being
the longest retained suffix of s; at the root it is ``(c(w) + 1) / (N + V + 1)``. k is the number of different symbols
that follow s. All are proper distributions, and a text's score is the sum over its symbols under the longest retained
context of each.

A context is retained by its divergence from s': the log-likelihood ratio of its training symbols, each one left out of the
counts that predict it, must be above ``LEAST`` bits. A context seen once cannot be tested that way; all of these
of one length share one k, the odds that a context seen twice was followed by two different symbols. The suffix of a
context must have been seen at least ``EXTEND`` times.

Texts are gathered in blocks of ``BLOCK`` bytes. Each round sends the different (context, symbol) pairs of a block, packed, to the
tasks that own the contexts, which add up counts, test, and answer. The pairs of a context seen more than ``FREQUENT`` times
are dealt out in parts; their owners send sums and how often each count and probability occurs, from which one more small
aggregation makes the same test, and all blocks get its verdicts. Counts cover all training texts. Symbols and contexts
are 64-bit hashes; the owner of a symbol answers with a number that is its own, by which it is named within contexts. All symbols not seen in training are asked about as one, as they
have the same probability after a context.

Null texts are empty: they hold the end mark alone. Rows are scored one by one, so keys may be null or repeat. Without
training texts every symbol has probability 1.

A text longer than a block is a block of its own, held by one task. Equal rows are scored each. Columns beside key, text and those that
``learned`` names are ignored, whatever their names.
"""

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import in_fold, release, store, table
from spendlens.llm.kernels import LOWER, NOT_SPACE, mix, texts, word_hashes, words
from spendlens.session import fresh_path

DEPTH = 2
BLOCK = 8 << 20
LEAST = 1.0
EXTEND = 4
FREQUENT = 100_000  # sightings from which a context is dealt out in parts
PARTS = 4  # of it for so many sightings
_END, _BEGIN, _UNKNOWN = mix(np.array([11, 13, 17], np.uint64))
_STEPS = 8  # of one bit, in which probabilities are sent along
_UNTESTED, _KEPT, _ONCE, _FREQUENT = 0, 1, 2, 3


def dump(*arrays: np.ndarray) -> bytes:
    """Whole numbers by byte planes, as many as the largest needs, compressed."""
    parts = []
    for values in arrays:
        values = np.ascontiguousarray(values, np.uint64)
        planes = (int(values.max(initial=0)).bit_length() + 7) // 8
        body = zstandard.compress(values.view(np.uint8).reshape(-1, 8).T[:planes].tobytes(), 1)
        parts += [struct.pack("<IBI", len(values), planes, len(body)), body]
    return b"".join(parts)


def load(data: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(data):
        n, planes, size = struct.unpack_from("<IBI", data, at)
        out = np.zeros((n, 8), np.uint8)
        out[:, :planes] = np.frombuffer(zstandard.decompress(data[at + 9:at + 9 + size]), np.uint8).reshape(planes, n).T
        found.append(out.view(np.uint64).ravel())
        at += 9 + size
    return found


def _steps(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=np.uint64(0)).astype(np.uint64)


def _groups(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start, and their lengths."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(ordered)))


def _owner(hashes: np.ndarray, owners: int) -> np.ndarray:
    """Owners have ranges of hashes, so that sorted hashes come in order of owner."""
    return (hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)


def _dealt(owner: np.ndarray) -> Iterator[tuple[int, slice]]:
    for first, size in zip(*_groups(owner)):
        yield int(owner[first]), slice(int(first), int(first + size))


def symbols(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [first, last), hashes of their symbols, and symbols per row."""
    for first, last, data, offsets in texts(column):
        data = LOWER[data]
        starts, ends, edges = words(data, offsets, NOT_SPACE)
        hashes, counts = word_hashes(data, starts, ends), np.diff(edges)
        out = np.full(len(hashes) + len(counts), _END, np.uint64)
        out[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
        yield first, last, out, counts + 1


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the different keys, in order of key, and each place's key among them."""
    bits = max(1, int(len(keys)).bit_length())
    if int(keys.max(initial=0)) >> (63 - bits):
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return first, inverse
    # key and place in one number: one plain sort
    packed = np.sort(keys << bits | np.arange(len(keys)))
    ordered, places = packed >> bits, packed & ((1 << bits) - 1)
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), np.int64)
    inverse[places] = np.cumsum(new) - 1
    return places[new], inverse


def _ordered(keys: np.ndarray) -> np.ndarray:
    """The places of the keys in order of key, equal ones in order of place."""
    n = max(1, len(keys))
    if int(keys.max(initial=0)) >= (1 << 62) // n:
        return np.argsort(keys, kind="stable")
    return np.sort(keys * n + np.arange(len(keys))) % n


class Block:
    """Symbols of a block's texts, and what earlier rounds have answered about them."""

    def __init__(self, names: np.ndarray, codes: np.ndarray, sizes: np.ndarray, train: np.ndarray, owners: int,
                 frequent: int = FREQUENT) -> None:
        self.names, self.codes, self.sizes, self.owners, self.frequent = names, codes, sizes, owners, frequent
        self.starts = np.cumsum(sizes) - sizes
        self.learned = np.repeat(train.astype(bool), sizes)
        self.symbols = names[codes]

    def first_request(self) -> Iterator[tuple[int, bytes]]:
        """Training counts of the block's symbols, for their owners."""
        counts = np.bincount(self.codes, weights=self.learned, minlength=len(self.names))
        for owner, own in _dealt(_owner(self.names, self.owners)):
            yield owner, dump(_steps(self.names[own]), counts[own])

    def root(self, answers: list[bytes], total: int, distinct: int) -> None:
        found = [load(a) for a in answers]
        counts, self.ids = (np.concatenate([np.zeros(0, np.uint64), *[f[i] for f in found]]).astype(np.int64) for i in (0, 1))
        self.total, self.count = total, counts[self.codes]
        self.base = self.p = (self.count + 1.0) / (total + distinct + 1)
        # how often the context of the next round was seen, and that context; texts begin as often as they end
        self.seen = self._before(self.count, self.count[self.starts + self.sizes - 1])
        self.context = self._before(self.symbols, _BEGIN)
        self.open = self.seen > 0
        # contexts and symbols by numbers of this block; all symbols not seen in training are one, as is the begin mark
        self.place = self._before(self.codes, len(self.names))
        self.asked = np.where(self.count > 0, self.codes, len(self.names))
        self.hashes = np.append(self.names, _UNKNOWN)
        self.ids = np.append(self.ids, 0)

    def _before(self, values: np.ndarray, first) -> np.ndarray:
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.starts] = first
        return out

    def pairs(self) -> tuple[np.ndarray, ...]:
        """The different (context, symbol) pairs asked about, by owner, context and symbol: the places asked about, the pair of
        each, and per pair its owner and first place."""
        at = np.flatnonzero(self.open)
        first, inverse = _unique(self.place[at] * (len(self.names) + 1) + self.asked[at])
        where = at[first]
        # pairs come by context, all of one context to one owner unless it is frequent
        heads, sizes = _groups(self.place[where])
        context, seen = self.context[where[heads]], self.seen[where[heads]]
        owner = np.repeat(_owner(context, self.owners).astype(np.int64), sizes)
        parted = np.flatnonzero(np.repeat(seen > self.frequent, sizes))
        if len(parted):
            own = where[parted]
            part = mix(self.hashes[self.asked[own]]) % (1 + self.seen[own] * PARTS // self.frequent).astype(np.uint64)
            owner[parted] = _owner(mix(self.context[own] ^ mix(part)), self.owners)
        # the few different contexts are ranked by their hashes, then all pairs by owner, rank and place in one number
        rank = np.empty(len(heads), np.int64)
        rank[np.argsort(context)] = np.arange(len(heads))
        order = _ordered(owner * max(1, len(heads)) + np.repeat(rank, sizes))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return at, back[inverse], owner[order], where[order]

    def request(self) -> Iterator[tuple[int, bytes]]:
        at, pair, owner, where = self.pairs()
        n = np.bincount(pair, weights=self.learned[at], minlength=len(where))
        context, symbol, seen = self.context[where], self.ids[self.asked[where]], self.seen[where]
        bits = np.minimum(np.round(-np.log2(self.p[where]) * _STEPS), 65535)
        for to, own in _dealt(owner):
            first, sizes = _groups(context[own])
            frequent = seen[own][first] > self.frequent
            yield to, dump(_steps(context[own][first]), sizes, frequent, symbol[own], n[own], bits[own])

    def deepen(self, answers: list[bytes], once: float, verdicts: tuple[np.ndarray, ...]) -> None:
        """Take in the answers to the last request; the next one is about contexts that are one symbol longer."""
        at, pair, _, where = self.pairs()
        kind, many, types, n = [], [], [], []
        for answer in answers:
            sizes, k, m, t, count = load(answer)
            sizes = sizes.astype(np.int64)
            kind.append(np.repeat(k, sizes)), many.append(np.repeat(m, sizes)), types.append(np.repeat(t, sizes)), n.append(count)
        none = [np.zeros(0, np.uint64)]
        kind, many, types, n = (np.concatenate(none + x).astype(float) for x in (kind, many, types, n))
        parted = kind == _FREQUENT  # an owner has a part of these
        known, kept, followers = verdicts
        own = where[parted]
        place = np.searchsorted(known, self.context[own])
        kind[parted], many[parted], types[parted] = kept[place], self.seen[own], followers[place]
        kind, many, types, n = (x[pair] for x in (kind, many, types, n))
        k = np.where(kind == _ONCE, once, types)
        held = kind > _UNTESTED
        p = self.p.copy()
        p[at[held]] = ((n + k * self.p[at]) / (many + k))[held]
        self.p = p
        shorter, seen = self.seen, np.zeros(len(p), np.int64)
        seen[at] = n.astype(np.int64)
        begins = np.zeros(len(p), bool)
        begins[self.starts] = True
        # a place whose context was seen in this round has it as the pair of the place before
        pairs = np.full(len(p), 0, np.int64)
        pairs[at] = pair
        self.place = self._before(pairs, 0)
        self.context = mix(self._before(self.context, np.uint64(0)) * np.uint64(5) + self._before(self.symbols, np.uint64(0)))
        self.seen = self._before(seen, 0)
        # the suffix without its first symbol was the context of this round; few sightings need no longer context
        self.open = self.open & ~begins & (self.seen > 0) & (shorter >= EXTEND)


def _counting(owners: int):
    def run(requests: pa.Table) -> pa.Table:
        """Counts of symbols, and a number for each that no other symbol has."""
        asked = [load(x) for x in requests["payload"].to_pylist()]
        names = [np.cumsum(a, dtype=np.uint64) for a, _ in asked]
        known, inverse = np.unique(np.concatenate(names), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([n for _, n in asked]).astype(float), minlength=len(known))
        edges = np.cumsum([0, *map(len, names)])
        owner = requests["owner"][0].as_py()
        payloads = [dump(total[inverse[a:b]], inverse[a:b] * owners + owner + 1) for a, b in zip(edges[:-1], edges[1:])]
        return _answers(requests, payloads, (total.sum(), (total > 0).sum()), [])

    return run


_ANSWER = "block long, owner int, payload binary, sum0 double, sum1 double, context long"


def _answers(requests: pa.Table, payloads: list[bytes], sums: tuple, parts: list[tuple]) -> pa.Table:
    """One answer per request, a row of block -1 for sums over all owners, and one of block -2 per part of a frequent context."""
    rows = [(b, o, p, 0.0, 0.0, 0) for b, o, p in zip(requests["block"].to_pylist(), requests["owner"].to_pylist(), payloads)]
    rows += [(-1, 0, b"", *map(float, sums), 0), *parts]
    names = ("block", "owner", "payload", "sum0", "sum1", "context")
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.int64())
    return pa.table({k: pa.array(column, kind) for k, kind, column in zip(names, kinds, zip(*rows))})


def _gains(count: np.ndarray, p: np.ndarray, many, types) -> np.ndarray:
    """Bits that a context gains on each symbol that follows it, whose sightings are each predicted from the others."""
    left, kinds = many - 1, np.where(count == 1, types - 1, types)  # its own type goes too where it was the only one of it
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((count > 0) & (left > 0), count * np.log2((count - 1 + kinds * p) / (left + kinds) / p), 0)
    return np.nan_to_num(gain, neginf=-1e6)


def _parts(owner: int, context: np.ndarray, count: np.ndarray, bits: np.ndarray) -> Iterator[tuple]:
    """One row per frequent context: sightings, kinds of symbols, and how many symbols have each count and probability."""
    for first, size in zip(*_groups(context)):
        own = slice(first, first + size)
        found, times = np.unique(count[own].astype(np.uint64) << np.uint64(16) | bits[own], return_counts=True)
        n = float(count[own].sum()), float((count[own] > 0).sum())
        yield -2, owner, dump(found >> np.uint64(16), found & np.uint64(65535), times), *n, int(context[first:first + 1].view(np.int64)[0])


def _part_gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gains = []
        for payload, many, types in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)]):
            count, bits, times = (x.astype(float) for x in load(payload))
            gains.append(float((_gains(count, 2.0 ** -(bits / _STEPS), many, types) * times).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(gains, pa.float64())], names=["context", "types", "gain"])


def _verdicts(parts: DataFrame) -> tuple[np.ndarray, ...]:
    """Frequent contexts in order, whether each is kept, and its kinds of symbols; at most one for ``FREQUENT`` training symbols."""
    whole = parts.groupBy("context").agg(F.sum("sum0").alias("many"), F.sum("sum1").alias("types"))
    found = parts.select("context", "payload").join(whole, "context").mapInArrow(_part_gains, "context long, types double, gain double")
    rows = found.groupBy("context").agg(F.max("types"), F.sum("gain")).collect()
    context = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(context)
    types, gain = (np.array([r[i] for r in rows], float)[order] for i in (1, 2))
    return context[order], np.where(gain > LEAST, _KEPT, _UNTESTED), types


def _by_context(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """An order by context and symbol."""
    # contexts come in runs, so few have to be compared to rank them
    heads, sizes = _groups(context)
    known, rank = np.unique(context[heads], return_inverse=True)
    bits = int(symbol.max(initial=0)).bit_length()
    if len(known).bit_length() + bits > 63:
        return np.lexsort((symbol, context))
    return np.argsort(np.repeat(rank, sizes) << bits | symbol.astype(np.int64))


def _answer(requests: pa.Table) -> pa.Table:
    """Counts of all pairs and contexts of this owner, with the verdict on each context."""
    asked = [load(x) for x in requests["payload"].to_pylist()]
    context = np.concatenate([np.repeat(np.cumsum(a[0], dtype=np.uint64), a[1].astype(np.int64)) for a in asked])
    frequent = np.concatenate([np.repeat(a[2], a[1].astype(np.int64)) for a in asked]).astype(bool)
    symbol, n, bits = (np.concatenate([a[i] for a in asked]) for i in (3, 4, 5))
    order = _by_context(context, symbol)
    c, s = context[order], symbol[order]
    new = np.ones(len(order), bool)
    new[1:] = (c[1:] != c[:-1]) | (s[1:] != s[:-1])
    pair = np.cumsum(new) - 1
    count = np.bincount(pair, weights=n[order].astype(float))
    first = order[new]
    c, p, often = context[first], 2.0 ** -(bits[first] / _STEPS), frequent[first]
    start, _ = _groups(c)
    group = np.zeros(len(c), np.int64)
    group[start[1:]] = 1
    group = np.cumsum(group)
    many = np.bincount(group, weights=count)
    types = np.bincount(group, weights=count > 0)
    gain = np.bincount(group, weights=_gains(count, p, many[group], types[group]))
    kind = np.where(often[start], _FREQUENT, np.where(many == 1, _ONCE, np.where((many > 1) & (gain > LEAST), _KEPT, _UNTESTED)))
    twice = (many == 2) & ~often[start]
    back = np.empty(len(order), np.int64)
    back[order] = pair
    answers, at = [], 0
    for a in asked:
        sizes = a[1].astype(np.int64)
        own = back[at:at + len(a[3])]
        heads = group[own[np.cumsum(sizes) - sizes]] if len(own) else own
        answers.append(dump(sizes, kind[heads], many[heads], types[heads], count[own]))
        at += len(a[3])
    parts = _parts(requests["owner"][0].as_py(), c[often], count[often], bits[first][often])
    return _answers(requests, answers, ((twice & (types == 1)).sum(), (twice & (types == 2)).sum()), [*parts])


_STATE = "block long, names binary, codes binary, sizes array<int>, train array<int>"


def _split(docs: DataFrame, learned: F.Column, key: str, text: str, block: int) -> DataFrame:
    """One row per block with its texts as numbers of its own distinct symbols."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), learned.cast("int").alias("train"))
    kind = rows.schema["key"].dataType
    names = ["block", "names", "codes", "sizes", "train", "keys"]

    def batch_of(number: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, train = (pa.concat_arrays([p[i] for p in parts]) for i in (0, 1))
        train, sizes = train.fill_null(0), np.concatenate([p[3] for p in parts])
        hashes = np.concatenate([p[2] for p in parts])
        found, codes = np.unique(hashes, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([dump(_steps(found))], pa.binary()), pa.array([dump(codes)], pa.binary()),
             pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())), pa.array([train.to_numpy().astype(np.int32)], pa.list_(pa.int32())),
             pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for first, last, hashes, sizes in symbols(batch.column(1)):
                parts.append((batch.column(0)[first:last], batch.column(2)[first:last], hashes, sizes))
                held += len(hashes)
                if held * 6 >= block:
                    yield from batch_of(number, parts)
                    number, parts, held = number + 1, [], 0
        if parts:
            yield from batch_of(number, parts)

    return rows.mapInArrow(run, f"{_STATE}, keys array<{kind.simpleString()}>")


def _block(names: bytes, codes: bytes, sizes: list, train: list, owners: int, frequent: int) -> Block:
    names = np.cumsum(load(names)[0], dtype=np.uint64)
    return Block(names, load(codes)[0].astype(np.int64), np.array(sizes), np.array(train), owners, frequent)


def _first_requests(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _block(*[batch.column(j)[i].as_py() for j in range(1, 5)], owners, FREQUENT)
                asked = list(block.first_request())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(asked), pa.int64()), pa.array([o for o, _ in asked], pa.int32()),
                     pa.array([p for _, p in asked], pa.binary())], names=["block", "owner", "payload"])

    return run


def _restored(state: pa.Table, answers: pa.Table, owners: int, frequent: int, totals: list[tuple]) -> Block:
    """A block after the rounds so far."""
    found = _block(*[state[c][0].as_py() for c in ("names", "codes", "sizes", "train")], owners, frequent)
    answers = answers.sort_by([("round", "ascending"), ("owner", "ascending")])
    rounds, payloads = answers["round"].to_numpy(), answers["payload"].to_pylist()
    for i, sums in enumerate(totals):
        a, b = np.searchsorted(rounds, [i, i + 1])
        if i == 0:
            found.root(payloads[a:b], int(sums[0]), int(sums[1]))
        else:
            found.deepen(payloads[a:b], (sums[1] + 1) / (sums[0] + 1), sums[2])
    return found


def _asking(owners: int, frequent: int, totals: list[tuple]):
    def run(own: pa.Table, known: pa.Table) -> pa.Table:
        asked = list(_restored(own, known, owners, frequent, totals).request())
        return pa.table({"block": pa.array([own["block"][0].as_py()] * len(asked), pa.int64()),
                         "owner": pa.array([o for o, _ in asked], pa.int32()), "payload": pa.array([p for _, p in asked], pa.binary())})

    return run


def scores(docs: DataFrame, learned: F.Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH, block: int = BLOCK,
           frequent: int = FREQUENT) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) per document row, in powers of ten."""
    spark = docs.sparkSession
    owners = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    # bucketed by block, so that no round has to move the texts again
    blocks = f"lm_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    saved = _split(docs, learned, key, text, block).write.bucketBy(buckets, "block").option("compression", "zstd")
    saved.option("path", fresh_path(spark, "lm-blocks")).saveAsTable(blocks)
    try:
        return _scored(spark.table(blocks), owners, depth, frequent)
    finally:
        spark.sql(f"DROP TABLE {blocks}")


def _scored(state: DataFrame, owners: int, depth: int, frequent: int) -> DataFrame:
    spark = state.sparkSession
    answers, totals = None, []

    def add(more: DataFrame) -> None:
        nonlocal answers
        more = store(more, "lm-answers")
        sums = more.where("block = -1").agg(F.sum("sum0"), F.sum("sum1")).first()
        totals.append((sums[0] or 0.0, sums[1] or 0.0, _verdicts(more.where("block = -2"))))
        more = more.where("block >= 0").select("block", "owner", "payload", F.lit(len(totals) - 1).alias("round"))
        answers = answers.unionByName(more) if answers is not None else more
        release(spark)

    asked = state.drop("keys").mapInArrow(_first_requests(owners), "block long, owner int, payload binary")
    add(asked.groupBy("owner").applyInArrow(_counting(owners), _ANSWER))
    for _ in range(depth):
        asked = state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            _asking(owners, frequent, list(totals)), "block long, owner int, payload binary")
        add(asked.groupBy("owner").applyInArrow(_answer, _ANSWER))
    kind = state.schema["keys"].dataType.elementType.simpleString()

    def score(own: pa.Table, known: pa.Table) -> pa.Table:
        block = _restored(own, known, owners, frequent, totals)
        add_up = lambda x: np.add.reduceat(x, block.starts)
        return pa.table({
            "key": own["keys"].combine_chunks().flatten(), "n_tokens": pa.array(block.sizes.astype(np.int64)),
            "n_known": pa.array(add_up((block.count > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(block.sizes), int(totals[0][0]), np.int64)),
            "base_score": pa.array(add_up(np.log10(block.base))), "score": pa.array(add_up(np.log10(block.p)))})

    found = state.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return store(found, "lm-scores")


def op2(spark, sf_dir: str) -> DataFrame:
    held_out = in_fold("doc_id", 7, 2)
    found = scores(table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        F.col("key").alias("doc_id"), in_fold("key", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
