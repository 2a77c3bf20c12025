"""Prefix trie of conversations by vertical bitmaps.

A conversation is its turns (role, text) in order; a node of the trie is a distinct sequence of first turns, and the
conversations that start with it are its members. Conversations are numbered by id and cut into shards of ``SHARD``.
A shard holds, for every (position, turn), the bitset of its conversations that have this turn there. Depth-first, the children of a node are the
intersections of its bitset with the postings of the next position: the lowest member left names the next posting,
so every posting met yields a child. Popcounts give members, and the bitset of the conversations that stop at the node its end list.

Nodes carry a 128-bit name chained from the turns above them, by which shards are merged. A node belongs to the
shard of its smallest member, where all nodes above it are present too. Sums over subtrees are taken
shard by shard over the nodes it owns, from the deepest up, and then added by name, so no step repeats per level.

Postings are read in bands of ``BAND`` positions and a shard's rows arrive sorted, so a task holds a band of one shard, however
long its conversations are. The turns of one conversation pass through one task, as every name depends on the one above. End lists are written as
ascending pieces, one per shard, and hashed piece by piece.

Null roles and texts are empty. A null turn comes first; rows of equal turn are ordered by role, then by a digest of role and
text; repeated rows are turns of their own. Rows without conv_id take no part. Other columns are ignored, whatever their
names. An empty table has no nodes. Texts travel as digests and lengths only.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spendlens.llm.common import release, store, table
from spendlens.operators.lookups import spread_join
from spendlens.operators.ordering import number_in_groups, ordered, row_index, without_order

SHARD = 512
BAND = 64
GROUP = 100  # conversations of an id range share the start of its first one
HEADS = 6
ROOT = bytes(16)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, digest, chars): every turn by its place in the conversation, from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"),
        F.length(text).cast("long").alias("chars"))
    return number_in_groups(rows, ["conv_id"], ["turn", "role", "digest"], "n").select("conv_id", "n", "digest", "chars")


def numbered(sizes: DataFrame, shard: int = SHARD) -> DataFrame:
    """(conv_id, length, shard, member) for ``sizes(conv_id, length)``, in order of conv_id."""
    rows = without_order(row_index(ordered(sizes, "conv_id"), "i"))
    return rows.select("conv_id", "length", F.floor((F.col("i") - 1) / shard).alias("shard"),
                       ((F.col("i") - 1) % shard).cast("int").alias("member"))


def shared_starts(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, length) of all, and their turns (conv_id, n, digest, chars).

    Conversation c takes the first h turns of conversation c - c % 100, h = crc32(c) % 6, in place of its own first h.
    """
    given = store(given, "trie-turns")
    sizes = given.groupBy("conv_id").agg(F.count("*").alias("size"))
    sizes = store(sizes, "trie-sizes")
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    starts = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = sizes.withColumns({"heads": heads, "base": base}).join(starts, "base", "left")
    convs = convs.withColumn("taken", F.least("heads", F.coalesce("base_size", F.lit(0))))
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("size") - F.col("heads"), F.lit(0))).alias("length"))
    # at most 5 turns of each of at most 199 conversations (around id 0) meet here
    first = given.where(F.col("n") < HEADS).withColumnRenamed("conv_id", "base")
    taken = convs.where("taken > 0").select("conv_id", "base", "taken").join(first, "base").where("n <= taken")
    moved = convs.select("conv_id", "heads", (F.col("taken") - F.col("heads")).alias("shift"))
    own = spread_join(given, moved, ["conv_id"]).where("n > heads")
    rows = taken.select("conv_id", "n", "digest", "chars").unionByName(
        own.select("conv_id", (F.col("n") + F.col("shift")).alias("n"), "digest", "chars"))
    return lengths, rows


class _Shard:
    """The walk through one shard, band by band."""

    def __init__(self, shard: int, band: int) -> None:
        self.shard, self.band = shard, band
        self.ids: dict[int, int] = {}
        self.ended: dict[int, int] = {}
        self.open: list[tuple[int, bytes, int]] = []  # (depth, name, members that go on) of nodes whose children come later
        self.started = False

    def head(self, member: int, conv_id: int, length: int) -> None:
        self.ids[member] = conv_id
        self.ended[length] = self.ended.get(length, 0) | 1 << member

    def node(self, out: list[tuple], depth: int, name: bytes, parent: bytes | None, bits: int, chars: int) -> None:
        ends = bits & self.ended.get(depth, 0)
        rest, chosen, last = bits ^ ends, [], ends
        while last:
            low = last & -last
            chosen.append(self.ids[low.bit_length() - 1])
            last ^= low
        least = self.ids[(bits & -bits).bit_length() - 1]
        out.append((self.shard, name, parent, depth, bits.bit_count(), least, chars,
                    ",".join(map(str, chosen)).encode() if chosen else None, not rest))
        if rest:
            self.open.append((depth, name, rest))

    def walk(self, out: list[tuple], last: int, postings: dict[int, dict[bytes, int]], named: dict[int, dict[int, tuple[bytes, int]]]) -> None:
        """Go on from the open nodes as far as position ``last``."""
        if not self.started:
            self.started = True
            self.node(out, 0, ROOT, None, sum(1 << m for m in self.ids), 0)
        later = []
        while self.open:
            depth, name, rest = self.open.pop()
            if depth >= last:
                later.append((depth, name, rest))
                continue
            at, whose = postings[depth + 1], named[depth + 1]
            while rest:
                digest, chars = whose[(rest & -rest).bit_length() - 1]
                child = rest & at[digest]
                rest ^= child
                self.node(out, depth + 1, hashlib.blake2b(name + digest, digest_size=16).digest(), name, child, chars)
        self.open = later


_NODES = "shard long, name binary, parent binary, depth long, n long, least long, chars long, ends binary, childless boolean"
_NODE_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
_NODE_NAMES = [c.split()[0] for c in _NODES.split(", ")]


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


def _walk(batches: Iterator[pa.RecordBatch], band: int) -> Iterator[pa.RecordBatch]:
    """Nodes of shards, from rows (shard, n, member, digest, chars) sorted by shard and n.

    At n = 0 a conversation states its id as chars and its length as member's own.
    """
    state, out = None, []
    at, postings, named = 0, {}, {}

    def finish() -> None:
        if state is not None:
            state.walk(out, at, postings, named)

    for batch in batches:
        for shard, n, member, digest, chars, length in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or shard != state.shard:
                finish()
                state, at, postings, named = _Shard(shard, band), 0, {}, {}
            if n == 0:
                state.head(member, chars, length)
                continue
            if n > at and (n - 1) // band > (at - 1) // band:
                state.walk(out, at, postings, named)
                postings, named = {}, {}
            at = n
            own = postings.setdefault(n, {})
            own[digest] = own.get(digest, 0) | 1 << member
            named.setdefault(n, {})[member] = digest, chars
        if len(out) >= 10_000:
            yield _table(out, _NODE_NAMES, _NODE_TYPES)
            out.clear()
    finish()
    yield _table(out, _NODE_NAMES, _NODE_TYPES)


_SUMS = "name binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_SUM_TYPES = [pa.binary()] + [pa.int64()] * 7
_SUM_NAMES = [c.split()[0] for c in _SUMS.split(", ")]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each shard adds to its nodes' sums, from rows sorted by shard and falling depth."""
    out: list[tuple] = []
    below: dict[bytes, list] = {}  # parent: children, leaves, saved tokens, rows that wait for the parent's id
    last = None
    for batch in batches:
        for shard, name, parent, depth, conv_id, n, chars, childless, owned in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != last:
                below, last = {}, shard
            children, leaves, saved, waiting = below.pop(name, (0, 0, 0, ()))
            out += [(*row[:3], conv_id if row[3] else None, *row[4:]) for row in waiting]
            if owned:
                leaves, saved = leaves + childless, saved + (n - 1) * chars
            row = (name, conv_id, depth, owned, n, children, leaves, saved)
            if parent is None:
                out.append((*row[:3], None, *row[4:]))
            else:
                kept = below.setdefault(parent, [0, 0, 0, []])
                kept[0] += owned
                kept[1] += leaves
                kept[2] += saved
                kept[3].append(row)
        if len(out) >= 10_000:
            yield _table(out, _SUM_NAMES, _SUM_TYPES)
            out = []
    yield _table(out, _SUM_NAMES, _SUM_TYPES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each name, joined by commas in their order."""
    name, digest, out = None, None, []
    for batch in batches:
        for own, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != name:
                if name is not None:
                    out.append((name, digest.hexdigest()))
                name, digest = own, hashlib.sha256(piece)
            else:
                digest.update(b"," + piece)
        if len(out) >= 10_000:
            yield _table(out, ["name_", "ends_sha256"], [pa.binary(), pa.string()])
            out = []
    if name is not None:
        out.append((name, digest.hexdigest()))
    yield _table(out, ["name_", "ends_sha256"], [pa.binary(), pa.string()])


def trie(lengths: DataFrame, rows: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """(name, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node.

    ``lengths(conv_id, length)`` lists all conversations, also those without turns, ``rows(conv_id, n, digest, chars)``
    their turns from n = 1.
    """
    convs = store(numbered(lengths, shard), "trie-conversations")
    placed = spread_join(rows, convs, ["conv_id"]).select("shard", "n", "member", "digest", "chars", F.lit(None).cast("long").alias("length"))
    heads = convs.select("shard", F.lit(0).cast("long").alias("n"), "member", F.lit(None).cast("binary").alias("digest"),
                         F.col("conv_id").alias("chars"), "length")
    dealt = placed.unionByName(heads).repartition("shard").sortWithinPartitions("shard", "n", "member")
    nodes = store(dealt.mapInArrow(partial(_walk, band=band), _NODES), "trie-nodes")
    release(rows.sparkSession)
    same = Window.partitionBy("name")
    merged = nodes.select(
        "shard", "name", "parent", "depth", F.min("least").over(same).alias("conv_id"), F.sum("n").over(same).alias("n_convs"),
        "chars", F.min("childless").over(same).alias("childless"), (F.col("shard") == F.min("shard").over(same)).alias("owned"))
    dealt = merged.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc())
    sums = dealt.mapInArrow(_sums, _SUMS).groupBy("name").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")],
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    pieces = nodes.where("ends IS NOT NULL").select("name", "ends", "shard").repartition("name").sortWithinPartitions("name", "shard")
    ends = pieces.select("name", "ends").mapInArrow(_digests, "name_ binary, ends_sha256 string")
    found = sums.join(ends, F.col("name") == F.col("name_"), "left").drop("name_")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))


def op11(spark, sf_dir: str) -> DataFrame:
    lengths, rows = shared_starts(turns(table(spark, sf_dir, "conversations")))
    return trie(lengths, rows).drop("name")


SQL = r"""
WITH given AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n,
        {'k': md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 'l': length(coalesce(text, ''))} AS s
    FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT conv_id, list(s ORDER BY n) AS own FROM given GROUP BY conv_id
), headed AS (
    SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
            lambda b: [CAST(ord(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295::BIGINT) % 6 AS h FROM lists
), rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.own, [])[1:h], a.own[h + 1:]) AS path
    FROM headed a LEFT JOIN lists b ON b.conv_id = a.base
), prefixes AS (
    SELECT conv_id, d, len(path) AS size, md5(array_to_string(list_transform(path[1:d], lambda s: s.k), '')) AS k,
        md5(array_to_string(list_transform(path[1:d - 1], lambda s: s.k), '')) AS parent, CASE WHEN d > 0 THEN path[d].l ELSE 0 END AS l
    FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, k, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, min(l) AS l, max(size) = d AS childless,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = d), '') AS ends
    FROM prefixes GROUP BY d, k
), subtrees AS (
    SELECT p.d, p.k, sum(CAST(c.childless AS BIGINT)) AS leaves, sum((c.n - 1) * c.l) AS saved
    FROM nodes c JOIN prefixes p ON p.conv_id = c.conv_id AND p.d <= c.d GROUP BY p.d, p.k
), children AS (
    SELECT d - 1 AS d, parent AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2
)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, CASE WHEN x.d > 0 THEN p.conv_id END AS parent_conv_id, CAST(x.n AS BIGINT) AS n_convs,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
    sha256(x.ends) AS ends_sha256
FROM nodes x JOIN subtrees s ON s.d = x.d AND s.k = x.k
LEFT JOIN nodes p ON p.d = x.d - 1 AND p.k = x.parent
LEFT JOIN children c ON c.d = x.d AND c.k = x.k
"""
