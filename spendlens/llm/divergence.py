"""Divergence of sources from each other and from their language, by hash-consed segment trees of term counts.

A group is a (lang, source). A language keeps the terms found in at least ``MIN_DOCS`` of its documents and numbers them, frequent ones
first. A group's counts over these numbers are the leaves of a segment tree; subtrees with equal counts are one
node, so the many stretches of zeros and of equal small counts are shared within a group and between groups. Two trees are priced by walking both
at once from their roots: a pair of nodes that was met before adds to its multiplicity and is not walked
again, and a pair of leaves is priced once, however many terms it stands for.

The numbers are cut into segments of ``SEGMENT`` terms, each a subtree of its own, and the sources of a language are dealt
into chunks of about ``CHUNK``; a task holds the trees of one segment and of two chunks, whatever the size of the corpus, the
number of sources or the share of one of them. Prices are added over the segments. The language's own
counts are one more tree, with which every group is compared for its ``part`` ``term``: of each segment the first
``TOP`` terms go on.

With N counted occurrences of V kept terms, a term counted c times has p = 1 + floor(10^9 (c + 5) / (N + 5 V)). Numbers are exact: counts are 64-bit,
products are taken without bound.

Null text, lang and source are empty. Repeated rows, and rows of equal or null ids, are documents of their own. Texts are counted whole, long
ones in pieces, and what a task counts is sent on whenever it holds ``HELD`` entries. Ties go to the item that is first in UTF-8 order.
Other columns are ignored, whatever their names. A language without kept terms has pairs of value 0 and no terms; an
empty table gives no rows.
"""

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spendlens.llm.common import release, store, table
from spendlens.operators.ordering import number_in_groups

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
SEGMENT = 1024
CHUNK = 64
HELD = 2_000_000

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_PIECE = 1 << 20


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces that end where a term does."""
    at = 0
    while at < len(data):
        end = _BREAK.search(data, at + _PIECE)
        end = end.start() if end else len(data)
        yield data[at:end]
        at = end


def _count(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the texts of a task; terms are UTF-8, as they end at ASCII characters."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                 pa.array(list(n), pa.binary()).view(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([docs[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2).cast(pa.large_binary())):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            seen: set[bytes] = set()
            for piece in _pieces(text.as_py().lower()):
                found = _TERM.findall(piece)
                n.update(found)
                seen.update(found)
            docs.update(seen)
            size += len(n)
            if size >= held:
                yield from rows()
                counts, size = {}, 0
    yield from rows()


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term, per group."""
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = rows.mapInArrow(partial(_count, held=held), "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _prices(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    whole = n + SMOOTH * v
    return np.array([1 + SCALE * (c + SMOOTH) // whole if whole else 0 for c in counts.tolist()], np.int64)


class Forest:
    """Hash-consed segment trees over one segment, one per row of ``leaves``: equal subtrees are one node."""

    def __init__(self, leaves: np.ndarray) -> None:
        width = 1 << max(0, leaves.shape[1] - 1).bit_length()
        self.counts, nodes = np.unique(leaves, return_inverse=True)
        nodes = nodes.reshape(leaves.shape)
        if width > leaves.shape[1]:  # places past the last term are a leaf of their own, which costs nothing
            nodes = np.pad(nodes, ((0, 0), (0, width - leaves.shape[1])), constant_values=len(self.counts))
        self.children = []  # by level from the leaves: the two nodes below each node
        while nodes.shape[1] > 1:
            left, right = nodes[:, ::2], nodes[:, 1::2]
            bound = int(nodes.max()) + 1
            keys, nodes = np.unique(left * bound + right, return_inverse=True)
            nodes = nodes.reshape(left.shape)
            self.children.append((keys // bound, keys % bound))
        self.roots = nodes[:, 0]

    def meet(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Walk the trees a[i] and b[i] at once: (i, leaf of a, leaf of b, times) per different pair of leaves."""
        which, one, two = np.arange(len(a)), self.roots[a], self.roots[b]
        times = np.ones(len(a), np.int64)
        for left, right in reversed(self.children):
            which, times = np.concatenate([which, which]), np.concatenate([times, times])
            one, two = np.concatenate([left[one], right[one]]), np.concatenate([left[two], right[two]])
            bound = int(max(one.max(initial=0), two.max(initial=0))) + 1
            keys, back = np.unique((which * bound + one) * bound + two, return_inverse=True)
            times = np.bincount(back, times, len(keys)).astype(np.int64)
            which, one, two = keys // bound // bound, keys // bound % bound, keys % bound
        real = (one < len(self.counts)) & (two < len(self.counts))
        return which[real], one[real], two[real], times[real]


_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _cell(rows: pa.Table, top: int) -> pa.Table:
    """Prices of the pairs of two chunks of sources over one segment, and the first terms of each source.

    Rows are (lang, first, second, segment, chunk, source, total, kept, places, counts, terms); the language's
    own row has no source and lists the terms.
    """
    own = {c: rows[c].to_pylist() for c in ("chunk", "source", "total", "places", "counts", "terms")}
    lang, v = rows["lang"][0].as_py(), rows["kept"][0].as_py()
    first, second = rows["first"][0].as_py(), rows["second"][0].as_py()
    whole = own["source"].index(None) if None in own["source"] else None
    found: dict[str, list] = {c: [] for c in ("source", "part", "item", "value")}
    groups = [i for i in range(len(rows)) if i != whole]
    chunk = np.array([own["chunk"][i] if i != whole else -1 for i in range(len(rows))])
    if first == second:
        a, b = np.triu_indices(len(groups), 1)
    else:
        a, b = (x.ravel() for x in np.meshgrid(*(np.flatnonzero(chunk[groups] == c) for c in (first, second)), indexing="ij"))
    a, b = np.array(groups, np.int64)[a], np.array(groups, np.int64)[b]
    price = np.zeros(len(a), np.int64)
    if whole is not None:
        terms = own["terms"][whole]
        leaves = np.zeros((len(rows), len(terms)), np.int64)
        for i in range(len(rows)):
            if own["places"][i]:
                leaves[i, own["places"][i]] = own["counts"][i]
        forest = Forest(leaves)
        # per tree, the price of each count that any tree holds
        table = np.stack([_prices(forest.counts, n, v) for n in own["total"]])
        step = max(1, (1 << 21) // max(1, len(terms)))
        for at in range(0, len(a), step):
            one, two = a[at:at + step], b[at:at + step]
            which, x, y, times = forest.meet(one, two)
            np.add.at(price, at + which, np.abs(table[one[which], x] - table[two[which], y]) * times)
        if first == second and groups:
            which, x, y, _ = forest.meet(np.array(groups), np.full(len(groups), whole))
            g = np.array(groups)[which]
            excess = table[g, x] - table[whole, y]
            wanted = (excess > 0) & (forest.counts[x] > 0)
            priced = {(i, p, q): e for i, p, q, e in zip(g[wanted].tolist(), x[wanted].tolist(), y[wanted].tolist(), excess[wanted].tolist())}
            above = np.searchsorted(forest.counts, leaves[whole])
            for i in groups:
                held = own["places"][i] or []
                at = np.searchsorted(forest.counts, leaves[i][held]).tolist()
                best = sorted((-e, terms[place].encode(), place) for place, p in zip(held, at)
                              if (e := priced.get((i, p, int(above[place])))) is not None)[:top]
                for e, _, place in best:
                    for c, value in zip(found, (own["source"][i], "term", terms[place], -e)):
                        found[c].append(value)
    names = own["source"]
    for x, y in ((a, b), (b, a)):
        found["source"] += [names[i] for i in x]
        found["item"] += [names[i] for i in y]
        found["part"] += ["pair"] * len(x)
        found["value"] += price.tolist()
    return pa.table({"lang": pa.array([lang] * len(found["value"]), pa.string()), **{c: pa.array(x, _OUT.field(c).type) for c, x in found.items()}},
                    schema=_OUT)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, segment: int = SEGMENT, chunk: int = CHUNK, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module's text."""
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    counts = store(term_counts(docs, held), "group-terms")
    release(docs.sparkSession)
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    numbers = number_in_groups(vocabulary.withColumn("rare", -F.col("docs")), ["lang"], ["rare", "term"], "id")
    numbers = store(numbers.select("lang", "term", "n", (F.col("id") - 1).alias("id")), "kept-terms")
    sizes = numbers.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("all"))
    # a stored side is broadcast if it is small, and its join with a hot language divided if not
    counted = counts.join(numbers.select("lang", "term", "id"), ["lang", "term"])
    place = (F.col("id") % segment).cast("int")
    lists = counted.groupBy("lang", "source", F.expr(f"id div {segment}").alias("segment")).agg(
        F.collect_list(F.struct(place.alias("place"), "n")).alias("leaves"), F.sum("n").alias("n"))
    lists = store(lists, "segment-counts")
    totals = lists.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    groups = store(groups, "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    chunks = -(-most // chunk) or 1
    segments = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.expr(f"(kept - 1) div {segment}"), F.lit(0).cast("long")))).alias("segment")
    members = groups.select("*", F.pmod(F.xxhash64("source"), F.lit(chunks)).cast("int").alias("chunk"), segments)
    members = members.join(lists.drop("n"), ["lang", "source", "segment"], "left").select(
        "lang", "source", "segment", "chunk", "total", "kept", F.col("leaves.place").alias("places"), F.col("leaves.n").alias("counts"),
        F.lit(None).cast("array<string>").alias("terms"))
    # the language's row lists all terms of the segment, in order
    whole = numbers.groupBy("lang", F.expr(f"id div {segment}").alias("segment")).agg(
        F.array_sort(F.collect_list(F.struct(place.alias("place"), "n", "term"))).alias("leaves"))
    whole = whole.join(sizes, "lang").select(
        "lang", F.lit(None).cast("string").alias("source"), "segment", F.lit(None).cast("int").alias("chunk"), F.col("all").alias("total"),
        "kept", F.col("leaves.place").alias("places"), F.col("leaves.n").alias("counts"), F.col("leaves.term").alias("terms"))
    # a chunk meets itself and every other; the language's row goes to all
    others = F.sequence(F.lit(0), F.lit(chunks - 1))
    met = F.transform(others, lambda other: F.struct(F.least("chunk", other).alias("first"), F.greatest("chunk", other).alias("second")))
    every = F.flatten(F.transform(others, lambda x: F.transform(F.sequence(x, F.lit(chunks - 1)), lambda y: F.struct(x.alias("first"), y.alias("second")))))
    cells = members.withColumn("cell", F.explode(met)).unionByName(whole.withColumn("cell", F.explode(every)))
    cells = cells.select("lang", F.col("cell.first").alias("first"), F.col("cell.second").alias("second"), "segment", "chunk", "source",
                         "total", "kept", "places", "counts", "terms")

    def priced(rows: pa.Table) -> pa.Table:
        return _cell(rows, top)

    priced = cells.groupBy("lang", "first", "second", "segment").applyInArrow(
        priced, "lang string, source string, part string, item string, value long")
    summed = priced.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))


def op13(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), words AS (
    SELECT r, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counted AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sized AS (
    SELECT g.lang, g.source, coalesce(any_value(l.v), 0) AS v, coalesce(sum(c.n), 0) AS n
    FROM groups g LEFT JOIN langs l USING (lang) LEFT JOIN counted c USING (lang, source) GROUP BY g.lang, g.source
), dense AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS c,
        1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (s.n + 5 * s.v) AS p,
        1 + 1000000000::HUGEINT * (k.n + 5) // (l.n + 5 * l.v) AS q
    FROM sized s JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counted c USING (lang, source, term)
), priced AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0 FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM dense WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM priced
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
