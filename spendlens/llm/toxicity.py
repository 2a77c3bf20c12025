"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words in lower case and their first 3 to 8 letters. Those with ``LIFT`` times the share among toxic documents,
counted over all labelled documents that may be learned from, make the vocabulary: the ``TERMS`` strongest by the
chi-squared statistic. Examples are the labelled documents with the smallest hashes, at most ``EXAMPLES`` per
class, as TF-IDF vectors over it; a vote counts as often as its class is under-sampled.

An inverted index keeps, for each term, its examples and weights, cut into blocks of ``BLOCK`` examples with the largest
weight of each block. A text's products with the block maxima bound its cosines; blocks are read from the largest
bound down until none can hold a nearer example than the ``NEAREST`` found. Their votes, weighted by distance, are
mapped to the share of toxic examples seen at that vote when every example is scored by the others.

Null texts are empty; a text without terms of the vocabulary gets the share of toxic ones among such examples. Rows are
scored one by one, so keys may be null or repeat. A key with several labels is toxic if one says so. Without labels of
both classes every score is the share of toxic labels, or 0.

A text is worked on as one value, however long. Equal rows are scored each. Columns beside key, text and label are ignored, whatever their names.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import in_fold, store, table

TERMS = 512
EXAMPLES = 3000  # per class
NEAREST = 15
BLOCK = 512
LIFT = 4  # times as large as among other documents, at least, is a term's share of the toxic ones
SHARE = 0.005  # of the toxic documents that must hold a term; so the number of such terms is bounded
_PREFIXES = range(3, 9)
_WORD = re.compile(r"[^\W\d_]+")
_MEMO = 300_000


def _word_terms(word: str) -> set[str]:
    return {word, *[word[:n] + "*" for n in _PREFIXES if len(word) >= n]}


def _heads(terms) -> set[str]:
    """First letters by which most words are seen to have none of the terms."""
    return {term[:3] for term in terms}


def _terms(text: str, heads: set[str] | None = None) -> set[str]:
    found = set()
    for word in set(_WORD.findall(text.lower())):
        if heads is None or word[:3] in heads:
            found |= _word_terms(word)
    return found


def _counts(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, n): in how many texts each term occurs, of the wanted ones or all; counted per task first."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        heads = None if shared.value is None else _heads(shared.value)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _terms(text or "", heads)
                total.update(found if shared.value is None else found & shared.value)
                if len(total) > _MEMO:
                    yield _counted(total)
                    total = Counter()
        yield _counted(total)

    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])


class _Vocabulary:
    """Numbers of the chosen terms, remembered by token."""

    def __init__(self, idf: dict[str, float]) -> None:
        self.numbers = {term: i for i, term in enumerate(sorted(idf))}
        self.idf = np.array([idf[t] for t in sorted(idf)])
        self.memo: dict[str, tuple[int, ...]] = {}
        self.heads = _heads(idf)

    def _of(self, token: str) -> tuple[int, ...]:
        words = [w for w in _WORD.findall(token) if w[:3] in self.heads]
        found = tuple(self.numbers[t] for w in words for t in _word_terms(w) if t in self.numbers)
        if len(self.memo) > _MEMO:
            self.memo.clear()
        self.memo[token] = found
        return found

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of a text, the weights of length one."""
        memo, counts = self.memo, Counter()
        for token in text.lower().split():
            found = memo.get(token)
            if found is None:
                found = self._of(token)
            if found:
                counts.update(found)
        ids = np.array(sorted(counts), np.int64)
        weights = (1 + np.log([counts[i] for i in ids.tolist()])) * self.idf[ids] if len(ids) else np.zeros(0)
        return ids, weights / max(np.linalg.norm(weights), 1e-12)


class Index:
    """Postings of each term by example, with the largest weight of each block of examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> None:
        # examples alike in their strongest terms share blocks, which keeps the maxima tight
        strongest = [tuple(ids[np.argsort(-w, kind="stable")[:3]].tolist()) for ids, w in vectors]
        self.order = sorted(range(len(vectors)), key=lambda i: (strongest[i], i))
        self.blocks = -(-len(vectors) // BLOCK)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(terms)]
        for place, example in enumerate(self.order):
            for term, weight in zip(*vectors[example]):
                lists[term].append((place, weight))
        self.largest = np.zeros((terms, self.blocks))
        self.places, self.weights = [], []
        self.cuts = np.zeros((terms, self.blocks + 1), np.int64)
        for term, own in enumerate(lists):
            places, weights = np.array([p for p, _ in own], np.int64), np.array([w for _, w in own])
            np.maximum.at(self.largest[term], places // BLOCK, weights)
            self.cuts[term] = np.searchsorted(places // BLOCK, np.arange(self.blocks + 1))
            self.places.append(places)
            self.weights.append(weights)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k largest cosines above zero with their examples, ties to the example that comes first in the index."""
        bounds = weights @ self.largest[ids]
        found: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable").tolist():
            if bounds[block] <= 0 or len(found) >= k and bounds[block] + 1e-9 < -found[k - 1][0]:
                break
            sums = np.zeros(BLOCK)
            for term, weight in zip(ids.tolist(), weights.tolist()):
                a, b = self.cuts[term, block], self.cuts[term, block + 1]
                sums[self.places[term][a:b] - block * BLOCK] += weight * self.weights[term][a:b]
            sums = np.round(sums, 9)
            near = np.flatnonzero(sums > 0)
            near = near[np.lexsort((near, -sums[near]))[:k + 1]]
            found += [(-s, p) for s, p in zip(sums[near].tolist(), (near + block * BLOCK).tolist()) if self.order[p] != without]
            found = sorted(found)[:k]
        return [(-score, self.order[place]) for score, place in found]


class Model:
    def __init__(self, idf: dict[str, float], examples: list, totals: tuple[int, int]) -> None:
        self.vocabulary = _Vocabulary(idf)
        self.memo: dict[bytes, tuple[float, list[tuple[float, int]]]] = {}
        self.keys = [r["key"] for r in examples]
        self.labels = np.array([r["toxic"] for r in examples], float)
        sampled = [max(1, int((self.labels == y).sum())) for y in (0, 1)]
        self.weight = np.where(self.labels == 1, totals[1] / sampled[1], totals[0] / sampled[0])
        vectors = [(np.array(r["ids"], np.int64), np.array(r["weights"])) for r in examples]
        self.index = Index(vectors, len(idf))
        empty = np.array([not len(ids) for ids, _ in vectors], bool)
        total = sum(totals)
        self.prior = totals[1] / total if total else 0.0
        mass = self.weight[empty].sum()
        self.without = float((self.weight * self.labels)[empty].sum() / mass) if mass else self.prior
        votes = [(self._vote(self.index.nearest(*v, NEAREST, i)), i) for i, v in enumerate(vectors) if not empty[i]]
        self.votes, self.shares = _rising([v for v, _ in votes], self.labels[[i for _, i in votes]], self.weight[[i for _, i in votes]])

    def _vote(self, near: list[tuple[float, int]]) -> float:
        own = np.array([i for _, i in near], np.int64)
        near_by = np.array([s for s, _ in near])
        weight = self.weight[own] * near_by ** 2 / (1.05 - near_by)
        return float((weight * self.labels[own]).sum() + self.prior) / float(weight.sum() + 1)

    def score(self, text: str) -> tuple[float, list[tuple[float, int]]]:
        ids, weights = self.vocabulary.vector(text)
        if not len(ids):
            return self.without, []
        key = ids.tobytes() + weights.tobytes()  # copies ask the same
        if key not in self.memo:
            if len(self.memo) > _MEMO // 10:
                self.memo.clear()
            near = self.index.nearest(ids, weights, NEAREST)
            self.memo[key] = float(np.interp(self._vote(near), self.votes, self.shares)) if near else self.without, near
        return self.memo[key]


def _rising(votes: list[float], labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising curve nearest to the labels by vote (adjacent violators pooled), within 0 and 1."""
    if not votes:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    pools: list[list[float]] = []  # sum of labels, of weights, of votes times weights
    for i in np.argsort(votes, kind="stable"):
        pools.append([labels[i] * weights[i], weights[i], votes[i] * weights[i]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | float:
    """Learn from the documents with a label; a number, the share of toxic ones, if a class is missing."""
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.col(label).cast("int")).alias("toxic"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(marked.hint("merge"), "key")  # labels grow with the documents: the same plan at every size
    rows = store(rows, "labelled")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n = (totals.get(0, 0), totals.get(1, 0))
    if not all(n):
        return n[1] / sum(n) if sum(n) else 0.0
    least = max(2, int(np.ceil(SHARE * n[1])))
    toxic = {r["term"]: r["n"] for r in _counts(rows.where("toxic = 1"), None).where(F.col("n") >= least).collect()}
    other = {r["term"]: r["n"] for r in _counts(rows.where("toxic = 0"), set(toxic)).collect()}
    strength = {}
    for term, a in toxic.items():
        b = other.get(term, 0)
        c, d = n[1] - a, n[0] - b
        if a * n[0] > LIFT * b * n[1]:
            strength[term] = (a * d - b * c) ** 2 * sum(n) / max(1, (a + b) * (c + d) * n[0] * n[1])
    chosen = sorted((t for t in strength if strength[t] > 30), key=lambda t: (-strength[t], t))[:TERMS]
    # how much a term tells stands beside how rare it is
    idf = {t: float(np.log(1 + sum(n) / (toxic[t] + other.get(t, 0)))) * toxic[t] / n[1] / (
        toxic[t] / n[1] + other.get(t, 0) / n[0]) for t in chosen}
    if not idf:
        return n[1] / sum(n)
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _Vocabulary(shared.value)
        for batch in batches:
            found = [vocabulary.vector(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([ids for ids, _ in found], pa.list_(pa.int64())),
                 pa.array([w for _, w in found], pa.list_(pa.float64()))], names=["key", "toxic", "ids", "weights"])

    at = F.pmod(F.xxhash64(F.col("key").cast("string"), "text"), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for y in (0, 1) for x in (y, min(1.0, 1.3 * EXAMPLES / n[y] + 10 / n[y]))])
    sample = rows.withColumn("at", at).where(F.col("at") < share[F.col("toxic")] * (1 << 30)).select(
        F.col("key").cast("string").alias("key"), "toxic", "text", "at")
    found = sample.orderBy("at", "key").select("key", "toxic", "text").mapInArrow(
        vectors, "key string, toxic int, ids array<long>, weights array<double>").collect()
    kept = [r for y in (0, 1) for r in [r for r in found if r["toxic"] == y][:EXAMPLES]]
    return Model(idf, kept, n)


def score(docs: DataFrame, model: Model | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, evidence): evidence lists the nearest examples with their cosines and labels."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, evidence = [], []
            for value in batch.column(1).to_pylist():
                if isinstance(model, float):
                    scores.append(model), evidence.append([])
                    continue
                found, near = model.score(value or "")
                scores.append(min(1.0, max(0.0, found)))
                evidence.append([{"example": model.keys[i], "cosine": s, "toxic": int(model.labels[i])} for s, i in near])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, _EVIDENCE)], names=["key", "score", "evidence"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, score double, evidence array<struct<example:string,cosine:double,toxic:int>>")


_EVIDENCE = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def op5(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score(docs, fit(docs, labels.where(~in_fold("doc_id", 5, 0))))
    return found.select(
        F.col("key").alias("doc_id"), in_fold("key", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("evidence").cast("long").alias("n_evidence"))
