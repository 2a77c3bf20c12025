"""Secret findings, with false positives removed by a random forest.

A candidate is a run of at least ``SHORTEST`` characters of keys, paths and addresses that holds a digit or goes ``TURNS`` times
from small to capital letters or back, cut after its last
assignment to a name; or a value of any length and make that is assigned to a name of a credential, in quotes with blanks and any letters; or the password
in an address, or the body of a private key block. Its features
are its length and its shares of character classes; how often its characters change class, and how unlikely its
transitions are among all letter and digit pairs of the corpus; the share of it that frequent short words of the corpus
cover; marks of paths and addresses in it and before it; and the words beside it. The forest (Spark ML) learns from
labelled findings: any table of findings with a label will do. The query takes its labels from findings
whose context leaves no doubt: a value assigned to a name of a credential (letters alone after a colon may be prose, so
they stay unlabelled), against other addresses, plain numbers and digests named as such; half of the labelled findings' context is hidden in training, so that the forest does not
lean on the naming words alone. Findings without such a context are judged by the forest.

Null texts are empty. Rows are scanned one by one, so keys may be null or repeat. If labels of both classes are
not to be had, every finding gets the share of true ones.

A text is scanned as one value, however long. Columns beside key and text are ignored, whatever their names.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import store, table
from spendlens.llm.kernels import LOWER, texts

SHORTEST = 16
TURNS = 6
TREES = 40
DEPTH = 6
SEED = 7
SHARE = 0.001  # of the documents that must hold a word of the dictionary; so its size is bounded
BESIDE = 48  # characters of context on each side

_CANDIDATE = re.compile(rf"[A-Za-z0-9+/=_.@:~%-]{{{SHORTEST},}}")
_SHORT_WORD = re.compile(r"(?<![a-z])[a-z]{3,6}(?![a-z])")
_TOKEN = re.compile(r"[A-Za-z]+")
# fixed values: words that name a credential, and words that name something that only looks like one
_CREDENTIAL = frozenset("token secret key apikey password passwd pwd credential credentials auth bearer access private".split())
_DIGEST = frozenset("sha sha1 sha256 md5 digest checksum hash commit revision uuid guid etag card phone mail email http https www".split())
_ADDRESS = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://|^(?:~|\.{1,2})?/|^[^@]+@[\w-]+(?:\.[\w-]+)+$|\.[a-z]{2,}(?:/|$)")
_NAMED = re.compile(
    rf"(?i)(?<![a-z])(?:{'|'.join(sorted(_CREDENTIAL, key=len, reverse=True))})[\"'`]?[ \t]*(?>[:=]=|=>|[:=])(?!//)[ \t]*"
    r"(?:(?P<mark>\"\"\"|'\'\'|[\"'`])(?P<quoted>(?:\\.|(?!(?P=mark))[^\\\r\n])*)(?P=mark)|(?P<bare>[\w+/=.@:~%!#$^*?-]+))")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s*(?P<value>[A-Za-z0-9+/=\s:,-]+?)\s*-----END")
_PASSWORD = re.compile(r"://[^\s/:@\"'`]*:(?P<value>[!#-&(-.0-?A-_a-~]+)@")
_CUT = re.compile(r".*(?<![A-Za-z0-9_.-])[A-Za-z_][A-Za-z0-9_.-]*(?:=+(?=[^=])|:(?!//))")
_BUCKETS = 8
FEATURES = 17 + _BUCKETS

_CODE = np.full(256, 36, np.int64)  # a to z, 0 to 9, anything else
_CODE[97:123] = np.arange(26)
_CODE[48:58] = np.arange(26, 36)


class Corpus:
    """What the features need to know of all documents: short frequent words, and costs of character pairs."""

    def __init__(self, words: frozenset[str], pairs: np.ndarray) -> None:
        self.words = words
        share = (pairs + 1) / (pairs + 1).sum(1, keepdims=True)
        self.cost = -np.log2(share)


def corpus(docs: DataFrame, text: str = "text") -> Corpus:
    """Counts over all texts, per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        pairs, n = np.zeros(37 * 37, np.int64), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.update(set(_SHORT_WORD.findall((value or "").lower())))
                n += 1
            for _, _, data, _ in texts(batch.column(0)):
                codes = _CODE[LOWER[data]]
                pairs += np.bincount(codes[:-1] * 37 + codes[1:], minlength=37 * 37)
        names = [*held, *[f"#{i}" for i in range(37 * 37)], "##"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([*held.values(), *pairs.tolist(), n], pa.int64())], names=["name", "n"])

    found = docs.select(text).mapInArrow(run, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    found = store(found, "corpus-counts")
    total = found.where("name = '##'").first()
    least = max(2, math.ceil(SHARE * total["n"])) if total else 2
    words = [r["name"] for r in found.where(~F.col("name").startswith("#") & (F.col("n") >= least)).collect()]
    pairs = np.zeros(37 * 37)
    for r in found.where(F.col("name").rlike("^#[0-9]+$")).collect():
        pairs[int(r["name"][1:])] = r["n"]
    return Corpus(frozenset(words), pairs.reshape(37, 37))


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def coverage(value: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, the longest word first at each place."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(6, 2, -1) if at + n <= len(low) and low[at:at + n] in words), 0)
        covered += size
        at += size or 1
    return covered / len(low)


def features(value: str, before: str, after: str, known: Corpus) -> list[float]:
    kinds = [_class(c) for c in value]
    n, counts = len(value), Counter(value)
    codes = _CODE[np.frombuffer(value.lower().encode("utf-8", "replace"), np.uint8)]
    words = [w.lower() for w in _TOKEN.findall(before)[-3:]]
    near = set(words) | {w.lower() for w in _TOKEN.findall(after)[:1]}
    last = before.rstrip("\"'` ")
    out = [
        min(n, 512), *[kinds.count(k) / n for k in range(4)],
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        float(known.cost[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        max(counts.values()) / n, coverage(value, known.words),
        sum(value.count(c) for c in "/.:@") / n, float(bool(_ADDRESS.search(value))), float(before[-1:] in ("/", "\\", "@")),
        float(last[-1:] in ("=", ":")), float(before[-1:] in ("\"", "'", "`") and after[:1] == before[-1:]),
        float(bool(near & _CREDENTIAL)), float(bool(near & _DIGEST)),
    ]
    buckets = [0.0] * _BUCKETS
    for word in words:
        buckets[sum(word.encode()) % _BUCKETS] = 1.0
    return out + buckets


def verdict(value: str, before: str, after: str = "") -> int | None:
    """1 or 0 where the context leaves no doubt, as an analyst would label the finding."""
    words = [w.lower() for w in _TOKEN.findall(before)[-2:]]
    last = before.rstrip("\"'` ")[-1:]
    if _DIGEST & set(words) and not (words[-1] in _CREDENTIAL and last in ("=", ":", ">")):
        return 0
    if before.rstrip().endswith("PRIVATE KEY-----"):
        return 1
    if after[:1] == "@" and re.search(r"://[^\s/:@]*:$", before):
        return 1
    if last in ("=", ":", ">") and _CREDENTIAL & set(words):
        prose = last == ":" and before[-1:] not in ("\"", "'", "`") and value.isalpha()
        prose |= last == ":" and any(c.isspace() for c in value)  # a quoted sentence
        return None if value.isdigit() or prose else 1
    if _ADDRESS.search(value) or value.isdigit() or not any(c.isalpha() for c in value):
        return 0
    return None


def _turns(value: str) -> int:
    letters = [c.isupper() for c in value if c.isalpha()]
    return sum(a != b for a, b in zip(letters, letters[1:]))


def found_in(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates, by place and without overlaps; assigned values and passwords come before runs."""
    named = []
    for m in _NAMED.finditer(text):
        a, b = m.span("quoted" if m["bare"] is None else "bare")
        b = a + len(text[a:b].rstrip(".:!?")) if m["bare"] is not None else b
        named.append((a, b))
    named = sorted({*named, *[m.span("value") for finder in (_PASSWORD, _PEM) for m in finder.finditer(text)]})
    out = []
    for a, b in named:
        if a < b and (not out or a >= out[-1][1]):
            out.append((a, b))
    taken, at = list(out), 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        cut = _CUT.match(m[0]) if "://" not in m[0] else None
        a += cut.end() if cut else 0
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        clear = at == len(taken) or taken[at][0] >= b
        if clear and b - a >= SHORTEST and (any(c.isdigit() for c in text[a:b]) or _turns(text[a:b]) >= TURNS):
            out.append((a, b))
    return sorted(out)


_SCHEMA = "start int, `end` int, value string, label int, features array<double>, hidden array<double>"


def candidates(docs: DataFrame, known: Corpus, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end, value, label, features, hidden): one row per candidate; ``hidden`` lacks the context."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, value in enumerate(batch.column(1).to_pylist()):
                for a, b in found_in(value or ""):
                    own, before, after = value[a:b], value[max(0, a - BESIDE):a], value[b:b + BESIDE]
                    rows.append(row)
                    found.append({
                        "start": a, "end": b, "value": own, "label": verdict(own, before, after),
                        "features": features(own, before, after, shared.value), "hidden": features(own, "", "", shared.value)})
            out = pa.Table.from_pylist(found, _FOUND).combine_chunks()
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, *[c.combine_chunks() for c in out.columns]], names=["key", *out.column_names])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, {_SCHEMA}")


_FOUND = pa.schema([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("label", pa.int32()),
                    ("features", pa.list_(pa.float64())), ("hidden", pa.list_(pa.float64()))])


def train(findings: DataFrame, label: str = "label", inputs: str = "features") -> RandomForestClassificationModel | float:
    """A forest from labelled findings; a number, the share of true ones, if a class is missing."""
    rows = findings.where(F.col(label).isNotNull())
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return counts.get(1, 0) / sum(counts.values()) if counts else 0.0
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="vector")
    return forest.fit(rows.select(F.col(label).cast("double").alias("label"), array_to_vector(inputs).alias("vector")))


def judge(findings: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """The findings with the probability that each is a secret."""
    if isinstance(model, float):
        return findings.withColumn("probability", F.lit(model))
    judged = model.transform(findings.withColumn("vector", array_to_vector("features")))
    return judged.withColumn("probability", vector_to_array("probability")[1]).select(*findings.columns, "probability")


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = store(candidates(docs, corpus(docs)), "candidates")
    labelled = found.where("label IS NOT NULL")
    hide = F.pmod(F.xxhash64("key", "start", "value"), F.lit(2)) == 0
    labelled = labelled.select("label", F.when(hide, F.col("hidden")).otherwise(F.col("features")).alias("features"))
    judged = judge(found, train(labelled))
    return judged.select(
        F.col("key").alias("doc_id"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        F.sha2("value", 256).alias("value_sha256"), "probability", (F.col("probability") >= 0.5).alias("secret"))
