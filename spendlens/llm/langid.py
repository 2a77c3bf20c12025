"""Language identification by the nearest of several centroids per language.

A text is the TF-IDF vector, of length one, of its byte 2-grams and 3-grams: ASCII letters in lower case and all
bytes from 0x80 on, anything else being a space. N-grams are hashed to ``BINS`` numbers. Document frequencies
count every labelled document that may be learned from; centroids come from spherical k-means over at most
``SAMPLE`` documents per language, those with the smallest hash of key and text. The prediction is the language
of the centroid with the largest cosine; a text further from it than ``SLACK`` times the similarity that
hardly any learned text of like length falls below is rejected.

Null texts and texts without a letter get ``und`` and score 0, as does everything if no label can be learned from.
Null labels are not learned from. Rows are predicted one by one; equal or null keys do no harm.

Long texts are counted in pieces of ``_PIECE`` bytes. Where centroids are equally near, the first language in order wins. Other columns are
ignored, whatever their names; :func:`recognised` returns them as they are.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import in_fold, table
from spendlens.llm.kernels import texts

BINS = 1 << 13
SAMPLE = 500  # documents per language that centroids are learned from
CENTROIDS = 4
ROUNDS = 10
SLACK = 0.5
_ROWS = 64  # texts turned into vectors at once
_PIECE = 1 << 19  # bytes of one long text counted at once

_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _bins(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins and places of the n-grams in folded bytes; none spans two spaces."""
    blank = data == 32
    wide = data.astype(np.uint32)
    pairs = wide[:-1] << 8 | wide[1:]
    two = np.flatnonzero(~(blank[:-1] & blank[1:]))
    triples = pairs[:-1] << 8 | wide[2:]
    crossing = (blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:])
    three = np.flatnonzero(~crossing)
    codes = np.concatenate([pairs[two], triples[three]])
    return (codes * np.uint32(2654435761) >> np.uint32(19)).astype(np.int64), np.concatenate([two, three])


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """N-gram counts of each text by bin; texts stand apart by two spaces."""
    n = len(offsets) - 1
    if n == 1 and len(data) > _PIECE:
        total = np.zeros((1, BINS), np.int64)
        for at in range(0, len(data), _PIECE):
            # a piece starts two bytes early, so that every n-gram is in one piece: those of its first two bytes were counted
            piece = _FOLD[data[max(0, at - 2):at + _PIECE]]
            total[0] += np.bincount(_bins(piece)[0], minlength=BINS)
            if at:
                total[0] -= np.bincount(_bins(piece[:2])[0], minlength=BINS)
        return total
    laid = np.full(len(data) + 2 * n + 2, 32, np.uint8)
    laid[np.arange(len(data)) + 2 * np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _FOLD[data]
    bins, places = _bins(laid)
    first = offsets[:-1] + 2 * np.arange(1, n + 1)
    rows = np.maximum(np.searchsorted(first - 1, places, "right") - 1, 0)
    return np.bincount(rows * BINS + bins, minlength=n * BINS).reshape(n, BINS)


def _runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, last, data, offsets in texts(column):
        for at in range(0, last - first, _ROWS):
            edges = offsets[at:at + _ROWS + 1]
            yield first + at, data[edges[0]:edges[-1]], edges - edges[0]


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(found, dtype=np.float32) * idf
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """In how many texts each bin occurs, and at the end the number of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            for _, data, offsets in _runs(batch.column(0)):
                total[:-1] += (counts(data, offsets) > 0).sum(0)
                total[-1] += len(offsets) - 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bin", "n"])

    out = np.zeros(BINS + 1, np.int64)
    for bin_, n in docs.select(text).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n")).collect():
        out[bin_] = n
    return out


def _means(points: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from far-apart first centres."""
    centres = [points.mean(0)]
    while len(centres) < min(k, len(points)):
        near = np.max(np.stack([points @ c for c in centres[1:] or centres]), axis=0)
        centres.append(points[int(near.argmin())])
    centres = np.stack(centres)
    for _ in range(ROUNDS):
        own = (points @ centres.T).argmax(1)
        centres = np.stack([points[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centres)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, floors: np.ndarray) -> None:
        self.idf, self.langs, self.centroids, self.floors = idf, langs, centroids, floors

    def predict(self, found: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        near = vectors(found, self.idf) @ self.centroids.T
        best = near.argmax(1)
        score = np.clip(near[np.arange(len(best)), best], 0, 1).astype(float)
        return [self.langs[i] for i in best], score, score < self.floors[octave(found.sum(1))]


def octave(n_grams: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n_grams, 1)).astype(int), 31)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from documents with a label; see the module's text for what is sampled and what counts all."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("at"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    df = document_frequencies(rows)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + 1
    # a share of each language first, so that few texts are moved; then exactly SAMPLE of them
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, 1.5 * SAMPLE / n + 20 / n))])
    part = F.pmod("at", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")[:SAMPLE]
        parts = [counts(data, offsets) for _, data, offsets in _runs(group["text"].combine_chunks())]
        found = np.concatenate(parts)
        points = vectors(found, idf)
        points, sizes = points[found.sum(1) > 0], found.sum(1)[found.sum(1) > 0]
        if not len(points):
            return pa.table({"lang": group["lang"][:0], "centroid": pa.array([], pa.list_(pa.float32())),
                             "octaves": pa.array([], pa.list_(pa.int32())), "near": pa.array([], pa.list_(pa.float32()))})
        centres = _means(points, CENTROIDS)
        near = (points @ centres.T).max(1)
        n = len(centres)
        return pa.table({
            "lang": pa.array([group["lang"][0].as_py()] * n), "centroid": pa.array(list(centres.astype(np.float32))),
            "octaves": pa.array([octave(sizes).astype(np.int32)] + [None] * (n - 1), pa.list_(pa.int32())),
            "near": pa.array([near.astype(np.float32)] + [None] * (n - 1), pa.list_(pa.float32()))})

    learned = rows.where(part).groupBy("lang").applyInArrow(
        learn, "lang string, centroid array<float>, octaves array<int>, near array<float>").collect()
    if not learned:
        return None
    learned.sort(key=lambda r: (r["lang"], r["centroid"]))
    octaves = np.concatenate([r["octaves"] for r in learned if r["octaves"]])
    near = np.concatenate([r["near"] for r in learned if r["near"]])
    floors = np.zeros(32)
    for i in range(32):
        own = near[octaves == i]
        floors[i] = SLACK * np.quantile(own, 0.01) if len(own) >= 20 else 0
    return Model(idf, [r["lang"] for r in learned], np.array([r["centroid"] for r in learned], np.float32), floors)


def _predictions(column: pa.Array, model: Model | None) -> list[pa.Array]:
    langs, scores, rejected = [], [], []
    for _, data, offsets in _runs(column):
        n = len(offsets) - 1
        own, score, far = model.predict(counts(data, offsets)) if model else (["und"] * n, np.zeros(n), np.ones(n, bool))
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            if not _has_letter(data[a:b]):
                own[i], score[i], far[i] = "und", 0, True
        langs += own
        scores += score.tolist()
        rejected += far.tolist()
    return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]


def recognised(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents that are not rejected, all columns as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = _predictions(batch.column(at), shared.value)[2]
            yield batch.filter(pc.invert(rejected))

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) for every document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_predictions(batch.column(1), shared.value)],
                names=["key", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double, rejected boolean")


def _has_letter(data: np.ndarray) -> bool:
    low = data[:4096]  # nearly always enough to find one
    if ((low | 32) - np.uint8(97) < 26).any() or ((data | 32) - np.uint8(97) < 26).any():
        return True
    return bool((data > 127).any()) and any(map(str.isalpha, data.tobytes().decode()))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~in_fold("doc_id", 4, 2)))
    found = predict(docs, model).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")
