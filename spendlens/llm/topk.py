"""Exact top-k search by inner product with multi-resolution segment statistics.

Every vector is cut into segments, of which the mean and the deviation are kept, for 1, 4 and 16 segments. The
squared distance of two vectors is at least the sum of ``n * ((mean - mean)^2 + (deviation - deviation)^2)`` over their
segments of n components. As inner product and distance determine each other for known norms, the lower bound of
the distance is the upper bound ``n * (mean * mean + deviation * deviation)`` of the product. From coarse to fine, pairs whose bound
is below the k-th best score found so far drop out; exact products are computed for those that survive.

Queries and candidates meet in a grid of blocks, and each cell gives at most k rows per query. Vectors that are null
or hold null or non-finite components take no part, nor do rows without an id. Only vectors of one length are
compared. Equal rows count once; a query is never its own result, nor is another row of its id.

Columns beside the id and the vector are ignored, whatever their names. An empty table gives no rows.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spendlens.llm.common import store, table

LEVELS = (1, 4, 16)
QUERIES = 1024  # queries in a block
CANDIDATES = 16_384  # candidates in a block
_STEP = 2048  # candidates looked at between two updates of the k-th best scores

SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations, each times the root of its segment's length: their products are the bound."""
    parts = [p for p in np.array_split(x, segments, axis=1) if p.shape[1]]
    roots = [p.shape[1] ** 0.5 for p in parts]
    return np.concatenate([np.stack([f(p) * r for p, r in zip(parts, roots)], axis=1) for f in (
        lambda p: p.mean(1), lambda p: p.std(1))], axis=1) if parts else np.zeros((len(x), 0))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floating point as long as every sum stays exact."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if size < 2 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """The k best (query row, candidate row, score), ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    none = np.iinfo(np.int64).min
    best, place = np.full((len(queries), k), none), np.full((len(queries), k), -1)
    asked = [_statistics(queries.astype(float), n) for n in LEVELS]
    for first in range(0, len(ids), _STEP):
        part, part_ids = vectors[first:first + _STEP], ids[first:first + _STEP]
        live = query_ids[:, None] != part_ids[None, :]
        least = best[:, -1]
        for level, stats in zip(LEVELS, asked):
            rows, columns = live.any(1), live.any(0)
            if not columns.any() or (least == none).all():
                break
            bound = stats[rows] @ _statistics(part[columns].astype(float), level).T
            slack = 1e-9 * np.abs(bound) + 1e-6  # rounding
            live[np.ix_(rows, columns)] &= bound + slack >= least[rows][:, None]
        rows, columns = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
        if not len(rows):
            continue
        scores = np.where(live[np.ix_(rows, columns)], _products(queries[rows], part[columns]), none)
        scores = np.concatenate([best[rows], scores], axis=1)
        places = np.concatenate([place[rows], np.broadcast_to(first + columns, (len(rows), len(columns)))], axis=1)
        # earlier candidates have smaller ids, so a stable order settles ties; ~x turns it around without overflow
        top = np.argsort(~scores, axis=1, kind="stable")[:, :k]
        best[rows], place[rows] = np.take_along_axis(scores, top, 1), np.take_along_axis(places, top, 1)
    row, rank = np.nonzero(place >= 0)
    found = place[row, rank]
    return row, order[found], best[row, rank]


def _packed(vectors: DataFrame, block: str, size: int) -> DataFrame:
    """Vectors of one length in blocks (dim, block, ids, values), one row each."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        values = rows["v"].combine_chunks()
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), block: pa.array([key[1].as_py()], pa.int32()), "ids": [rows["id"].to_pylist()],
                         "values": [values.flatten().to_numpy().astype("<i8").tobytes()]})

    counts = {r["dim"]: -(-r["count"] // size) for r in vectors.groupBy("dim").count().collect()}
    blocks = F.coalesce(F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("dim")], F.lit(1)) \
        if counts else F.lit(1)
    dealt = vectors.withColumn(block, F.pmod(F.xxhash64("id"), blocks).cast("int"))
    return dealt.groupBy("dim", block).applyInArrow(run, f"dim int, {block} int, ids array<bigint>, values binary")


def _cell(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def matrix(row: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(row["ids"][0].as_py(), np.int64)
        return ids, np.frombuffer(row["values"][0].as_py(), "<i8").reshape(len(ids), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if len(left) and len(right):
            (query_ids, queries), (ids, vectors) = matrix(left), matrix(right)
            row, at, score = search(query_ids, queries, ids, vectors, k)
            found = [query_ids[row], ids[at], score]
        return pa.table(found, names=["query_id", "id", "score"])

    return run


def whole_numbers(vectors: DataFrame, key: str, value: str, scale: int) -> DataFrame:
    """(id, v, dim) of the rows that take part, each component x being floor(scale * x)."""
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(value).isNotNull()).where(fine)
    rows = rows.select(F.col(key).cast("long").alias("id"),
                       F.transform(value, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    return rows.distinct().withColumn("dim", F.size("v"))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, id, score) of tables (id, v, dim): the k largest inner products, ties to smaller ids."""
    asked = store(_packed(queries, "q", QUERIES), "query-blocks")
    held = store(_packed(candidates, "c", CANDIDATES), "candidate-blocks")
    cells = held.select("dim", "c").join(asked.select("dim", "q"), "dim")
    left = asked.join(cells, ["dim", "q"])
    right = held.join(cells, ["dim", "c"]).select(
        F.col("dim").alias("right_dim"), F.col("q").alias("right_q"), F.col("c").alias("right_c"), "ids", "values")
    found = left.groupBy("dim", "q", "c").cogroup(right.groupBy("right_dim", "right_q", "right_c")).applyInArrow(
        _cell(k), "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    vectors = store(whole_numbers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256), "vectors")
    return top_k(vectors.where("id % 50 = 0"), vectors).withColumnRenamed("id", "vec_id")
