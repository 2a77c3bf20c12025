import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from spendlens.llm import topk

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, k=5):
    vectors = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    found = []
    for q, a in {v for v in vectors if v[0] % 50 == 0}:
        near = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q and len(a) == len(b))
        found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(near[:k])]
    return sorted(found)


def spark_rows(spark, rows, k=5):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string").drop("id") \
        if rows and len(rows[0]) == 3 else spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.whole_numbers(frame, "vec_id", "embedding", 256)
    return sorted(tuple(r) for r in topk.top_k(vectors.where("id % 50 = 0"), vectors, k).collect())


@pytest.mark.parametrize("limits", [{}, {"QUERIES": 3, "CANDIDATES": 40, "_STEP": 16}])
def test_matches_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(topk, name, value)
    rnd = random.Random(4)
    centres = [[rnd.gauss(0, 1) for _ in range(19)] for _ in range(5)]
    rows = [(i, [round(c + rnd.gauss(0, 0.1), 2) for c in rnd.choice(centres)]) for i in range(400)]
    rows += [(1000 + i, list(rows[i][1])) for i in range(60)]
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    assert spark_rows(spark, rows) == brute(rows)


def test_bounds_hold():
    import numpy as np

    rnd = np.random.default_rng(1)
    a, b = rnd.integers(-500, 500, (40, 21)), rnd.integers(-500, 500, (50, 21))
    for level in (*topk.LEVELS, 40):
        bound = topk._statistics(a.astype(float), level) @ topk._statistics(b.astype(float), level).T
        assert (bound + 1e-6 >= topk._products(a, b)).all()


def test_large_numbers():
    import numpy as np

    a = np.array([[2 ** 28 + 1, 3]])
    assert topk._products(a, a)[0, 0] == (2 ** 28 + 1) ** 2 + 9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [nan, 1.0]), (3, [inf, 1.0]),
            (None, [1.0, 2.0]), (200, [1.0, 2.0, 3.0]), (250, [1.0, 2.0]), (250, [1.0, 2.0]), (4, [-1.0, -9.0]), (300, [])]
    assert spark_rows(spark, rows) == brute(rows)
    assert spark_rows(spark, []) == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    found = topk.op1(spark, SF_DIR)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(topk.SQL).fetchall())
    assert found.where(F.col("rank") == 1).count() == 10
