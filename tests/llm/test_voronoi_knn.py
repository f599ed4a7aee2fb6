"""Top-k search against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import voronoi_knn


def brute(rows, k, every):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(good):
        if q % every == 0:
            found = sorted((-sum(s * t for s, t in zip(x, y)), i) for b, (i, y) in enumerate(good) if b != a)[:k]
            out += [(q, r + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, i) in enumerate(found)]
    return sorted(out)


def check(spark, rows, k=5, every=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).withColumn("v", F.lit(1)).repartition(3)
    got = sorted(tuple(r) for r in voronoi_knn.top_k(df, F.col("vec_id") % every == 0, k).collect())
    assert got == brute(rows, k, every)


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 400)]
    rows += [(None, [1.0] * 8), (500, None), (505, [1.0, None]), (510, [math.nan] * 8), (515, [math.inf] * 8), (520, []), (525, [1.0]), (0, [0.1] * 8), (0, [0.1] * 8)]
    for cell_rows, block_rows in ((4096, 2048), (20, 7)):
        monkeypatch.setattr(voronoi_knn, "CELL_ROWS", cell_rows)
        monkeypatch.setattr(voronoi_knn, "BLOCK_ROWS", block_rows)
        check(spark, rows)


def test_distant_cells_are_pruned():
    centres = np.array([[100.0, 0.0], [-100.0, 0.0], [0.0, 100.0]])
    pairs = voronoi_knn.needed_cells(centres, {0: (50, 2.0), 1: (50, 2.0), 2: (3, 2.0)}, {0: 1.0, 2: 1.0}, 5)
    assert (0, 0) in pairs and (0, 1) not in pairs and (0, 2) not in pairs
    assert {c for q, c in pairs if q == 2} == {0, 1, 2}


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, [1.0]), (1, [2.0])], [(3, [1.0])], [(0, [1e300, 1.0]), (1, [1e18, -1.0]), (2, [1e9, 2.0])]])
def test_small_tables(spark, rows):
    check(spark, rows)
