"""Exact top-k inner products by a Voronoi join.

Vectors are filed in the cells of their nearest pivots, as packed blocks. Each
cell is summed up by its size and radius. For a pair of a query cell and a
data cell these bound the inner products from both sides: the lower bounds of
the cells that together hold enough vectors give a threshold, and a data cell
is joined only to the query cells whose upper bound reaches it. Each block
pair is solved on its own; the best of all pairs are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .arrow import record_batch

SCALE = 256
K = 5
MAX_PIVOTS = 256     # so many rows of pivots and summaries at most reach the driver
CELL_ROWS = 4096     # rows a cell should hold while pivots last
BLOCK_ROWS = 2048    # rows of one packed block
EXACT = float(1 << 21)  # components up to here have exact products as doubles, for up to 2,000 dimensions


def quantized(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and v, floor(scale * component) as doubles; only whole vectors of finite numbers that have an id."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    return rows.where(~bad).select("vec_id", F.transform("v", lambda x: _floor(x * float(scale))).alias("v"))


def _floor(x: Column) -> Column:
    """The floor as a double, also beyond the range of a long."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def _matrix(rows, dims: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    out = np.zeros((len(rows), dims))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _blocks(rows: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """Packed blocks: cell, is_query, n, radius, uids, ids, vectors."""
    schema = pa.schema([("cell", pa.int32()), ("is_query", pa.bool_()), ("n", pa.int64()), ("radius", pa.float64()), ("uids", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        half = (pivots ** 2).sum(axis=1) / 2
        held: dict[tuple, list] = {}

        def packed(key: tuple, parts: list) -> pa.RecordBatch:
            uids, ids, vectors, far = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(ids, kind="stable")
            return record_batch(
                schema, cell=[key[0]], is_query=[key[1]], n=[len(ids)], radius=[far.max()],
                uids=[uids[order].tobytes()], ids=[ids[order].tobytes()], vectors=[vectors[order].tobytes()],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                v = _matrix(piece.column("v").to_pylist(), dims)
                ids, asked = piece.column("vec_id").to_numpy(), piece.column("is_query").to_numpy(zero_copy_only=False)
                uids = (np.int64(part) << 40) + count + np.arange(len(ids))
                count += len(ids)
                cell = (v @ pivots.T - half).argmax(axis=1)
                far = np.sqrt(((v - pivots[cell]) ** 2).sum(axis=1))
                for c in np.unique(cell):
                    for query in (False, True):
                        own = np.flatnonzero((cell == c) & (asked | (not query)))
                        if len(own):
                            parts = held.setdefault((int(c), query), [])
                            parts.append((uids[own], ids[own], v[own], far[own]))
                            if sum(len(p[1]) for p in parts) >= BLOCK_ROWS:
                                yield packed((int(c), query), held.pop((int(c), query)))
        for key, parts in held.items():
            yield packed(key, parts)

    return rows.mapInArrow(assign, "cell int, is_query boolean, n long, radius double, uids binary, ids binary, vectors binary")


def needed_cells(pivots: np.ndarray, data: dict[int, tuple[int, float]], queries: dict[int, float], k: int) -> list[tuple[int, int]]:
    """Pairs of query cell and data cell that can hold one of the best ``k``.

    ``data`` has the size and radius of each cell, ``queries`` the radius of
    its queries. With p, c the pivots and u, r the radii, inner products lie
    within u |c| + |p| r + u r of <p, c>. One vector more than ``k`` is asked
    for, because a query is no candidate of its own.
    """
    out = []
    cells = sorted(data)
    centres = pivots[cells]
    norms, radii = np.linalg.norm(centres, axis=1), np.array([data[c][1] for c in cells])
    sizes = np.array([data[c][0] for c in cells])
    for q, u in queries.items():
        middle = centres @ pivots[q]
        reach = u * norms + np.linalg.norm(pivots[q]) * radii + u * radii
        reach += 1e-6 * (1 + np.abs(middle) + reach)  # rounding
        low, high = middle - reach, middle + reach
        order = np.argsort(-low)
        enough = np.flatnonzero(np.cumsum(sizes[order]) > k)
        least = low[order[enough[0]]] if len(enough) else -np.inf
        out += [(q, c) for c, h in zip(cells, high) if h >= least]
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= EXACT and a.shape[1] <= 2000:
        return (a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(y) for y in row] for row in x], object).reshape(x.shape)
    return np.clip(whole(a) @ whole(b).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest scores; ties go to the first columns."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, column = np.nonzero(scores >= least[:, None])
    else:
        row, column = np.nonzero(np.ones(scores.shape, bool))
    order = np.lexsort((column, -scores[row, column].astype(float), row)) if np.abs(scores).max(initial=0) < 1 << 53 else np.array(sorted(range(len(row)), key=lambda i: (row[i], -int(scores[row[i], column[i]]), column[i])), np.int64)
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def top_k(vectors: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` highest integer inner products with other rows.

    ``is_query`` is a condition on vec_id.

    Ties go to the smaller vec_id. Vectors that are null, or hold a null or a
    non-finite component, and rows without an id take no part. A shorter vector
    counts as filled up with zeros. A row that repeats a query's id is a
    candidate like any other. Scores beyond the range of a long are cut to it.
    """
    spark = vectors.sparkSession
    rows = quantized(vectors, vector, scale).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    size = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not size[0]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(size[1], 1)
    wanted = min(MAX_PIVOTS, max(1, size[0] // CELL_ROWS))
    pivots = np.unique(_matrix([r.v for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()], dims), axis=0)
    blocks = pin(_blocks(rows, pivots, dims))
    data, queries = {}, {}
    for r in blocks.groupBy("cell", "is_query").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect():
        if r.is_query:
            queries[r.cell] = r.radius
        else:
            data[r.cell] = (r.n, r.radius)
    pairs = spark.createDataFrame(needed_cells(pivots, data, queries, k), "q_cell int, cell int")
    asking = blocks.where("is_query").select(F.col("cell").alias("q_cell"), F.col("uids").alias("q_uids"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    joined = asking.join(F.broadcast(pairs), "q_cell").join(blocks.where("not is_query").select("cell", "uids", "ids", "vectors"), "cell")
    schema = pa.schema([("uid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda x, kind: np.frombuffer(x.as_py(), kind)
        for batch in batches:
            for q_uids, q_ids, q_vectors, uids, ids, packed in zip(*(batch.column(c) for c in ("q_uids", "q_ids", "q_vectors", "uids", "ids", "vectors"))):
                q_uids, q_ids, uids, ids = (numbers(x, np.int64) for x in (q_uids, q_ids, uids, ids))
                scores = _scores(numbers(q_vectors, float).reshape(-1, dims), numbers(packed, float).reshape(-1, dims))
                # One more than k, as the query's own row may be among them.
                row, column = best(scores, k + 1)
                other = q_uids[row] != uids[column]
                row, column = row[other], column[other]
                yield record_batch(schema, uid=q_uids[row], query_id=q_ids[row], vec_id=ids[column], score=scores[row, column])

    found = joined.select("q_uids", "q_ids", "q_vectors", "uids", "ids", "vectors").mapInArrow(solve, "uid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def check_sql(k: int = K, scale: int = SCALE, every: int = 50) -> str:
    """DuckDB SQL for ``top_k`` with the ids divisible by ``every`` as queries, for rows with different ids and vectors of one length."""
    return f"""
with v as (select vec_id, list_transform(embedding, lambda x: floor({scale} * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % {every} = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= {k}"""
