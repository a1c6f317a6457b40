"""Exact inner-product top k by a pivot-distance index.

Components are turned into integers, floor(scale * x). To make the inner product a distance, every vector x gets one more
component sqrt(M^2 - |x|^2), M the largest norm, and a query gets 0 there; then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>, and the
nearest vectors are those with the highest products.

*Index.* ``PIVOTS`` pivots are picked from a sample of about ``SAMPLE`` vectors, each farthest from those before it.
Every vector is keyed by its nearest pivot (cell) and its distance to it. Cells are cut into blocks by a hash of the
id, so a frequent vector spreads over many blocks.

*Search.* A query starts with the k-th best product among the sample as a bound, which gives a radius. Cells whose
annulus of distances the triangle inequality puts outside the radius are not visited. In a block, rows are taken in
rings of growing difference between their pivot distance and the query's; the radius shrinks with the k-th best so
far, and the search stops when the next ring lies outside it. Queries are blocked too; a task holds one block of
each. Only candidates that meet the bound are written, at most k of a visit, and merged by rank.

A block of the index is sent to the blocks of queries that visit it, once each.

The search is exact: bounds are tested with a slack above rounding, products are integers (in 64 bits).

Vectors that are null or hold a null or non-finite component take no part. Shorter vectors count as filled up with
zeros. Ties go to the smaller id. A row is no candidate for a query of its own id; repeated rows are candidates each.
If an id repeats, the smallest of its vectors asks. Fewer than k others: all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebridge.llm.tables import staged

PIVOTS = 48
SAMPLE = 2_048
RING = 256
QUERY_BLOCK = 4_096
#: Rows of an index block: a 64th of the rows, within these bounds.
BLOCK_LEAST, BLOCK_MOST = 256, 32_768


def integer_vectors(embeddings: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id`` and ``v`` (longs) of the rows that take part."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.where(x.isNotNull() & F.col(id_col).isNotNull()).where(finite)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an integer matrix, short rows filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact products: in floating point (BLAS) where every partial sum is an exact integer, in 64-bit integers elsewhere."""
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, rows.shape[1])
    if largest < 2**52:
        return np.rint(rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return rows @ q


class Pivots:
    """Pivots and sample, with the distances of vectors and queries to the pivots."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float) -> None:
        self.ids, self.vectors, self.norm = ids, vectors, norm
        lifted = self.lift(vectors)
        chosen = [0] if len(ids) else []
        far = np.full(len(ids), np.inf)
        while chosen and len(chosen) < PIVOTS:
            far = np.minimum(far, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
            if far.max() <= 0:
                break
            chosen.append(int(far.argmax()))
        self.points = lifted[chosen]

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (x**2).sum(axis=1)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1) - 2 * lifted @ self.points.T
        return np.sqrt(np.maximum(0.0, square))

    def query_distances(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(np.float64)
        return self.distances(np.concatenate([x, np.zeros((len(x), 1))], axis=1))

    def radius(self, q: np.ndarray, bound: float) -> float:
        """Distance beyond which no product reaches the bound, with slack for rounding of all distances involved."""
        square = float((q.astype(np.float64) ** 2).sum()) + self.norm**2
        slack = 1e-6 * (1 + self.norm + np.sqrt(square))
        return float(np.sqrt(max(0.0, square - 2 * bound))) + slack if np.isfinite(bound) else np.inf


def kth_best(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def search_block(ids: np.ndarray, rows: np.ndarray, dist: np.ndarray, own: int, q: np.ndarray, at: float, bound: float, k: int, radius: Callable[[np.ndarray, float], float]) -> tuple[np.ndarray, np.ndarray]:
    """Up to k best rows (ids, products) that meet the bound, ring by ring; ``dist`` ascending, ``at`` the query's distance to the pivot."""
    reach = radius(q, bound)
    low, high = np.searchsorted(dist, at - reach), np.searchsorted(dist, at + reach, side="right")
    gap = np.abs(dist[low:high] - at)
    order = low + np.argsort(gap, kind="stable")
    gap = np.sort(gap, kind="stable")
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i in range(0, len(order), RING):
        if gap[i] > reach:
            break
        ring = order[i : i + RING]
        ring = ring[ids[ring] != own]
        scores = _products(rows[ring], q)
        keep = scores >= bound
        best_ids, best = np.concatenate([best_ids, ids[ring][keep]]), np.concatenate([best, scores[keep]])
        first = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[first], best[first]
        if len(best) == k and best[-1] > bound:
            bound = float(best[-1])
            reach = radius(q, bound)
    return best_ids, best


def top_k(embeddings: DataFrame, asks: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``asks`` (on ``vec_id``) holds, the k others with the highest products."""
    spark = embeddings.sparkSession
    rows = staged(integer_vectors(embeddings, id_col, vec_col, scale), "vectors")
    square = F.aggregate(F.transform("v", lambda c: c.cast("double") * c.cast("double")), F.lit(0.0), lambda a, c: a + c)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("square"), F.count(F.when(asks, 1)).alias("asking")).first()
    total, width = facts["n"], facts["width"] or 0
    limit = int(min(1.0, SAMPLE / max(total, 1)) * (1 << 20))
    picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < limit).limit(4 * SAMPLE).toArrow().sort_by("vec_id")
    pivots = Pivots(picked.column("vec_id").to_numpy(), _matrix(picked.column("v"), width), float(np.sqrt(facts["square"] or 0.0)))
    if not len(pivots.points):  # so few rows that the sample came out empty: one cell around the origin
        pivots.points = np.zeros((1, width + 1))
    shared = spark.sparkContext.broadcast(pivots)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = shared.value.distances(shared.value.lift(_matrix(batch.column(1), width)))
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell], pa.float64())], names=["vec_id", "v", "cell", "dist"]
            )

    index = staged(rows.mapInArrow(key, "vec_id long, v array<long>, cell int, dist double"), "index")
    per_block = min(BLOCK_MOST, max(BLOCK_LEAST, ceil(total / 64)))
    cells = {  # a row for each pivot at most
        r["cell"]: (ceil(r["n"] / per_block), r["low"], r["high"])
        for r in index.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()
    }
    query_blocks = max(1, ceil(facts["asking"] / QUERY_BLOCK))
    queries = index.where(asks).groupBy("vec_id").agg(F.min("v").alias("v"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            asked = _matrix(batch.column(1), width)
            d = p.query_distances(asked)
            out: list[tuple[int, int, int, float, float]] = []
            for i, own in enumerate(batch.column(0).to_pylist()):
                bound = kth_best(_products(p.vectors, asked[i])[p.ids != own], k) if len(p.ids) else -np.inf
                reach = p.radius(asked[i], bound)
                for cell, (blocks, low, high) in cells.items():
                    if max(d[i, cell] - high, low - d[i, cell]) <= reach:
                        out += [(i, cell, b, float(d[i, cell]), bound) for b in range(blocks)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            at = pa.array(columns[0], pa.int64())
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True))],
                names=["query_id", "q", "cell", "block", "at", "bound"],
            )

    visits = queries.mapInArrow(visit, "query_id long, q array<long>, cell int, block int, at double, bound double")
    visits = staged(visits.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")), "visits")
    sizes = F.create_map(*[F.lit(x) for cell, (blocks, _, _) in cells.items() for x in (cell, blocks)]) if cells else None
    block = F.pmod(F.xxhash64("vec_id"), sizes[F.col("cell")]).cast("int") if cells else F.lit(0)
    # A block goes to the query blocks that visit it, and to no others.
    readers = visits.select(F.col("cell").alias("to_cell"), F.col("block").alias("to_block"), F.col("query_block").alias("reader")).distinct()
    placed = index.withColumn("block", block)
    blocked = placed.join(readers, (placed.cell == readers.to_cell) & (placed.block == readers.to_block)).select("vec_id", "v", "dist", "to_cell", "to_block", "reader")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        p = shared.value
        left = left.sort_by([("dist", "ascending"), ("vec_id", "ascending")])
        ids, matrix, dist = left.column("vec_id").to_numpy(), _matrix(left.column("v"), width), left.column("dist").to_numpy()
        asked = _matrix(right.column("q"), width)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids):
            for i, (own, at, bound) in enumerate(zip(*(right.column(c).to_pylist() for c in ("query_id", "at", "bound")), strict=True)):
                near, scores = search_block(ids, matrix, dist, own, asked[i], at, bound, k, p.radius)
                found.append((np.full(len(near), own, np.int64), near, scores))
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})

    near = blocked.groupBy("to_cell", "to_block", "reader").cogroup(visits.groupBy("cell", "block", "query_block")).applyInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
