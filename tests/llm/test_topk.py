"""Top k against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebridge.llm import topk


def brute_force(rows, asks, k, scale=1024):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in usable:
        if asks(i):
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def check(spark, schema, rows, modulus, k=10):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], schema)
    found = topk.top_k(df, F.pmod("vec_id", F.lit(modulus)) == 0, k=k)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, lambda i: i % modulus == 0, k)


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_random_vectors(spark, vector_schema, monkeypatch, hot):
    monkeypatch.setattr(topk, "SAMPLE", 100)
    monkeypatch.setattr(topk, "BLOCK_LEAST", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    monkeypatch.setattr(topk, "RING", 16)
    r = np.random.default_rng(9)
    vectors = r.normal(size=(1500, 12)) * r.choice([0.2, 1, 3], (1500, 1))
    vectors[r.random(1500) < hot] = vectors[0]
    check(spark, vector_schema, [(i, v.tolist()) for i, v in enumerate(vectors)], 20)


def test_edge_rows(spark, vector_schema):
    nan, inf = math.nan, math.inf
    rows = [(0, None), (10, [1.0, None]), (20, [nan, 1.0]), (30, [inf, 0.0]), (40, []), (50, [1.0, 2.0, 3.0]), (60, [1.0]), (60, [0.5, 4.0]), (7, [-1.0, 0.0]), (8, [-1.0, 0.0]), (8, [-1.0, 0.0])]
    check(spark, vector_schema, rows, 10)
    check(spark, vector_schema, rows, 10, k=2)
    check(spark, vector_schema, rows[:4], 10)
    check(spark, vector_schema, [], 10)
    check(spark, vector_schema, [(10, [0.0, 0.0]), (20, [0.0, 0.0])], 10)


def test_large_components_stay_exact(spark, vector_schema):
    r = np.random.default_rng(3)
    check(spark, vector_schema, [(i, v.tolist()) for i, v in enumerate(r.normal(size=(60, 3)) * 1e5)], 10)


def test_blocks_go_to_the_queries_that_visit_them(spark, vector_schema, monkeypatch):
    """Tight clusters far apart: with many query blocks, few copies of the index are sent."""
    monkeypatch.setattr(topk, "SAMPLE", 400)
    monkeypatch.setattr(topk, "BLOCK_LEAST", 50)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    sent = []
    original = topk.staged
    monkeypatch.setattr(topk, "staged", lambda df, name: sent.append((name, out := original(df, name))) or out)
    r = np.random.default_rng(1)
    centres = r.normal(size=(10, 8)) * 20
    rows = [(i, (centres[i % 10] + r.normal(size=8) / 50).tolist()) for i in range(2000)]
    check(spark, vector_schema, rows, 100, k=5)
    visits = dict(sent)["visits"]
    index = dict(sent)["index"]
    copies = visits.select("cell", "block", "query_block").distinct().count()
    assert index.count() == 2000 and copies < 5 * (2000 // 50) / 2  # of five blocks of queries times all blocks of the index


def test_rings_stop_early_and_lose_nothing():
    r = np.random.default_rng(2)
    p = topk.Pivots(np.arange(50), r.integers(-50, 50, (50, 4)), 120.0)
    rows = r.integers(-50, 50, (2000, 4))
    d = p.distances(p.lift(rows))[:, 0]
    order = np.argsort(d)
    q = r.integers(-50, 50, 4)
    at = p.query_distances(q[None])[0, 0]
    ids, scores = topk.search_block(order, rows[order], d[order], -1, q, at, -np.inf, 10, p.radius)
    best = sorted((-int(s), i) for i, s in enumerate(rows @ q))[:10]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True)] == best
