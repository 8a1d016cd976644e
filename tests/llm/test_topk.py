"""Top-k against all scores."""

from __future__ import annotations

import math

import numpy as np
import pytest

from adperf.llm import topk


def brute(rows, every, k=10):
    fit = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {i: tuple(v) for i, v in fit if i % every == 0}.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in fit if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(spark, rows, every, schema="vec_id long, embedding array<double>", **options):
    vectors = topk.whole_vectors(spark.createDataFrame(rows, schema).repartition(3))
    return sorted(tuple(r) for r in topk.search(
        vectors.filter(topk.every(vectors["vec_id"], every)), topk.build(vectors, **options)).collect())


def test_embeddings_equal_brute_force(spark, tables):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in tables("embeddings")]
    assert got(spark, rows, 20) == brute(rows, 20)


@pytest.mark.parametrize("first", [1, 64, 10_000])
def test_rounds_blocks_and_ties(spark, monkeypatch, first):
    monkeypatch.setattr(topk, "FIRST_ROWS", first)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=8)).tolist()) for i in range(600)]
    rows += [(600 + i, rows[0][1]) for i in range(300)]  # a third are equal
    assert got(spark, rows, 50, pivots=5, rings=4, block_rows=32) == brute(rows, 50)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []),
        (6, [-1.0, 0.5, 3.0]), (7, [0.5]), (None, [9.0, 9.0]), (8, [1e12, 1e12]), (100, [0.0, 0.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0]),
    ]
    assert got(spark, rows, 100) == brute(rows, 100)


def test_empty_table_and_no_queries(spark):
    assert got(spark, [], 100) == []
    assert got(spark, [(1, [1.0]), (2, [2.0])], 100) == []
    frame = spark.createDataFrame([(0, [1.0], 5, [2.0]), (1, [1.0], 5, [2.0])], "vec_id long, embedding array<float>, dist int, v array<double>")
    vectors = topk.whole_vectors(frame)
    assert [r.score for r in topk.search(vectors.filter("vec_id = 0"), topk.build(vectors)).collect()] == [1024 * 1024]


def clustered(n, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    return [(i, (centres[i % 6] + 0.5 * rng.normal(size=8)).tolist()) for i in range(n)]


def test_neither_queries_nor_rows_are_broadcast(spark, monkeypatch):
    """A row of packed queries holds many vectors, which Spark takes for a few bytes."""
    plans, stage = [], topk.stage

    def seen(df, name="part"):
        if name == "best":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(topk, "stage", seen)
    monkeypatch.setattr(topk, "FIRST_ROWS", 16)
    rows = clustered(400)
    assert got(spark, rows, 10, pivots=5, rings=4, block_rows=32) == brute(rows, 10)
    assert plans and all("Join" in p and "Broadcast" not in p for p in plans)


def test_queries_go_to_buckets_and_not_to_blocks(spark, monkeypatch):
    """What moves is each query once a bucket; blocks stay where they are stored."""
    monkeypatch.setattr(topk, "BUCKETS", 3)
    monkeypatch.setattr(topk, "BUCKET_BLOCKS", 32)
    vectors = topk.whole_vectors(spark.createDataFrame(clustered(900), "vec_id long, embedding array<double>"))
    index = topk.build(vectors, pivots=1, rings=1, block_rows=16)
    blocks = index.blocks.select("s", (topk.F.length("others") / 8).alias("n")).collect()
    assert sum(b.n for b in blocks) == 900 and max(b.n for b in blocks) <= 16 and len(blocks) >= 57
    assert len(index.keys) == 3 and {b.s for b in blocks} <= set(index.keys)
    slots = spark.createDataFrame([(k,) for k in index.keys], "k int").select(topk.F.pmod(topk.F.hash("k"), topk.F.lit(3))).distinct()
    assert slots.count() == 3  # each is alone in its bucket


@pytest.mark.parametrize("scale, kind", [(1.0, np.float32), (300.0, np.float64), (3e5, np.int64)])
def test_products_are_exact_in_every_type(monkeypatch, scale, kind):
    monkeypatch.setattr(topk, "TILE", (16, 8))
    monkeypatch.setattr(topk, "PART", 4)
    rng = np.random.default_rng(3)
    y = (rng.integers(-900, 900, size=(200, 4)) * scale).astype(np.int64)
    y[50:120] = y[7]  # more equal rows than a tile has
    others = np.repeat(np.arange(100), 2)  # each id twice
    ids = np.array([3, 7, 30, 250])
    x = y[[6, 14, 60, 9]]
    longest = float(np.sqrt((y.astype(float) ** 2).sum(1).max()))
    met = topk._Met(ids, x, np.full(4, topk.LOWEST), np.ones((4, 1), bool), longest, 5)
    assert met.kind == kind
    for at in (0, 40, 130):
        upto = {0: 40, 40: 130, 130: 200}[at]
        met.meet(0, others[at:upto], y[at:upto])
    found = met.best().to_pydict()
    want = []
    for i, q in zip(ids.tolist(), x.tolist(), strict=True):
        scores = sorted((-sum(a * b for a, b in zip(q, r, strict=True)), o) for o, r in zip(others.tolist(), y.tolist(), strict=True) if o != i)
        want += [(i, o, -s) for s, o in scores[:5]]
    assert sorted(zip(*found.values(), strict=True)) == sorted(want)
