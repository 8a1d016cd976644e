"""Vector codes against all distances in plain Python."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from adperf.llm import vcodes


def brute(rows, parts=16, entries=64, rounds=2):
    fit = [
        (i, lab, [min(max(math.floor(256 * x), -(2**52)), 2**52) for x in v]) for i, v, lab in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not fit:
        return []
    width = max(1, -(-max(len(v) for _, _, v in fit) // parts)) * parts
    m = width // parts
    fit.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = [[tuple((v + [0] * (width - len(v)))[p * m : p * m + m]) for p in range(parts)] for _, _, v in fit]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            books[p] = [
                tuple(sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)) if e in groups else x
                for e, x in enumerate(books[p])
            ]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    labels: dict = {}
    for (_, lab, _), e in zip(fit, errors, strict=True):
        labels[lab] = labels.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    most = (1 << 63) - 1
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), min(err, most), min(labels[lab], most), digest)
         for (i, lab, _), f, err in zip(fit, found, errors, strict=True)), key=str)


def got(spark, rows, schema="vec_id long, embedding array<double>, label int", **options):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    return sorted((tuple(r) for r in vcodes.coded(vcodes.whole_vectors(frame), **options).collect()), key=str)


def test_embeddings_equal_brute_force(spark, tables):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in tables("embeddings")][:200]
    assert got(spark, rows, entries=16, block=8) == brute(rows, entries=16)


def test_small_blocks_chunks_and_a_hot_vector(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 12))
    rows = [(i, (centres[i % 5] + 0.3 * rng.normal(size=12)).tolist(), i % 3 or None) for i in range(240)]
    rows += [(1000 + i, rows[0][1], 7) for i in range(120)]  # a third are equal
    options = {"parts": 4, "entries": 10, "rounds": 3}
    assert got(spark, rows, block=5, chunk_numbers=12 * 37, **options) == brute(rows, **options)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], 1), (5, [], None),
        (6, [-1.0, 0.5, 3.0], None), (None, [9.0, 9.0], 2), (9, [1.0, 2.0], 2), (9, [1.0, -2.0], 2), (9, [1.0, 2.0], 2),
    ]
    options = {"parts": 2, "entries": 4}
    assert got(spark, rows, **options) == brute(rows, **options)
    # beyond 64 bits: exact while it fits, then the greatest long
    rows += [(10, [1e12, -1e12], 3), (11, [1e300, 5.0], 3), (12, [3e6, 3e6], 4)]
    assert got(spark, rows, **options) == brute(rows, **options)
    assert got(spark, rows, parts=16, entries=3) == brute(rows, entries=3)


def test_empty_tables_and_clashing_columns(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, 2)]) == []
    assert got(spark, [(1, [], 2), (2, [], 2)]) == brute([(1, [], 2), (2, [], 2)])
    schema = "vec_id long, embedding array<float>, label int, v array<double>, codes string, error int, ids int, n int"
    rows = [(i, [float(i), 1.0], i % 2, [0.0], "x", 1, 1, 1) for i in range(9)]
    assert got(spark, rows, schema, parts=2, entries=3) == brute([r[:3] for r in rows], parts=2, entries=3)


@pytest.mark.parametrize("dims", [1, 2, 3, 70])
def test_the_curve_visits_all_points_by_small_steps(dims):
    side = 8 if dims < 4 else 2
    axes = min(dims, 3)
    grid = np.stack(np.meshgrid(*[np.arange(side)] * axes, indexing="ij"), -1).reshape(-1, axes) * 1024
    points = np.zeros((len(grid), dims), np.int64)
    points[:, :axes] = grid
    order = vcodes.hilbert_order(points)
    assert sorted(order) == list(range(len(points)))
    if dims <= 3:
        steps = np.abs(np.diff(points[order], axis=0)).sum(1)
        assert (steps == 1024).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(4)
    points = rng.integers(-300, 300, (500, 3))
    part = vcodes.Part(points[vcodes.hilbert_order(points)], 16)
    entries = rng.integers(-300, 300, (20, 3))
    single, near = part.assign(entries)
    far = ((part.points[:, None] - entries[None]) ** 2).sum(2)
    assert (near == far.argmin(1)).all()
    assert vcodes.shortlists(part.low, part.high, entries).sum() < 0.7 * len(single) * len(entries)
    count, sums = part.tally(entries)
    assert count.sum() == 500 and (sums.sum(0) == points.sum(0)).all()
