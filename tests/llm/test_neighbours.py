"""Vantage-point trees with the fitted factor, over several shards, against brute force."""

import numpy as np
import pytest

from pulseloom.llm import neighbours

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from recall import measured  # noqa: E402


def _structured(rng, n, inner=5, width=48):
    points = rng.normal(size=(n, inner)) @ rng.normal(size=(inner, width)) + 0.02 * rng.normal(size=(n, width))
    return points / np.linalg.norm(points, axis=1)[:, None]


def test_fitted_factor_prunes_and_finds():
    rng = np.random.default_rng(3)
    recall, share, factors = measured(_structured(rng, 6000), 2000)
    assert recall >= 0.9 and share < 0.35 and min(factors) >= 1
    recall, share, _ = measured(rng.normal(size=(6000, 64)), 2000)  # no structure to use
    assert recall >= 0.9 and share <= 1


def test_factor_one_is_exact():
    rng = np.random.default_rng(4)
    points = _structured(rng, 3000)
    points[500:1400] = points[499]  # copies cannot be split
    recall, share, _ = measured(points, 1000, factor=1.0)
    assert recall == 1 and share < 1


def test_report_over_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 400)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    points = _structured(np.random.default_rng(6), 1500)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = neighbours.report(df).collect()
    by_query: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == list(range(0, 1500, 20))
    found = 0
    for q, rows in by_query.items():
        scores = [sum(a * b for a, b in zip(points[q].tolist(), points[r.vec_id].tolist())) for r in rows]
        assert [r.rank for r in rows] == list(range(1, 21)) and [r.score for r in rows] == pytest.approx(scores, rel=1e-12)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        true = points @ points[q]
        true[q] = -np.inf
        found += len(set(np.argsort(-true)[:20].tolist()) & {r.vec_id for r in rows})
    assert found >= 0.9 * 20 * len(by_query)
    exact = neighbours.report(df, factor=1.0).select("query_id", "vec_id").collect()
    truth = points[::20] @ points.T
    truth[np.arange(75), np.arange(0, 1500, 20)] = -np.inf
    assert {(r.query_id, r.vec_id) for r in exact} == {
        (20 * i, int(j)) for i, row in enumerate(truth) for j in np.argsort(-row)[:20]}


def test_few_candidates_and_clashing_columns(spark):
    rows = [(0, [1.0, 0.0], 1, "a"), (20, [0.0, 2.0], 2, "b"), (3, [1.0, 1.0], 3, "c"), (40, [1.0, 1.0, 1.0], 4, "d")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part long, path string")
    got = [tuple(r) for r in neighbours.report(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 2.0), (20, 2, 0, 0.0)]
