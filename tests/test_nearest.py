"""Searches among dense and copied points, against plain versions."""

import math

import numpy as np

from aerolith.operators import buildings, points


def brute(x, rank, own, k, reach):
    d = np.zeros((len(own), len(x)))
    for j in range(3):
        d += (own[:, j, None] - x[None, :, j]) ** 2
    near = np.array([np.lexsort((rank, row))[:k] for row in d])
    sure = np.take_along_axis(d, near, 1)[:, -1] <= reach * reach
    return np.where(sure[:, None], near, -1), sure


def test_nearest_in_cells():
    rng = np.random.default_rng(1)
    lines = np.stack([rng.integers(0, 4, 3000), rng.random(3000) * 9, rng.integers(0, 3, 3000)], 1).astype(float)
    dense = np.concatenate([rng.normal(0, 1e-4, (2000, 3)), rng.normal(5, 3, (300, 3)), np.zeros((50, 3))])
    for x in (lines, dense, np.ones((40, 3)), lines[:3]):
        own = np.concatenate([x[::7], rng.random((60, 3)) * 12 - 2])
        for k in (1, 5):
            if len(x) >= k:
                rank = rng.permutation(len(x))
                for reach in (0.2, 2.0):
                    got, want = points.nearest_in_cells(x, rank, own, k, reach), brute(x, rank, own, k, reach)
                    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_copies_ask_once(spark, monkeypatch):
    asked = []
    plain = points.nearest_in_cells
    monkeypatch.setattr(points, "nearest_in_cells", lambda x, rank, own, *a, **b: asked.append(len(own)) or plain(x, rank, own, *a, **b))
    own, back = points.distinct_rows(np.repeat([[1.0, 2.0, 3.0], [0.0, 5.0, 1.0]], 5000, axis=0))
    assert len(own) == 2 and len(back) == 10_000 and len(set(back.tolist())) == 2
    rows = spark.range(6000).selectExpr("id as point_id", "cast(id % 2 as double) as x", "0.0D as y", "0.0D as z")
    right = spark.range(6000).selectExpr("cast(id % 3 as double) / 1000 + 0.25 as x", "0.0D as y", "0.0D as z")
    got = points.nearest_within(rows, right, 0.5).groupBy("d").count().collect()
    assert sorted((r.d, r["count"]) for r in got if r.d is not None) == [(0.25, 3000)] and sum(r["count"] for r in got) == 6000


def test_kinds_and_far_points(spark):
    own = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 5000.0, 0.0, 0.0), (3, None, 0.0, 0.0), (4, float("nan"), 0.0, 0.0)], "point_id long, x double, y double, z double")
    surfaces = spark.createDataFrame([("roof", 1.0, 0.0, 0.0), ("wall", -1.0, 0.0, 0.0), ("wall", 1.0, 0.0, 0.0), ("door", 0.1, 0.0, 0.0)], "kind string, x double, y double, z double")
    near = buildings.nearest_kind(own.where("point_id < 3"), surfaces, 1.5)
    assert [tuple(r) for r in near.collect()] == [(1, "wall", 1.0)]
    far = {r.point_id: r.d for r in buildings.nearest_anywhere(own, surfaces, 0.5).collect()}
    assert far == {1: 0.1, 2: 4999.0, 3: None, 4: None}
    assert {r.d for r in buildings.nearest_anywhere(own, surfaces.where("x > 9"), 0.5).collect()} == {None}
    stats = buildings.surface_stats(spark.createDataFrame([("roof", 0.1), ("roof", 0.4), ("wall", 2.0)], "kind string, d double"))
    assert sorted(tuple(r) for r in stats.collect()) == [("roof", 2, 0.25, 0.37, 0.5, 1.0), ("wall", 1, 2.0, 2.0, 0.0, 0.0)]
    assert math.isclose(points.first_reach(own.where("point_id < 3"), 2.0), 2.0)
