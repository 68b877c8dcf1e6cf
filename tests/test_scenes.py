"""Cameras, gap candidates and buildings on small cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.operators import buildings as B
from aerolith.operators import cameras as C
from aerolith.operators import clouds

SHOT = "shot long, rx double, ry double, rz double, tx double, ty double, tz double, kind string, width int, height int, focal double, focal_x double, focal_y double, c_x double, c_y double, k1 double, k2 double, k3 double, p1 double, p2 double"


def shot(n=0, r=(0.0, 0.0, 0.0), t=(0.0, 0.0, 0.0), **k):
    c = {"kind": "perspective", "width": 400, "height": 400, "focal": 0.5, "focal_x": None, "focal_y": None, "c_x": None, "c_y": None, "k1": 0.0, "k2": 0.0, "k3": None, "p1": None, "p2": None} | k
    return (n, *map(float, r), *map(float, t), *c.values())


def test_poses_and_projection(spark):
    r = (0.3, -0.2, 0.5)
    angle = math.sqrt(sum(v * v for v in r))
    k = np.array([[0, -r[2], r[1]], [r[2], 0, -r[0]], [-r[1], r[0], 0]]) / angle
    m = np.eye(3) + math.sin(angle) * k + (1 - math.cos(angle)) * k @ k
    t = np.array([1.0, 2.0, 30.0])
    shots = spark.createDataFrame([shot(0), shot(1, r, t)], SHOT)
    got = {p.shot: p for p in C.with_pose(shots).collect()}
    assert np.allclose([[got[1][f"r{i}{j}"] for j in range(3)] for i in range(3)], m) and np.allclose([got[1][f"c{a}"] for a in "xyz"], -m.T @ t) and got[0].r00 == 1.0
    points = spark.createDataFrame([(1, 0.0, 0.0, 10.0), (2, 1.0, -2.0, 10.0), (3, 0.0, 0.0, 0.4), (4, 0.0, 0.0, -5.0), (5, 100.0, 0.0, 10.0)], "point_id long, x double, y double, z double")
    seen = {(p.point_id, p.shot): p for p in C.in_view(points, shots).collect()}
    assert {i for i, s in seen if s == 0} == {1, 2} and (seen[1, 0].u, seen[1, 0].v) == (199.5, 199.5) and math.isclose(seen[2, 0].u, 0.5 * 0.1 * 400 - 0.5 + 200)
    q = m @ np.array([1.0, -2.0, 10.0]) + t
    assert math.isclose(seen[2, 1].u, 0.5 * q[0] / q[2] * 400 - 0.5 + 200) and math.isclose(seen[2, 1].depth, q[2])
    cells = spark.createDataFrame([(1, 7, 9, 12.0)], "shot long, col long, row long, depth double")
    back = C.back_projected(cells, shots, 2).first()
    again = C.in_view(spark.createDataFrame([(9, back.x, back.y, back.z)], "point_id long, x double, y double, z double"), shots).where("shot = 1").first()
    assert math.isclose(again.u, 15.0, abs_tol=1e-9) and math.isclose(again.v, 19.0, abs_tol=1e-9) and math.isclose(again.depth, 12.0)
    assert C.in_view(points.limit(0), shots).count() == 0


def test_votes(spark):
    points = spark.createDataFrame([(i, 2) for i in range(4)], "point_id long, classification int")
    votes = spark.createDataFrame([(0, 4), (0, 4), (0, 6), (1, 4), (1, 6), (1, 6), (1, 4), (2, 10), (2, 10), (2, 0), (2, 5)], "point_id long, cls int")
    got = {r.point_id: (r.views, r.cls, r.classification) for r in C.classified(points, votes).collect()}
    assert got == {0: (3, 4, 6), 1: (4, 4, 6), 2: (4, None, 2), 3: (0, None, 2)}


def test_letterbox(spark):
    rows = [("a", i, 5.0 if i < 20 or i >= 90 else 80.0) for i in range(100)] + [("b", i, 5.0 if i == 0 else 80.0) for i in range(100)] + [("c", i, 1.0) for i in range(10)]
    got = {r.axis: (r.first, r.end) for r in C.lit_span(spark.createDataFrame(rows, "axis string, i long, value double"), "axis").collect()}
    assert got == {"a": (22, 88), "b": (0, 100), "c": (0, 10)}


def test_depth_fits_and_gaps(spark):
    near = [(0, c, r, 10.0 + (c * 7 + r * 3) % 20) for c in range(0, 20) for r in range(10)] + [(1, 0, 0, 5.0)]
    df = spark.createDataFrame(near, "shot long, col long, row long, depth double")
    guessed = df.select("shot", "col", "row", ((1 / F.col("depth") - 0.01) / 0.5).alias("guess"))
    far = spark.createDataFrame([(0, 30, 4, (1 / 15.0 - 0.01) / 0.5), (0, 32, 4, (1 / 80.0 - 0.01) / 0.5), (0, 31, 4, 0.1)], "shot long, col long, row long, guess double")
    fit = C.depth_fits(df, guessed, 100).collect()
    assert len(fit) == 1 and math.isclose(fit[0].slope, 0.5, abs_tol=1e-9) and fit[0].used and fit[0].error < 1e-9
    labels = spark.createDataFrame([(0, c, 4, k) for c, k in ((18, 1), (21, 1), (24, 10), (30, 1), (31, 1), (32, 4))], "shot long, col long, row long, cls int")
    cells = C.gap_cells(labels, df, 2)
    assert sorted((r.col, r.row) for r in cells.collect()) == [(30, 4), (32, 4)]
    got = C.gap_points(cells, far, C.depth_fits(df, guessed, 100)).collect()
    assert [r.col for r in got] == [30] and math.isclose(got[0].depth, 15.0, abs_tol=1e-6)


def test_rectangles_and_footprints(spark):
    assert np.allclose(B.smallest_rectangle(np.array([0.0, 4, 4, 0]), np.array([0.0, 0, 2, 2])), (2, 1, 4, 2))
    c, s = math.cos(0.4), math.sin(0.4)
    x, y = np.array([0.0, 6, 6, 0, 3]), np.array([0.0, 0, 2, 2, 1])
    assert np.allclose(B.smallest_rectangle(x * c - y * s, x * s + y * c)[2:], (6, 2))
    assert np.allclose(B.smallest_rectangle(np.array([1.0]), np.array([2.0])), (1, 2, 0, 0))
    cells = spark.createDataFrame([(i, j, 1) for i in range(8) for j in range(4)] + [(20 + i, 0, 2) for i in range(8)] + [(20, j, 2) for j in range(1, 8)], "ix long, iy long, label int")
    got = {r.label: r for r in B.footprints(cells, 0.5).collect()}
    assert (got[1].area, got[1].length, got[1].width, got[1].fill) == (8.0, 4.0, 2.0, 1.0) and (got[1].centre_x, got[1].mean_y) == (2.0, 1.0) and got[2].fill < 0.5
    best = {r.label: r.best for r in B.nearest_building(B.footprints(cells, 2.0), 45.0, 8.0).collect()}
    assert best == {1: True, 2: False}


def test_grey_opening(spark):
    rng = np.random.default_rng(2)
    h = rng.integers(0, 50, size=(13, 17)).astype(float)
    gone = rng.random(h.shape) < 0.2
    rows = [(i, j, float(h[i, j])) for i in range(13) for j in range(17) if not gone[i, j] or (i, j) in ((0, 0), (12, 16))]
    full = np.full(h.shape, 1e6)
    for i, j, v in rows:
        full[i, j] = v
    win = lambda a, i, j, f: f(a[max(0, i - 2) : i + 3, max(0, j - 2) : j + 3])
    low = np.array([[win(full, i, j, np.min) for j in range(17)] for i in range(13)])
    want = np.array([[win(low, i, j, np.max) for j in range(17)] for i in range(13)])
    got = {(r.ix, r.iy): r.ground for r in B.opened_heights(spark.createDataFrame(rows, "ix long, iy long, top double"), "top", 2).collect()}
    assert got == {(i, j): want[i, j] for i in range(13) for j in range(17)}


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(1500, 3)) * 0.05, rng.uniform(-20, 20, size=(300, 3)), [[500.0, 0, 0]]])
    rows = [(i, *map(float, p)) for i, p in enumerate(x)]
    got = clouds.neighbours(spark.createDataFrame(rows, "point_id long, x double, y double, z double"), 6, 0.5).collect()
    assert len(got) == len(x) and len({r.point_id for r in got}) == len(x)
    for r in got:
        d = np.sort(((x - x[r.point_id]) ** 2).sum(1))[:6]
        mine = np.array([((p.x - r.x) ** 2 + (p.y - r.y) ** 2 + (p.z - r.z) ** 2) for p in r.near])
        assert np.allclose(mine, d) and (np.diff(mine) >= 0).all()


def test_long_chains_of_matches(spark):
    pairs = [(i, i, 1.0 - i / 1000) for i in range(100)] + [(i, i + 1, 1.0 - i / 1000 - 0.0005) for i in range(99)]
    got = clouds.greedy_matches(spark.createDataFrame(pairs[:40] + pairs[100:139], "a long, b long, score double")).collect()
    assert {(r.a, r.b) for r in got} == {(i, i) for i in range(40)}


def test_meshes_seen_from_above(spark):
    roof = spark.createDataFrame([("r", i, *map(float, p)) for i, p in enumerate([(0, 3, 0), (9, 3, 0), (9, 3, 8), (0, 3, 8)])], "file string, id int, x double, y double, z double")
    ground = roof.withColumn("y", F.lit(0.0))
    assert B.upright(roof, ground) == ("y", 1.0) and B.upright(ground, roof) == ("y", -1.0)
    faces = spark.createDataFrame([("r", 0, [0, 1, 2, 3])], "file string, id int, corners array<int>")
    got = B.face_polygons(roof, faces, "y", 1.0).first()
    assert got.z == 3.0 and [(p.x, p.y) for p in got.ring] == [(0, 0), (9, 0), (9, 8), (0, 8)]


def test_too_many_shots(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_SHOTS", 1)
    with pytest.raises(ValueError):
        C.in_view(spark.createDataFrame([(1, 0.0, 0.0, 10.0)], "point_id long, x double, y double, z double"), spark.createDataFrame([shot(0), shot(1)], SHOT))
