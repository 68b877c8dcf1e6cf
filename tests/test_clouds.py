"""Cloud and footprint operators against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.operators import clouds


def frame(spark, xyz):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "point_id long, x double, y double, z double")


def test_neighbours_and_normals(spark):
    xyz = np.random.default_rng(1).uniform(0, 4, (150, 3))
    xyz[-1] = (20, 20, 20)  # far from all others: more rounds
    got = {r.point_id: [(p.x, p.y, p.z) for p in r.near] for r in clouds.neighbours(frame(spark, xyz), 6, 1.0).collect()}
    assert len(got) == 150
    for i, p in enumerate(xyz):
        want = xyz[np.argsort(np.linalg.norm(xyz - p, axis=1), kind="stable")[:6]]
        assert np.allclose(sorted(got[i]), sorted(map(tuple, want)))
    flat = np.c_[np.random.default_rng(2).uniform(0, 3, (40, 2)), np.zeros(40)]
    for r in clouds.normals(frame(spark, flat), 8, 1.0).collect():
        assert abs(abs(r.nz) - 1) < 1e-9 and abs(r.flatness) < 1e-9


def test_normals_of_copies_and_of_nothing(spark):
    assert clouds.normals(frame(spark, [(1, 1, 1)] * 3), 3, 1.0).where("flatness is null").count() == 3
    assert clouds.normals(frame(spark, []), 3, 1.0).count() == 0


def test_neighbours_of_copies(spark):
    xyz = [(0.0, 0.0, 0.0)] * 2 + [(1.0, 0.0, 0.0)] * 2000 + [(3.0, 0.0, 0.0)]
    got = clouds.neighbours(frame(spark, xyz), 4, 2.0).collect()
    assert len(got) == len(xyz)
    at = {}
    for r in got:
        at.setdefault(r.x, []).append([p.x for p in r.near])
    assert at[0.0] == [[0.0, 0.0, 1.0, 1.0]] * 2 and at[1.0] == [[1.0] * 4] * 2000 and at[3.0] == [[3.0, 1.0, 1.0, 1.0]]


def test_icp(spark):
    src = np.random.default_rng(3).uniform(0, 20, (200, 3))
    a = math.radians(0.4)
    rot = np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]])
    scale, r, t = clouds.icp(frame(spark, src), frame(spark, src @ rot.T + (0.2, -0.1, 0.05)), levels=(2.0,), rounds=4, least=50)
    assert scale == 1.0 and np.allclose(r, rot, atol=1e-6) and np.allclose(t, (0.2, -0.1, 0.05), atol=1e-5)
    _, r, t = clouds.icp(frame(spark, src), frame(spark, src + 500), levels=(2.0,), least=50)
    assert np.allclose(r, np.eye(3)) and np.allclose(t, 0)


@pytest.mark.parametrize("share", [0.1, 5.0])
def test_gap_fill(spark, share):
    rng = np.random.default_rng(4)
    have, new = rng.uniform(0, 5, (60, 3)), rng.uniform(0, 8, (300, 3))
    new[7] = new[3]
    seen, first = set(), []
    for i, p in enumerate(new):
        if (v := tuple(np.floor(p / 0.5))) not in seen:
            seen.add(v)
            first.append(i)
    near = [(float(np.linalg.norm(have - new[i], axis=1).min()), i) for i in first]
    want = sorted(x for x in near if 0.15 < x[0] < 1.5)[: int(share * 60)]
    got = clouds.gap_filled(frame(spark, have), frame(spark, new), voxel=0.5, share=share).collect()
    assert sorted(r.point_id for r in got) == sorted(i for _, i in want)


def test_greedy_matches(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b), float(s)) for a, b, s in zip(rng.integers(0, 12, 80), rng.integers(0, 12, 80), rng.integers(0, 9, 80))]
    want, used_a, used_b = [], set(), set()
    for s, a, b in sorted({(s, a, b) for a, b, s in pairs}, reverse=True):
        if a not in used_a and b not in used_b:
            used_a.add(a), used_b.add(b), want.append((a, b, s))
    got = clouds.greedy_matches(spark.createDataFrame(pairs, "a long, b long, score double"))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert clouds.greedy_matches(spark.createDataFrame([], "a long, b long, score double")).count() == 0


def test_union_keeps_unseen_points(spark):
    m, i = spark.createDataFrame([(1, 3)], "point_id long, views int"), spark.createDataFrame([(2,)], "point_id long")
    assert sorted(map(tuple, clouds.with_inferred(m, i).select("point_id", "views", "inferred").collect())) == [(1, 3, False), (2, 0, True)]


def test_polygon_of_two_corners_has_no_area(spark):
    df = spark.range(1).select(F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))).alias("ring"))
    assert df.select(clouds.polygon_area(F.col("ring"))).first()[0] is None


def test_photos_without_a_fix_are_kept(spark):
    rows = [(1, 0, 0.0, 10.0), (1, 1, 1.0, 10.0), (1, 2, None, 10.0), (1, 3, 1.0, 10.0), (1, 4, 9.0, 1.0), (1, 5, 9.0, None)]
    df = spark.createDataFrame(rows, "flight_id long, seq long, e double, sharpness double").withColumns({"n": F.lit(0.0), "u": F.lit(0.0)})
    got = [r.verdict for r in clouds.spaced_photos(df, 5.0).orderBy("seq").collect()]
    assert got == ["kept", "close", "kept", "kept", "blurry", "kept"]
