"""Queries over all rows of the smallest tables, against plain versions."""

import math

import numpy as np

from aerolith.plans import catalog

DATA = "/root/testdata/sf0.001"


def test_queries_at_all_fixes(spark):
    tracks: dict = {}
    for r in catalog.fixes(spark, DATA).orderBy("flight_id", "seq").collect():
        tracks.setdefault(r.flight_id, []).append((r.seq, r.t, r.alt))
    between, nearest = {}, {}
    for f, rows in tracks.items():
        t, alt = [r[1] for r in rows], [r[2] for r in rows]
        for seq in (r[0] for r in rows):
            q = seq * 1.7 - 3.0
            between[f, round(q, 6)] = float(np.interp(q, t, alt))
            nearest[f, round(q, 6)] = min(zip(t, alt), key=lambda x: (abs(x[0] - q), x[0]))[1]
    got = {(r.flight_id, r.q): r.alt for r in catalog.QUERIES["interpolation_join"](spark, DATA).collect()}
    assert got.keys() == between.keys() and all(math.isclose(got[k], between[k], abs_tol=2e-6) for k in got)
    assert {(r.flight_id, r.q): r.alt for r in catalog.QUERIES["nearest_fix_join"](spark, DATA).collect()} == nearest
    assert catalog.QUERIES["gps_fusion"](spark, DATA).count() == sum(map(len, tracks.values()))


def test_nearest_of_all_points(spark):
    p = catalog.cloud(spark, DATA).select("point_id", "x", "y", "z", "classification").collect()
    left = {tuple(r)[:4] for r in p if r.classification == 6}
    right = np.array([tuple(r)[1:4] for r in p if r.classification == 2])
    want = []
    for i, *at in left:
        d = float(np.sqrt(((right - at) ** 2).sum(1)).min())
        want.append((i, at[0], round(at[1], 6), round(at[2], 6), d if d < 1.5 else None))
    got = [tuple(r) for r in catalog.QUERIES["nearest_within"](spark, DATA).collect()]
    key = lambda r: r[:4]
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [key(r) for r in got] == [key(r) for r in want] and any(r[4] is None for r in want)
    assert all(a[4] is b[4] is None or math.isclose(a[4], b[4], abs_tol=2e-6) for a, b in zip(got, want))


def test_rasters_of_all_points(spark):
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    points = catalog.cloud(spark, DATA).select("x", "y").collect()
    cells = {(math.floor(x), math.floor(y / 2.0)) for x, y in points}
    grow = lambda s: {(x + a, y + b) for x, y in s for a, b in near}
    shrink = lambda s: {c for c in grow(s) if all((c[0] + a, c[1] + b) in s for a, b in near)}
    rows = lambda name, *c: sorted(tuple(r[k] for k in c) for r in catalog.QUERIES[name](spark, DATA).collect())
    assert rows("raster_close", "ix", "iy") == sorted(shrink(grow(cells)))
    assert rows("raster_open", "ix", "iy") == sorted(grow(shrink(cells))) != []
    want, left = [], set(cells)
    while left:
        todo, part = [left.pop()], []
        while todo:
            part.append(c := todo.pop())
            new = {(c[0] + a, c[1] + b) for a, b in near} & left
            left -= new
            todo += new
        want += [(*c, *min(part)) for c in part]
    assert rows("raster_components", "ix", "iy", "cx", "cy") == sorted(want)
