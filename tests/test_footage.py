"""Keyframes, segments, flights and coverage on small cases."""

import pytest

from aerolith.operators import tracks as T


def cands(spark, rows):
    return spark.createDataFrame([("v", i * 6, float(t), float(s), d, 0) for i, (t, s, d) in enumerate(rows)], "shot_key string, frame long, t double, sharpness double, shift double, shot long")


def kept(spark, rows, **k):
    got = T.keyframes(cands(spark, rows), **k).orderBy("frame").collect()
    return [r.frame // 6 for r in got if not r.blurry], [r.frame // 6 for r in got if r.blurry], sum(r.gap_before for r in got)


def test_keyframes(spark):
    assert kept(spark, [(0, 50, 0.0), (0.2, 50, 0.05), (0.4, 50, 0.05)])[0] == [0, 2]
    assert kept(spark, [(0, 200, 0.0), (0.2, 200, 0.1), (0.4, 10, 0.1)], blur=0.35)[1] == [2]
    assert kept(spark, [(0.2 * i, 50, 0.5) for i in range(4)])[2] == 3
    assert kept(spark, [(0, 50, 0.0), (0.2, 60, 0.09)])[0] == [1]
    assert kept(spark, [(0, 50, 0.0), (0.2, 60, None)])[0] == [0, 1]
    assert kept(spark, [(0, 50, 0.0), (5, 60, None)])[::2] == ([0, 1], 0)
    # a gap is counted between kept frames, so a blurry one between does not hide it
    assert kept(spark, [(0, 200, 0.0), (0.2, 10, 0.2), (0.4, 200, 0.2), (0.6, 200, 0.0)], blur=0.35)[2] == 1
    with pytest.raises(ValueError):
        T.keyframes(cands(spark, [(0, 1, 0.0)]), min_shift=0.0)


def test_segments(spark):
    c = cands(spark, [(0, 1, 0.0)] * 4).drop("shot")
    cuts = spark.createDataFrame([("v", f) for f in (0, 7, 8, 18, 99)], "shot_key string, frame long")
    assert [r.shot for r in T.split_at_cuts(c, cuts).orderBy("frame").collect()] == [0, 0, 1, 2]
    assert T.split_at_cuts(c.limit(0), cuts).count() == 0
    assert [r.frame for r in T.segment_choice(T.split_at_cuts(c, cuts), "longest").orderBy("frame").collect()] == [0, 6]
    assert [r.frame for r in T.segment_choice(T.split_at_cuts(c, cuts), 2).collect()] == [18]


def test_logical_flights(spark):
    def flights(shots):
        rows = [(1, i, *s, 0.0) for i, s in enumerate(shots)]
        df = spark.createDataFrame(rows, "flight_id long, shot long, frames long, start_s double, end_s double, start_e double, start_n double, end_e double, end_n double, distance_m double")
        return [(r.frames, r.largest) for r in T.flight_summaries(T.logical_flights(df)).orderBy("flight").collect()]

    at = lambda a, b, x=0.0: (30, a, b, x, 0.0, x, 0.0)
    assert flights([at(0.0, 2.0), at(2.2, 4.0), at(4.2, 6.0)]) == [(90, True)]
    assert flights([at(0.0, 10.0), at(900.0, 910.0)]) == [(30, True), (30, False)]
    assert flights([at(0.0, 2.0), at(2.2, 4.0, 800.0)]) == [(30, True), (30, False)]
    assert flights([at(0.0, 2.0), at(1.5, 4.0, 20.0)]) == [(60, True)]
    assert flights([(30, 0.0, 2.0, None, None, None, None), (30, 2.2, 4.0, None, None, None, None)]) == [(60, True)]


def test_coverage(spark):
    fixes = spark.createDataFrame([(1, float(t)) for t in range(10)], "flight_id long, t double")
    times = spark.createDataFrame([(1, -0.5), (1, 4.0), (1, 9.6), (2, 1.0)], "flight_id long, t double")
    got = {r.flight_id: (r.keyframes, r.outside, r.covered) for r in T.coverage(times, fixes).collect()}
    assert got[1][:2] == (3, 1) and abs(got[1][2] - 2 / 3) < 1e-9 and got[2] == (1, None, None)
