"""Operators that SQL doesn't express, on small hand-made tracks."""

import pytest
from pyspark.sql import functions as F

from aerolith.operators import tracks
from aerolith.plans import flight
from aerolith.sources import telemetry


def fixes(spark, *flights):
    rows = [(f, i, float(i), 41.0 + n / 111320.0, -81.0 + e / 84015.0, 300.0) for f, pts in enumerate(flights) for i, (e, n) in enumerate(pts)]
    return spark.createDataFrame(rows, "flight_id long, seq long, t double, lat double, lon double, alt double")


def test_verdicts(spark):
    import math

    straight = [(5.0 * i, 0.0) for i in range(60)]
    out_and_back = [(5.0 * (30 - abs(30 - i)), 0.0) for i in range(61)]
    orbit = [(60 * math.cos(i / 10), 60 * math.sin(i / 10)) for i in range(70)]
    short = [(5.0 * i, 0.0) for i in range(4)]
    hover = [(0.01 * i, 0.0) for i in range(30)]
    jumps = [(400.0 * i, 0.0) for i in range(30)]
    got = {r.flight_id: r for r in flight.verdicts(flight.metrics(fixes(spark, straight, out_and_back, orbit, short, hover, jumps))).collect()}
    assert [got[k].status for k in range(6)] == ["valid", "invalid", "invalid", "unknown", "unknown", "unknown"]
    assert got[0].single_pass is True and got[1].single_pass is False and got[3].single_pass is None
    assert got[0].path_efficiency == 1.0 and got[0].dominant_heading_deg == pytest.approx(90.0, abs=0.2)
    assert got[1].loop_closures == 1


@pytest.mark.parametrize(("values", "want"), [([], 0), ([1.0], 0), ([0.0, 10.0, 0.0], 1), ([0.0, 1.0, 0.0, 1.0], 0), ([0.0, 9.0, 2.0, 9.0, 1.0], 3)])
def test_reversals(spark, values, want):
    df = spark.createDataFrame([(values,)], "v array<double>")
    assert df.select(tracks.count_reversals(F.col("v"), F.lit(5.0)).alias("n")).first().n == want


def test_subtitles_round_trip(spark):
    rows = fixes(spark, [(5.0 * i, 2.0 * i) for i in range(20)])
    blocks = telemetry.subtitle_blocks(rows).select(F.col("flight_id").cast("string").alias("file"), "seq", "block")
    back, want = telemetry.subtitle_rows(blocks).orderBy("seq").collect(), rows.orderBy("seq").collect()
    assert [r.seq for r in back] == [r.seq for r in want]
    for a, b in zip(back, want):  # the text has milliseconds and seven decimals
        assert (a.t, a.lat, a.lon, a.alt) == pytest.approx((b.t, b.lat, b.lon, b.alt), abs=1e-7)
    odd = spark.createDataFrame([("f", 0, "1\n00:00:01,500 --> 00:00:02,000\nGPS(-81.5,41.2,18) BAROMETER: 3.5"), ("f", 1, "1\n00:00:02,000 --> 00:00:02,500\nGPS(120.5,41.2,18)"), ("f", 2, "nothing")], "file string, seq long, block string")
    got = telemetry.subtitle_rows(odd).orderBy("seq").collect()
    assert len(got) == 2 and (got[1].lat, got[1].lon) == (41.2, 120.5) and got[0].alt == 3.5


def test_subtitles_of_a_known_order(spark):
    rows = spark.createDataFrame([("f", 0, "1\n00:00:01,500 --> x\nGPS(-81.25,91.125,9)")], "file string, seq long, block string")
    got = lambda **k: [(r.lat, r.lon) for r in telemetry.subtitle_rows(rows, **k).collect()]
    assert got(gps_order="lon_lat") == [(91.125, -81.25)] and got(gps_order="lat_lon") == got() == [(-81.25, 91.125)]


def test_log_rows(spark):
    raw = spark.createDataFrame([("1000", "41.0", "-81.0", "x"), ("3000", "41.1", "-81.1", "7"), ("bad", "1", "1", "1"), ("5000", "0", "0", "1")], "time_ms string, latitude string, lon string, altitude string")
    got = telemetry.log_rows(raw).orderBy("t").collect()
    assert [(r.t, r.alt) for r in got] == [(0.0, 0.0), (2.0, 7.0)]


def test_combined_takes_the_most_severe(spark):
    df = spark.createDataFrame([(1, 0, "valid"), (1, 1, "suspicious"), (2, 0, "unknown"), (3, 0, "unknown"), (3, 1, "valid")], "flight_id long, ord int, status string")
    assert {r.flight_id: r.status for r in flight.combined(df).collect()} == {1: "suspicious", 2: "unknown", 3: "valid"}
