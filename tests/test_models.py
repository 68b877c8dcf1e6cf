"""Readers, rules and streams on hand-made inputs."""

import struct

import pytest

from aerolith.plans import rules
from aerolith.sources import models
from aerolith.streaming import live


def test_buildings(spark, tmp_path):
    one = '<core:m><bldg:Building gml:id="b{0}"><bldg:boundedBy><bldg:{1}Surface><gml:posList>{2} 0 0\n {2} 1 0 {2} 1 2</gml:posList></bldg:{1}Surface></bldg:boundedBy></bldg:Building></core:m>\n'
    (tmp_path / "c.gml").write_text(one.format(1, "Wall", 5) + one.format(2, "Roof", 50) + one.format(3, "Closure", 5))
    rows = models.read_buildings(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.id, r.kind, [tuple(p) for p in r.ring]) for r in rows] == [("b1", "wall", [(5, 0, 0), (5, 1, 0), (5, 1, 2)]), ("b2", "roof", [(50, 0, 0), (50, 1, 0), (50, 1, 2)])]
    assert [r.id for r in models.read_buildings(spark, str(tmp_path), (0, 0, 10, 10)).collect()] == ["b1"]


def test_mesh(spark, tmp_path):
    (tmp_path / "m.obj").write_text("# mesh\nv 0 0 0\nv 1 0 0.5\nvn 1 1 1\nv 0 1 0\nf 1/1 2/2 3/3\nf 3 2 1\n")
    v, f = models.read_mesh(spark, str(tmp_path))
    assert [tuple(r)[1:] for r in v.orderBy("id").collect()] == [(0, 0, 0, 0), (1, 1, 0, 0.5), (2, 0, 1, 0)]
    assert [r.corners for r in f.orderBy("id").collect()] == [[0, 1, 2], [2, 1, 0]]


def test_points(spark, tmp_path):
    head = bytearray(375)
    head[:4] = b"LASF"
    struct.pack_into("<I", head, 96, 375)
    struct.pack_into("<BH", head, 104, 7, 36)
    struct.pack_into("<6d", head, 131, 0.01, 0.01, 0.1, 100, 200, 0)
    struct.pack_into("<Q", head, 247, 2)
    body = b"".join(struct.pack("<3i4xB13x3H", *p) for p in ((100, 200, 30, 6, 1, 2, 65535), (-100, 0, 0, 2, 0, 0, 0)))
    (tmp_path / "a.las").write_bytes(bytes(head) + body)
    got = [tuple(r)[1:] for r in models.read_points(spark, str(tmp_path)).orderBy("point_id").collect()]
    assert got == [(0, 101.0, 202.0, 3.0, 1, 2, 65535, 6), (1, 99.0, 200.0, 0.0, 0, 0, 0, 2)]


@pytest.mark.parametrize("report,path,want", [
    ('{"reconstruction": {"ok": true}}', None, True), ('{"reconstruction": {"ok": "true"}}', None, False), ('{"outputs": {"a": 1}}', None, True), ('{"outputs": {}}', None, False),
    ("{broken", rules.FINAL, False), ("[1]", rules.FINAL, False), ('{"reconstruction": null}', rules.FINAL, False), ("{}", rules.FINAL, True), (None, rules.FINAL, True), (None, "other", False), (None, None, False),
])
def test_success(spark, report, path, want):
    runs = spark.createDataFrame([("p", report)], "project string, report string")
    files = spark.createDataFrame([("p", path)] if path else [], "project string, path string")
    assert [(r.project, r.successful) for r in rules.succeeded(runs, files).collect()] == [("p", want)]


def test_deletable(spark):
    rows = [("a", "opensfm", True), ("a", "odm_texturing", True), ("a", rules.SUPERSEDED[0], False), ("a", rules.FINAL, False), ("b", rules.SUPERSEDED[0], False), ("b", "openmvs", False)]
    got = rules.deletable(spark.createDataFrame(rows, "project string, path string, is_dir boolean"))
    assert sorted(map(tuple, got.collect())) == [("a", rules.SUPERSEDED[0]), ("a", "opensfm")]


def test_streams(spark, tmp_path):
    fixes = spark.sql("select 1L flight_id, timestamp_seconds(1000 + s) ts, cast(s as double) alt from values 0, 5, 5, 20, 90, 400 t(s)")
    fixes.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(fixes.schema).parquet(str(tmp_path / "in"))

    def ran(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert q.awaitTermination(60)
        return spark.table(name)

    assert ran(live.once(stream(), ["flight_id", "ts"]), "once").count() == 5
    got = ran(live.flights(stream(), "30 seconds"), "flown", "complete").orderBy("start").collect()
    assert [r.fixes for r in got] == [4, 1, 1]
    assert sum(r.fixes for r in ran(live.health(stream(), "alt"), "health", "complete").collect()) == 6
