"""Reports, storage, sources, sinks and the command line on small cases."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from aerolith.__main__ import main
from aerolith.functions import geodesy
from aerolith.plans import reports, storage
from aerolith.sources import models, outputs, telemetry


def flight(spark, points, late=0.0, n=None):
    rows = [(1, i, i + late, *((41.0 + y / 111320.0, -81.0 + x / 84015.0, 300.0) if n is None or i < n else (None, None, None))) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "flight_id long, seq long, t double, lat double, lon double, alt double")


STRAIGHT = [(5.0 * i, 0.0) for i in range(60)]
BACK = [(5.0 * (30 - abs(30 - i)), 0.0) for i in range(61)]


def test_validated_runs(spark):
    good = reports.validated(flight(spark, STRAIGHT), flight(spark, STRAIGHT)).first()
    assert (good.status, good.single_pass, good.action, good.trajectory_source, good.warnings) == ("valid", True, "continue", "keyframes_fused", []) and good.path_length_m > 200 and good.telemetry_coverage == 1.0
    assert good.trajectory_start.asDict() == {"lat": 41.0, "lon": -81.0, "alt": 300.0}
    bad = reports.validated(flight(spark, BACK), flight(spark, BACK)).first()
    assert (bad.status, bad.action, bad.single_pass) == ("invalid", "stop", False)
    over = reports.validated(flight(spark, BACK), flight(spark, BACK), allow=True).first()
    assert (over.action, over.overridden) == ("continue", True)
    assert reports.validated(flight(spark, BACK), flight(spark, BACK), policy="warn").first().action == "continue"
    off = reports.validated(flight(spark, BACK), policy="off").first()
    assert (off.status, off.action, off.warnings) == ("skipped", "continue", ["not_checked"])
    late = reports.validated(flight(spark, STRAIGHT, late=30.0), flight(spark, STRAIGHT)).first()
    assert (late.status, late.single_pass, late.keyframes_outside_telemetry) == ("unknown", None, 30) and late.reasons[0].startswith("keyframe_track_unjudged:keyframes_outside") and late.trajectory_source is None and late.path_length_m is None
    mixed = reports.validated(flight(spark, STRAIGHT, late=30.0), flight(spark, BACK)).first()
    assert (mixed.status, mixed.trajectory_source) == ("invalid", "telemetry_fused") and "verdict_from:telemetry_fused" in mixed.warnings
    few = reports.validated(flight(spark, STRAIGHT[:4])).first()
    assert few.status == "unknown" and "no_telemetry" in few.warnings
    some = reports.validated(flight(spark, STRAIGHT, n=50), flight(spark, STRAIGHT), fallback=spark.createDataFrame([(1, True)], "flight_id long, fallback_used boolean"), logical=spark.createDataFrame([(1, 3, 2)], "flight_id long, shots long, flights long")).first()
    assert some.keyframes_with_position == 50 and some.warnings[0] == "several_flights:2" and some.warnings[-2:] == ["keyframes_without_position:10", "fusion_fallback"]
    lines = [r.line for r in reports.report_lines(reports.validated(flight(spark, BACK), flight(spark, BACK))).orderBy("n").collect()]
    assert lines[0].startswith("Flight validation: INVALID") and lines[1].startswith("  - ")
    assert spark.range(1).select(reports.thresholds()["short_track_m"]).first()[0] == "50.0"


def test_quality_summary(spark):
    full = {"reconstruction": {"ok": True, "attempts": 1}, "outputs": {"dsm": "x"}, "classified_cloud": {"points": 5, "labelled_by_ai": 0.5}, "accuracy_vs_lidar": {"n": 1}, "gps_fusion": {"quality": "ok"}}
    got = {(r.run, r.claim): r for r in reports.quality_summary(spark.createDataFrame([("a", json.dumps(full)), ("b", "{}"), ("c", None)], "run string, report string")).collect()}
    assert got["a", "reconstruction"].status == "success" and got["a", "reconstruction"].facts["outputs"] == '["dsm"]' and got["a", "georeferencing"].status == "measured_against_reference"
    assert got["a", "point_cloud"].facts["points"] == "5" and got["a", "gap_filling"].status == "not_run" and got["a", "gap_filling"].facts["inferred_points"] is None
    assert {got["b", c].status for c in ("georeferencing", "point_cloud", "ai_classification", "gap_filling")} == {"not_run"} == {got["c", "georeferencing"].status}


def tree(tmp_path):
    files = {"project/opensfm/a.bin": 100, "project/opensfm/deep/b.bin": 50, "project/odm_dem/dsm.tif": 300, "project/classified.laz": 70, "project/final.laz": 80, "project/notes.txt": 9, "run/frames/f.jpg": 1500, "viewer/points.bin": 20}
    for name, size in files.items():
        at = tmp_path / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(b"x" * size)
    os.link(tmp_path / "project/opensfm/a.bin", tmp_path / "project/odm_dem/linked.bin")
    (tmp_path / "project/filled.laz").symlink_to(tmp_path / "project/final.laz")
    (tmp_path / "project/odm_report").symlink_to(tmp_path / "run")
    (tmp_path / "project/opensfm/broken").symlink_to(tmp_path / "nothing")


def test_storage(spark, tmp_path):
    tree(tmp_path)
    files = None
    for area in ("run", "project", "viewer"):
        part = storage.listing(spark, [str(tmp_path / area)]).where("not is_dir").select(F.lit("r").alias("run"), F.lit(area).alias("area"), "path", "ino", "size")
        files = part if files is None else files.unionByName(part)
    used = storage.usage(storage.targets(files), "run").orderBy("place").collect()
    assert [(r.target, r.size, r.unique_bytes) for r in used] == [("run/frames", 1500, 1500), ("project/odm_dem", 400, 300), ("project/opensfm", 150, 150), ("project/filled.laz", 80, 80), ("project/final.laz", 80, 0), ("project/classified.laz", 70, 70), ("viewer", 20, 20)]
    lines = [r.line for r in storage.usage_lines(storage.usage(storage.targets(files), "run")).orderBy("n").collect()]
    assert lines[0] == "Disk usage of r" and lines[1] == "      1.5 KB  run/frames" and lines[-2] == "Logical total: 2.2 KB (2300 bytes) in 7 entries" and lines[-1] == "Unique total: 2.1 KB (2120 bytes)"
    with pytest.raises(RuntimeError):
        storage.clean(spark, str(tmp_path / "project"), report="broken {")
    project = str(tmp_path / "project")
    said = storage.clean(spark, project, report='{"reconstruction":{"ok":true}}')
    assert [(p, s) for p, s, _ in said] == [("classified.laz", 70), ("filled.laz", 80), ("odm_dem", 400), ("opensfm", 150)] and os.path.exists(f"{project}/opensfm/a.bin")
    assert {d for *_, d in storage.clean(spark, project, report='{"reconstruction":{"ok":true}}', confirm=True)} == {"gone"}
    assert sorted(os.listdir(project)) == ["final.laz", "notes.txt", "odm_report"] and os.path.exists(tmp_path / "run/frames/f.jpg")
    bad = spark.createDataFrame([("p", "/etc/x", "1", 5, False), ("p", "../opensfm/x", "2", 5, False)], "project string, path string, ino string, size long, is_dir boolean")
    assert storage.cleanup_plan(bad).count() == 0
    there = spark.createDataFrame([("p", "odm_dem/dsm.tif"), ("p", "x")], "project string, path string")
    assert [(r.output, r.path) for r in storage.outputs(there).collect()] == [("dsm", "odm_dem/dsm.tif")]


def test_projections(spark):
    rows = [(47.3769, 8.5417), (46.951081, 7.438637), (-33.9, 18.4), (60.0, -81.0), (0.0, 3.0)]
    df = spark.createDataFrame(rows, "lat double, lon double").withColumn("zone", geodesy.utm_zone(F.col("lon")))
    e, n = geodesy.utm(F.col("lat"), F.col("lon"), F.col("zone"), F.col("lat") < 0)
    df = df.select("*", e.alias("e"), n.alias("n"))
    back = geodesy.from_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("lat") < 0)
    got = df.select("*", back[0].alias("lat2"), back[1].alias("lon2")).collect()
    assert all(math.isclose(r.lat, r.lat2, abs_tol=1e-8) and math.isclose(r.lon, r.lon2, abs_tol=1e-8) for r in got)
    assert got[0].zone == 32 and math.isclose(got[3].e, 500000.0, abs_tol=1e-6) and math.isclose(got[3].n, 0.9996 * 6654072.819, abs_tol=0.002) and math.isclose(got[4].e, 500000.0, abs_tol=1e-6) and abs(got[4].n) < 1e-6
    s = df.where("lat > 46 and lat < 48").select("lat", "lon", *(c.alias(k) for c, k in zip(geodesy.to_swiss(F.col("lat"), F.col("lon")), "en")))
    s = s.select("*", *(c.alias(k) for c, k in zip(geodesy.from_swiss(F.col("e"), F.col("n")), ("lat2", "lon2")))).collect()
    assert all(math.isclose(r.lat, r.lat2, abs_tol=2e-5) and math.isclose(r.lon, r.lon2, abs_tol=2e-5) for r in s)
    bern = min(s, key=lambda r: r.lon)
    assert math.isclose(bern.e, 2600000, abs_tol=2) and math.isclose(bern.n, 1200000, abs_tol=2)
    one = spark.createDataFrame([(200, 51400, -12.5083)], "a int, b int, v double").select(geodesy.widened(F.col("a")), geodesy.narrowed(F.col("b")), geodesy.dms(F.col("v"))).first()
    assert (one[0], one[1]) == (51400, 200) and tuple(one[2]) == (12, 30, 29.88)


def test_telemetry_sources(spark, tmp_path):
    log = tmp_path / "log.csv"
    log.write_text("tilt,Time (ms),Latitude,lateral_speed,Longitude,Altitude\n1,5000,47.1,9,8.1,400\n1,6000,47.1,9,8.1,400\n2,7000,bad,9,8.1,1\n3,8000,47.2,9,8.2,\n4,9000,0,0,0,1\n")
    got = telemetry.read_telemetry(spark, str(log)).orderBy("t").collect()
    assert [(r.t, r.lat, r.lon, r.alt) for r in got] == [(0.0, 47.1, 8.1, 400.0), (3.0, 47.2, 8.2, 0.0)] and got[0].h_acc is None
    srt = tmp_path / "a.srt"
    srt.write_text("\r\n\r\n".join(f"{i}\r\n00:00:0{i},500 --> 00:00:0{i},900\r\n[latitude: 41.{i}] [longitude: -81.0] [rel_alt: 1.0 abs_alt: 300.{i}]" for i in range(1, 4)))
    assert [(r.t, r.lat, r.alt) for r in telemetry.read_telemetry(spark, str(srt)).orderBy("seq").collect()] == [(i + 0.5, float(f"41.{i}"), float(f"300.{i}")) for i in range(1, 4)]
    short = tmp_path / "one.csv"
    short.write_text("time,lat,lon\n1,47,8\n")
    for path in (short, tmp_path / "x.txt"):
        with pytest.raises(ValueError):
            telemetry.read_telemetry(spark, str(path))
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / telemetry.GPS_LOG).write_text("Timpstemp, imgid,lat,lon,alt,fix_type,eph_m,epv_m,\n" + "".join(f"{(100 + i) * 10**6},{i},{47 + i / 1000},8,{400 + i},{2 if i == 5 else 3},1.5,{0.001 if i < 4 else 2},\n" for i in range(40)))
    (logs / telemetry.BARO_LOG).write_text("timpstemp,altitude\n80000000,1\n101000000,2\n")
    (logs / telemetry.POSE_LOG).write_text("timpstemp,attitude_w,attitude_x,attitude_y,attitude_z\n102000000,1,0,0,0\n103000000,short\n")
    fixes = telemetry.read_telemetry(spark, str(logs), (3, 8)).orderBy("t").collect()
    assert [r.t for r in fixes] == [float(i) for i in range(-3, 16) if i != 2] and fixes[0].v_acc is None and fixes[-1].v_acc == 2.0
    assert [tuple(r) for r in telemetry.image_log_heights(spark, str(logs), 3, 8).collect()] == [(-2.0, 2.0)]
    poses = telemetry.image_log_attitudes(spark, str(logs), 3, 8).orderBy("t").collect()
    assert (poses[0].t, poses[0].yaw) == (-1.0, 0.0) and poses[1].yaw is None
    assert [tuple(r) for r in telemetry.frame_times(telemetry.read_columns(spark, str(logs / telemetry.GPS_LOG)), 3, 5).orderBy("imgid").collect()] == [(3, 0.0), (4, 1.0), (5, 2.0)]


def test_photo_sources(spark):
    photos = spark.createDataFrame([("10.jpg",), ("15.5.jpg",), ("99.jpg",), ("x.jpg",)], "name string")
    table = spark.createDataFrame([("10", "47", "8", "1"), ("20", "48", "9", ""), ("z", "1", "1", "1")], "ID string, Lat string, Lng string, alt string")
    by_id = {r.name: r.lat for r in telemetry.photo_positions(photos, table).collect()}
    assert by_id == {"10.jpg": 47.0, "15.5.jpg": None, "99.jpg": None, "x.jpg": None}
    by_time = {r.name: (r.lat, r.alt) for r in telemetry.photo_positions(photos, table.withColumnRenamed("ID", "time"), "time").collect()}
    assert by_time.pop("15.5.jpg") == pytest.approx((47.55, 0.45)) and by_time == {"10.jpg": (47.0, 1.0), "99.jpg": (None, None), "x.jpg": (None, None)}
    with pytest.raises(ValueError):
        telemetry.photo_positions(photos, table, "time")
    t = spark.createDataFrame([("a", "2.jpg", "2020:01:01 10:00:00\0"), ("a", "1.jpg", "2020:01:01 11:00:00"), ("b", "2.jpg", "2020:01:01 10:00:00"), ("b", "1.jpg", "never")], "folder string, name string, text string")
    got = telemetry.ordered_photos(t.withColumn("taken", telemetry.capture_time(F.col("text")))).collect()
    assert {(r.folder, r.name): r.seq for r in got} == {("a", "2.jpg"): 0, ("a", "1.jpg"): 1, ("b", "1.jpg"): 0, ("b", "2.jpg"): 1}
    poses = spark.createDataFrame([(10.0, 1.0, 2.0, 3.0), (20.0, 11.0, 22.0, 33.0), (float("nan"), 0.0, 0.0, 0.0)], "imgid double, x_gt double, y_gt double, z_gt double")
    ref = telemetry.reference_poses(poses, spark.createDataFrame([("a", 0), ("b", 5), ("c", 40)], "name string, frame int"), 10).orderBy("name").collect()
    assert [(r.name, r.rx, r.ry, r.rz) for r in ref] == [("a", 1.0, 2.0, 3.0), ("b", 6.0, 12.0, 18.0)]


def test_model_sources(spark, tmp_path):
    rec = [{"cameras": {"c": {"projection_type": "brown", "width": 400, "height": 300, "focal_x": 0.8, "k1": 0.1}}, "shots": {"a.jpg": {"rotation": [0, 0, 0.1], "translation": [1, 2, 3], "camera": "c"}}}]
    (tmp_path / "r.json").write_text(json.dumps(rec))
    got = models.read_reconstruction(spark, str(tmp_path / "r.json")).first()
    assert (got.shot, got.kind, got.width, got.focal_x, got.focal, got.rz, got.tx) == ("a.jpg", "brown", 400, 0.8, None, 0.1, 1.0)
    (tmp_path / "coords.txt").write_text("WGS84 UTM 32N\n1000 2000\n")
    assert tuple(models.read_georeference(spark, str(tmp_path / "coords.txt")).first()) == (32632, 1000.0, 2000.0)
    assert models.cloud_epsg(2056, spark, "") == 2056 and models.cloud_epsg(None, spark, str(tmp_path / "coords.txt")) == 32632
    (tmp_path / "k.json").write_text('{"K": [[900, 0, 480], [0, 910, 270], [0, 0, 1]], "dist": [0.1, 0.2]}')
    k = models.read_calibration(spark, str(tmp_path / "k.json")).first()
    assert (k.fx, k.py, k.dist, k.size_w) == (900.0, 270.0, [0.1, 0.2], None)
    (tmp_path / "w.json").write_text('{"elements": [{"id": 5}, {"id": 5, "geometry": [{"lat": 1, "lon": 2}], "tags": {"building": "yes"}}, {"id": 6, "geometry": [{"lat": 3, "lon": 4}]}]}')
    w = models.read_way(spark, str(tmp_path / "w.json"), 5).collect()
    assert len(w) == 1 and w[0].ring[0].lon == 2.0 and w[0].tags["building"] == "yes"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b.jpg", 41.2, -81.5, 300.0, 0.01, 2.0, 5.0), (0, "a.jpg", 41.1, -81.4, 299.0, 3.0, 0.02, float("nan")), (2, "c.jpg", None, None, None, 1.0, 1.0, 1.0)], "seq long, name string, lat double, lon double, alt double, h_std double, v_std double, sharpness double")
    base = f"file://{tmp_path}"
    outputs.write_geo(rows.where("lat is not null"), f"{base}/geo")
    assert [r.value for r in spark.read.text(f"{base}/geo").collect()] == ["EPSG:4326", "a.jpg -81.400000000 41.100000000 299.000 nan nan nan 3.000 0.050", "b.jpg -81.500000000 41.200000000 300.000 nan nan nan 0.050 2.000"]
    outputs.write_priors(rows, f"{base}/p")
    assert spark.read.text(f"{base}/p/priors").first().value == "a.jpg 41.10000000 -81.40000000 299.000"
    outputs.write_telemetry(rows, f"{base}/t")
    text = [r.value for r in spark.read.text(f"{base}/t").collect()]
    assert text[0] == ",".join(outputs.FIELDS) and text[1].startswith("a.jpg,,,41.1") and text[1].endswith(",") and text[3].startswith("c.jpg,,,,,")
    assert outputs.read_text(spark, f"{base}/none") is None
    outputs.write_report(spark, f"{base}/r.json", {"a": 1})
    outputs.write_report(spark, f"{base}/r.json", {"a": 2})
    assert json.loads(outputs.read_text(spark, f"{base}/r.json")) == {"a": 2}
    with pytest.raises(FileExistsError):
        outputs.prepared(spark, f"{base}/geo")
    assert outputs.prepared(spark, f"{base}/geo", True) and outputs.prepared(spark, f"{base}/geo")
    cloud = spark.createDataFrame([(i, float(i), 0.0, 5.0, 257 * i, 0, 65535, c, v) for i, (c, v) in enumerate([(2, 1), (6, 300), (77, 2)])], "point_id long, x double, y double, z double, red int, green int, blue int, classification int, views int")
    outputs.write_cloud(cloud, f"{base}/cloud1")
    outputs.write_cloud(cloud.withColumn("inferred", F.lit(1)), f"{base}/cloud2")
    both = outputs.read_cloud(spark, f"{base}/cloud1", f"{base}/cloud2")
    assert both.count() == 6 and both.where("inferred is null").count() == 3
    about = outputs.export_points(spark, outputs.read_cloud(spark, f"{base}/cloud2"), f"{base}/v", "one")
    outputs.export_points(spark, outputs.read_cloud(spark, f"{base}/cloud1"), f"{base}/v", "two", most=2)
    outputs.export_points(spark, outputs.read_cloud(spark, f"{base}/cloud1"), f"{base}/v", "one", title="again")
    p = spark.read.parquet(f"{base}/v/data/one/points").orderBy("point_id").collect()
    assert about["centre"] == [1.0, 0.0, 5.0] and about["inferred_points"] == 3 and about["legend"]["1"]["name"] == "unlabelled" and (p[0].x, p[2].red, p[0].blue, p[1].views) == (-1.0, 2, 255, 255)
    assert [(m["key"], m["title"]) for m in json.loads(outputs.read_text(spark, f"{base}/v/models.json"))] == [("two", "two"), ("one", "again")] and spark.read.parquet(f"{base}/v/data/two/points").count() == 2
    models_ = spark.createDataFrame([("a", 0), ("b", 1)], "key string, ord int")
    up = outputs.upserted(models_, spark.createDataFrame([("a", 9)], "key string, ord int"))
    assert [(r.key, r.ord) for r in up.orderBy("ord").collect()] == [("b", 1), ("a", 2)]
    assert [(r.key, r.shown) for r in outputs.model_list(models_, spark.createDataFrame([("z", 0)], "key string, ord int"), "z").orderBy("group", "ord").collect()] == [("a", False), ("b", False), ("z", True)]
    assert outputs.model_list(models_, models_.limit(0), "none").where("shown").first().key == "a"


def test_command_line(spark, tmp_path, capsys):
    log = tmp_path / "log.csv"
    log.write_text("time,latitude,longitude,altitude\n" + "".join(f"{i},{41.0 + y / 111320.0},{-81.0 + x / 84015.0},300\n" for i, (x, y) in enumerate(STRAIGHT)))
    assert main(["validate", str(log)], spark) == 0 and '"valid"' in capsys.readouterr().out
    back = tmp_path / "back.csv"
    back.write_text("time,latitude,longitude,altitude\n" + "".join(f"{i},{41.0 + y / 111320.0},{-81.0 + x / 84015.0},300\n" for i, (x, y) in enumerate(BACK)))
    assert main(["validate", str(back)], spark) == 3 and main(["validate", str(back), "--policy", "off"], spark) == 0
    frames = tmp_path / "frames.csv"
    frames.write_text("name,t\n" + "".join(f"f{i}.jpg,{2 * i}\n" for i in range(25)))
    assert main(["run", str(log), str(frames), f"file://{tmp_path}/out"], spark) == 0
    report = json.loads(outputs.read_text(spark, f"file://{tmp_path}/out/report.json"))
    assert report["flight_validation"]["status"].startswith("valid") and report["quality"]["single_pass"]["status"].startswith("valid") and len(report["timings"]) == 3
    cands = tmp_path / "c.csv"
    cands.write_text("frame,t,sharpness,shift\n" + "".join(f"{6 * i},{0.2 * i},{50 + i % 3},{0.04}\n" for i in range(40)))
    assert main(["keyframes", str(cands), f"file://{tmp_path}/k", "--telemetry", str(log)], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["keyframes"] == 16
    shots = tmp_path / "p.csv"
    shots.write_text("name,taken,lat,lon,alt,sharpness\n" + "".join(f"{i}.jpg,2020-01-01 10:00:{i:02d},{41.0 + i / 5000},-81.0,300,{90 - i % 2}\n" for i in range(12)))
    assert main(["photos", str(shots), f"file://{tmp_path}/ph", "--min-move", "30"], spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["keyframes"] == 6
    tree(tmp_path / "t")
    for a, b in (("run", "work"), ("project", "projects")):
        (tmp_path / b).mkdir()
        os.rename(tmp_path / "t" / a, tmp_path / b / "r")
    (tmp_path / "work/r/report.json").write_text('{"reconstruction":{"ok":true}}')
    paths = ["--work", str(tmp_path / "work"), "--projects", str(tmp_path / "projects")]
    assert main(["usage", "r", *paths, "--viewer", str(tmp_path / "none")], spark) == 0 and "run/frames" in capsys.readouterr().out
    assert main(["clean", "r", *paths], spark) == 0 and os.path.exists(tmp_path / "projects/r/opensfm")
    assert main(["clean", "r", *paths, "--confirm"], spark) == 0 and not os.path.exists(tmp_path / "projects/r/opensfm")
    side = [(i, float(i % 40), float(i // 40), float((i * 7) % 11) / 10) for i in range(1600)]
    spark.createDataFrame(side, "point_id long, x double, y double, z double").write.parquet(f"file://{tmp_path}/a.parquet")
    assert main(["evaluate", f"file://{tmp_path}/a.parquet", f"file://{tmp_path}/a.parquet"], spark) == 0
    assert json.loads(capsys.readouterr().out.split("bytes)\n")[-1].split("bytes\n")[-1])["as_georeferenced"]["median_m"] == 0.0


def test_quality_summary_keeps_numbers_as_written(spark):
    text = '{"flight_validation":{"status":"ok","path_efficiency":0.10,"revisit_score":"0.50","policy":{"a":1.50},"overridden":true,"warnings":[1.0, 2]},"reconstruction":{"ok":true,"attempts":1e3},"gps_fusion":{"median_h_std_m":-2.00}}'
    rows = spark.createDataFrame([("a", text), ("b", '{"flight_validation":3,"reconstruction":{"attempts":2'), ("c", "[1.0]")], "run string, report string")
    got = {(r.run, r.claim): r.facts for r in reports.quality_summary(rows).collect()}
    flown = got["a", "single_pass"]
    assert (flown["path_efficiency"], flown["revisit_score"], flown["overridden"], flown["single_pass"]) == ("0.10", "0.50", "true", None)
    assert json.loads(flown["policy"]) == {"a": 1.5} and json.loads(flown["warnings"]) == [1.0, 2]
    assert got["a", "reconstruction"]["attempts"] == "1e3" and got["a", "georeferencing"]["median_horizontal_gps_std_m"] == "-2.00"
    assert got["b", "single_pass"]["path_efficiency"] is None and got["c", "reconstruction"]["attempts"] is None
