"""Command line: run, validate, keyframes, photos, evaluate, export, usage, clean."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import buildings, clouds, fusion, tracks
from .operators import points as P
from .plans import reports, storage
from .sources import outputs, telemetry

KEY = "flight_id"


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("aerolith").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _fixes(spark: SparkSession, path: str, images: list[int] | None = None) -> DataFrame:
    return telemetry.read_telemetry(spark, path, tuple(images) if images else None).withColumn(KEY, F.lit("run")).drop("file")


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("header", True).option("inferSchema", True).csv(path)


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Verdict on one flight, from its telemetry and, where given, its key frames' times."""
    fixes = _fixes(spark, a.telemetry, a.images)
    frames = fixes
    if a.keyframes:
        times = _table(spark, a.keyframes).select(F.lit("run").alias(KEY), F.col("t").cast("double").alias("q"))
        frames = fusion.fused(fixes, times).select(KEY, F.col("q").alias("t"), "lat", "lon", "alt")
        frames = frames.withColumn("seq", F.row_number().over(tracks.Window.partitionBy(KEY).orderBy("t")).cast("long") - 1)
    got = reports.validated(frames, fixes, policy=a.policy, allow=a.allow_multi_pass)
    for row in reports.report_lines(got).orderBy("n").collect() if a.policy != "off" else []:
        print(row.line)
    block = got.drop(KEY).first().asDict(recursive=True)
    if a.report:
        outputs.write_report(spark, a.report, {"flight_validation": block})
    print(json.dumps({"status": block["status"], "action": block["action"]}))
    return 3 if block["action"] == "stop" else 0


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """Fuses positions at the key frames' times, writes them, validates the flight and states what was established; stages' times go to the report."""
    outputs.prepared(spark, a.out, a.overwrite)
    took, report = [], {}

    def stage(name: str, f):
        start = time.time()
        out = f()
        took.append({"stage": name, "seconds": round(time.time() - start, 2)})
        report["timings"] = took
        outputs.write_report(spark, f"{a.out}/report.json", report)
        return out

    fixes = stage("telemetry", lambda: _fixes(spark, a.telemetry, a.images))
    frames = _table(spark, a.keyframes).select("name", F.col("t").cast("double").alias("q"))

    def fuse() -> DataFrame:
        at = fusion.fused(fixes, frames.select(F.lit("run").alias(KEY), "q").distinct())
        rows = frames.join(at, "q", "left").withColumn("seq", F.row_number().over(tracks.Window.orderBy("q", "name")).cast("long") - 1)
        outputs.write_records(rows, f"{a.out}/keyframes")
        outputs.write_geo(rows.where("lat is not null"), f"{a.out}/geo")
        first = at.select("quality", "rejection_ratio", "median_residual_m").first()
        report["gps_fusion"] = first.asDict() if first else {}
        return spark.read.json(f"{a.out}/keyframes").withColumn(KEY, F.lit("run")).withColumnRenamed("q", "t")

    records = stage("gps_fusion", fuse)
    got = stage("flight_validation", lambda: reports.validated(records.select(KEY, "seq", "t", "lat", "lon", "alt"), fixes, policy=a.policy, allow=a.allow_multi_pass).drop(KEY).first())
    report["flight_validation"] = got.asDict(recursive=True)
    report["minutes"] = round(sum(s["seconds"] for s in took) / 60, 2)
    one = spark.createDataFrame([("run", json.dumps(report, default=str))], "run string, report string")
    report["quality"] = {r.claim: {"status": r.status, **r.facts} for r in reports.quality_summary(one).collect()}
    outputs.write_report(spark, f"{a.out}/report.json", report)
    print(json.dumps({"status": got.status, "action": got.action, "out": a.out}))
    return 3 if got.action == "stop" else 0


def keyframes(spark: SparkSession, a: argparse.Namespace) -> int:
    """Selects key frames from a video's candidates (frame, t, sharpness, shift) and cuts (frame)."""
    outputs.prepared(spark, a.out, a.overwrite)
    cands = _table(spark, a.candidates).select(F.lit("run").alias("shot_key"), F.col("frame").cast("long").alias("frame"), *(F.col(c).cast("double").alias(c) for c in ("t", "sharpness", "shift")))
    cuts = _table(spark, a.cuts).select(F.lit("run").alias("shot_key"), F.col("frame").cast("long").alias("frame")) if a.cuts else cands.select("shot_key", "frame").limit(0)
    picked = tracks.segment_choice(tracks.split_at_cuts(cands, cuts), a.segment)
    kept = tracks.keyframes(picked, a.min_shift, a.max_gap, a.blur)
    kept = kept.where("not blurry").withColumn("seq", F.row_number().over(tracks.Window.orderBy("frame")).cast("long") - 1).withColumn("name", F.format_string("frame_%06d.jpg", "frame"))
    if a.telemetry:
        fixes = _fixes(spark, a.telemetry)
        for c in ("lat", "lon", "alt"):
            at = tracks.interpolated(kept.select(F.lit("run").alias(KEY), (F.col("t")).alias("q")).distinct(), fixes, c, slack=0.5, offset=a.offset)
            kept = kept.join(at.select(F.col("q").alias("t"), c), "t", "left")
        outputs.write_priors(kept, a.out)
    outputs.write_telemetry(kept.withColumn("source", F.lit("video")), f"{a.out}/telemetry")
    n = kept.count()
    outputs.write_report(spark, f"{a.out}/report.json", {"keyframes": n, "warnings": [] if a.telemetry else ["no_gps"]})
    print(json.dumps({"keyframes": n, "out": a.out}))
    return 0


def photos(spark: SparkSession, a: argparse.Namespace) -> int:
    """Orders photos (name, taken, lat, lon, alt, sharpness), takes positions from a table where asked, and keeps sharp ones that lie apart."""
    outputs.prepared(spark, a.out, a.overwrite)
    rows = _table(spark, a.photos).withColumn("folder", F.lit("run"))
    if a.positions:
        rows = telemetry.photo_positions(rows.drop("lat", "lon", "alt"), spark.read.option("header", True).csv(a.positions), a.match)
    rows = telemetry.ordered_photos(rows.withColumn("taken", F.col("taken").cast("string"))).withColumn(KEY, F.lit("run"))
    known = rows.where("lat is not null and lon is not null and alt is not null")
    track = tracks.local_track(known).select("name", "e", "n", "u")
    rows = rows.join(track, "name", "left")
    said = clouds.spaced_photos(rows, a.min_move, a.blur).where("verdict = 'kept'").select("seq")
    kept = rows.join(said, "seq", "left_semi")
    counts = {r.strip: r.photos for r in tracks.strip_counts(tracks.strips(kept.where("e is not null"))).collect()}
    outputs.write_priors(kept, a.out)
    outputs.write_telemetry(kept.withColumns({"source": F.lit("photos"), "east": F.col("e"), "north": F.col("n"), "up": F.col("u")}), f"{a.out}/telemetry")
    summary = tracks.gps_summary(kept.where("e is not null")).drop(KEY).first()
    outputs.write_report(spark, f"{a.out}/report.json", {"keyframes": kept.count(), "strips": counts, "gps": summary.asDict() if summary else None})
    print(json.dumps({"keyframes": kept.count(), "strips": counts}))
    return 0


def evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Distances of a cloud's measured points to a reference cloud, before and after a rigid alignment."""
    cloud = clouds.hash_sample(buildings.measured_only(outputs.read_cloud(spark, a.cloud)), "point_id", a.points).select("point_id", *"xyz")
    box = buildings.bounds(cloud, 20.0).first()
    ref = outputs.read_cloud(spark, a.reference).where(F.col("x").between(box.x0, box.x1) & F.col("y").between(box.y0, box.y1))
    middle = cloud.agg(*(F.avg(c).alias(c) for c in "xyz")).first()
    local = lambda t: t.select(*(["point_id"] if "point_id" in t.columns else []), *((F.col(c) - F.lit(middle[c])).alias(c) for c in "xyz"))
    cloud, ref = local(cloud), local(ref)
    if ref.count() < 1000:
        print(json.dumps({"note": "the reference does not overlap the cloud"}))
        return 1
    stats = lambda c: {k: round(v, 3) for k, v in P.distance_stats(buildings.nearest_anywhere(c, ref, 1.0), "d").first().asDict().items()}
    out = {"as_georeferenced": stats(cloud)}
    _, rot, shift = clouds.icp(cloud, ref)
    moved = cloud.select("point_id", *(sum((F.col(b) * float(rot[i, j]) for j, b in enumerate("xyz")), F.lit(float(shift[i]))).alias(c) for i, c in enumerate("xyz")))
    out |= {"after_rigid_alignment": stats(moved), "offset_m": [round(float(v), 2) for v in shift]}
    print(json.dumps(out, indent=2))
    return 0


def export(spark: SparkSession, a: argparse.Namespace) -> int:
    about = outputs.export_points(spark, outputs.read_cloud(spark, a.cloud), a.out, a.name, title=a.title, note=a.note, most=a.points)
    print(json.dumps(about))
    return 0


def usage(spark: SparkSession, a: argparse.Namespace) -> int:
    """Storage of a run by target; folders that aren't there are left out."""
    roots = {"run": os.path.join(a.work, a.name), "project": os.path.join(a.projects, a.name), "viewer": os.path.join(a.viewer, "data", a.name)}
    if not os.path.exists(roots["viewer"]):
        roots["viewer"] = os.path.join(a.viewer, a.name)
    files = None
    for area, root in roots.items():
        part = storage.listing(spark, [root]).where("not is_dir").select(F.lit(a.name).alias("run"), F.lit(area).alias("area"), "path", "ino", "size")
        files = part if files is None else files.unionByName(part)
    lines = storage.usage_lines(storage.usage(storage.targets(files, a.prefix), "run")).orderBy("n").collect()
    print("\n".join(r.line for r in lines) or f"No data of {a.name}")
    return 0


def clean(spark: SparkSession, a: argparse.Namespace) -> int:
    """Names, and with --confirm deletes, what a finished run no longer needs."""
    project = os.path.join(a.projects, a.name)
    at = os.path.join(a.work, a.name, "report.json")
    text = open(at).read() if os.path.exists(at) else None
    try:
        rows = storage.clean(spark, project, prefix=a.prefix, confirm=a.confirm, report=text)
    except RuntimeError as e:
        print(e)
        return 2
    for path, size, said in rows:
        print(f"{said}: {path} ({size} bytes)")
    print(f"{len(rows)} paths, {sum(r[1] for r in rows)} bytes")
    return int(any(r[2].startswith("failed") for r in rows))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m aerolith", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(f, *names: str) -> argparse.ArgumentParser:
        p = sub.add_parser(f.__name__, help=(f.__doc__ or "").splitlines()[0] if f.__doc__ else None)
        p.set_defaults(run=f)
        for n in names:
            p.add_argument(n)
        return p

    for f in (validate, run):
        p = command(f, "telemetry", *(["keyframes", "out"] if f is run else []))
        p.add_argument("--images", type=int, nargs=2, help="first and last image of a folder of image logs")
        p.add_argument("--policy", choices=("enforce", "warn", "off"), default="enforce")
        p.add_argument("--allow-multi-pass", action="store_true")
        if f is validate:
            p.add_argument("--keyframes")
            p.add_argument("--report")
        else:
            p.add_argument("--overwrite", action="store_true")
    p = command(keyframes, "candidates", "out")
    p.add_argument("--cuts")
    p.add_argument("--telemetry")
    p.add_argument("--offset", type=float, default=0.0)
    p.add_argument("--segment", default="all")
    p.add_argument("--min-shift", type=float, default=0.10)
    p.add_argument("--max-gap", type=float, default=2.0)
    p.add_argument("--blur", type=float, default=0.35)
    p.add_argument("--overwrite", action="store_true")
    p = command(photos, "photos", "out")
    p.add_argument("--positions")
    p.add_argument("--match", choices=("id", "time"), default="id")
    p.add_argument("--min-move", type=float, default=0.0)
    p.add_argument("--blur", type=float, default=0.35)
    p.add_argument("--overwrite", action="store_true")
    p = command(evaluate, "cloud", "reference")
    p.add_argument("--points", type=int, default=300_000)
    p = command(export, "cloud", "out", "name")
    p.add_argument("--title")
    p.add_argument("--note", default="")
    p.add_argument("--points", type=int, default=2_000_000)
    for f in (usage, clean):
        p = command(f, "name")
        p.add_argument("--work", default="data/runs")
        p.add_argument("--projects", default="data/projects")
        p.add_argument("--prefix", default="")
        if f is usage:
            p.add_argument("--viewer", default="viewer")
        else:
            p.add_argument("--confirm", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    return a.run(spark or _session(), a)


if __name__ == "__main__":
    sys.exit(main())
