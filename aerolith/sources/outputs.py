"""Sinks: position lists, telemetry and key frame tables, reports, clouds and viewer data."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cameras import legend
from ..operators.clouds import hash_sample
from . import telemetry


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: written beside its place and then moved there."""
    fs, where = _fs(spark, path)
    _, beside = _fs(spark, path + ".new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(where, False)
    fs.rename(beside, where)


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def prepared(spark: SparkSession, path: str, overwrite: bool = False) -> str:
    """An empty output folder; a folder that holds something is refused, or emptied where that is asked for."""
    fs, where = _fs(spark, path)
    if fs.exists(where) and len(fs.listStatus(where)):
        if not overwrite:
            raise FileExistsError(f"{path} is not empty")
        fs.delete(where, True)
    fs.mkdirs(where)
    return path


def write_lines(rows: DataFrame, path: str, first: str | None = None) -> None:
    """Lines (n, line) of one run in order as one folder of one text file, behind a first line where one is given; lists of a run's photos are small."""
    lines = rows.select("n", "line")
    if first is not None:
        lines = rows.sparkSession.createDataFrame([(-1, first)], "n long, line string").unionByName(lines.withColumn("n", F.col("n").cast("long")))
    lines.coalesce(1).sortWithinPartitions("n").select("line").write.mode("overwrite").text(path)


def write_geo(rows: DataFrame, path: str) -> None:
    """Position lines with accuracies, of rows (seq, name, lon, lat, alt, h_std, v_std), behind the coordinate system's name."""
    lines = telemetry.geo_lines(rows).join(rows.select("name", F.col("seq").alias("n")), "name")
    write_lines(lines, path, "EPSG:4326")


def prior_lines(rows: DataFrame) -> DataFrame:
    """(n, geo, prior): a photo's line with longitude first, and with latitude first, of rows with a position."""
    text = lambda a, b: F.format_string("%s %.8f %.8f %.3f", "name", *(F.col(c).cast("double") for c in (a, b, "alt")))
    return rows.where("lat is not null and not isnan(lat)").select(F.col("seq").alias("n"), text("lon", "lat").alias("geo"), text("lat", "lon").alias("prior"))


def write_priors(rows: DataFrame, folder: str) -> None:
    lines = prior_lines(rows)
    write_lines(lines.select("n", F.col("geo").alias("line")), f"{folder}/geo", "EPSG:4326")
    write_lines(lines.select("n", F.col("prior").alias("line")), f"{folder}/priors")


# fixed values: columns of a data set's telemetry table
FIELDS = ["name", "source", "t", "lat", "lon", "alt", "east", "north", "up", "sharpness"]


def write_telemetry(rows: DataFrame, path: str) -> None:
    """The telemetry table of a run's photos in order; what is not a number is empty."""
    have = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in FIELDS]
    plain = [F.when(~F.isnan(c), F.col(c)).alias(c) if dict(rows.dtypes).get(c) in ("double", "float") else have[i] for i, c in enumerate(FIELDS)]
    rows.coalesce(1).sortWithinPartitions("seq").select(*plain).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_subtitles(fixes: DataFrame, path: str, key: str = "flight_id") -> None:
    """Subtitle blocks of each flight as one file a flight, in order."""
    blocks = telemetry.subtitle_blocks(fixes, key)
    text = blocks.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "block"))), lambda b: b["block"]), "\n\n").alias("value"))
    text.repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def write_records(rows: DataFrame, path: str) -> None:
    """Key frame records as JSON lines; a run's stages may write them again, so a finished write replaces the one before."""
    rows.write.mode("overwrite").json(path)


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    write_text(spark, path, json.dumps(report, indent=2, default=str))


def write_cloud(points: DataFrame, path: str) -> None:
    """A cloud with its further columns (views, inferred) as they are; later reads may unite clouds that have other columns."""
    points.write.mode("overwrite").parquet(path)


def read_cloud(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*paths)


def viewer_points(points: DataFrame, most: int = 2_000_000, seed: int = 0) -> tuple[DataFrame, dict]:
    """(points around their centre as floats with 8-bit colours, class, views and inferred; a description) of at most `most` points, the same ones for the same seed."""
    have = points.columns
    some = points if points.count() <= most else hash_sample(points, "point_id", most, seed)
    got = some.agg(*(F.avg(c).alias(c) for c in "xyz"), F.max(F.greatest("red", "green", "blue")).alias("bright"), F.count("*").alias("n")).first()
    colour = lambda c: (F.shiftright(F.col(c).cast("int"), 8) if (got.bright or 0) > 255 else F.col(c)).cast("short").alias(c)
    views = F.least(F.coalesce(F.col("views"), F.lit(0)), F.lit(255)) if "views" in have else F.lit(0)
    inferred = F.coalesce(F.col("inferred").cast("int"), F.lit(0)) if "inferred" in have else F.lit(0)
    out = some.select("point_id", *((F.col(c) - F.lit(got[c])).cast("float").alias(c) for c in "xyz"), *map(colour, ("red", "green", "blue")), F.col("classification").cast("short").alias("classification"), views.cast("short").alias("views"), inferred.cast("short").alias("inferred"))
    rows = legend(some).collect()
    about = {"count": got.n, "centre": [got[c] for c in "xyz"], "has_views": "views" in have, "inferred_points": out.agg(F.sum("inferred")).first()[0] or 0, "legend": {str(r.code): {"name": r.name, "rgb": list(r.colour)} for r in sorted(rows)}}
    return out, about


def upserted(models: DataFrame, new: DataFrame, key: str = "key", order: str = "ord") -> DataFrame:
    """Models without those that come anew, and behind them the new ones."""
    last = models.agg(F.coalesce(F.max(order), F.lit(-1)).alias("__last"))
    added = new.drop(order).crossJoin(F.broadcast(last)).withColumn(order, F.col("__last") + 1).drop("__last")
    return models.join(new.select(key), key, "left_anti").unionByName(added, allowMissingColumns=True)


def model_list(own: DataFrame, built_in: DataFrame, wanted: str | None = None, key: str = "key", order: str = "ord") -> DataFrame:
    """Own models first, then built-in ones, with shown: the wanted one, else the first."""
    both = own.withColumn("__k", F.lit(0)).unionByName(built_in.withColumn("__k", F.lit(1)), allowMissingColumns=True)
    first = both.agg(F.min_by(key, F.struct("__k", order)).alias("__f"), F.min_by(key, F.when(F.col(key) == F.lit(wanted), F.struct("__k", order))).alias("__w"))
    return both.crossJoin(F.broadcast(first)).withColumn("shown", F.col(key) == F.coalesce("__w", "__f")).withColumnRenamed("__k", "group").drop("__f", "__w")


def export_points(spark: SparkSession, points: DataFrame, root: str, name: str, *, title: str | None = None, note: str = "", crs: str = "", mesh: str | None = None, most: int = 2_000_000) -> dict:
    """Writes a viewer's points and description, and the list of models with this one last."""
    out, about = viewer_points(points, most)
    out.write.mode("overwrite").parquet(f"{root}/data/{name}/points")
    write_report(spark, f"{root}/data/{name}/meta.json", about | {"name": name, "crs": crs})
    known = [m for m in json.loads(read_text(spark, f"{root}/models.json") or "[]") if m["key"] != name]
    write_report(spark, f"{root}/models.json", [*known, {"key": name, "title": title or name, "note": note, "points": f"data/{name}/", "mesh": mesh}])
    return about
