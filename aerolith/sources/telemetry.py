"""Telemetry sources and sinks: subtitle tracks and headed logs, as keyed and ordered rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geodesy import quaternion_angles
from ..operators import tracks


def _number(text: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(text, rf"(?i){name}\s*[:=]\s*(-?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def read_subtitles(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, t, lat, lon, alt) of subtitle files: bracketed names, or GPS(a,b,..) where a value past 90 is the longitude."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", "\r", "").alias("v"))
    return subtitle_rows(raw.select("file", F.posexplode(F.split("v", r"\n\s*\n")).alias("seq", "block")))


def subtitle_rows(blocks: DataFrame, *, gps_order: str | None = None) -> DataFrame:
    """Fixes from (file, seq, block); blocks without a time or position, or at (0, 0), are dropped.

    GPS(a,b,..) is longitude and latitude, unless b is past 90, which only a longitude can be. Where the firmware's
    order is known, gps_order "lon_lat" or "lat_lon" states it, and nothing is told from sizes.
    """
    if gps_order not in (None, "lon_lat", "lat_lon"):
        raise ValueError(f"unknown order {gps_order}")
    b = F.col("block")
    stamp = r"(\d+):(\d+):(\d+)[,.](\d+)\s*-->"
    part = lambda i: F.nullif(F.regexp_extract(b, stamp, i), F.lit("")).cast("double")
    t = part(1) * 3600 + part(2) * 60 + part(3) + part(4) / F.pow(F.lit(10.0), F.length(F.regexp_extract(b, stamp, 4)))
    gps = r"(?i)GPS\s*\(\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)"
    a, c = (F.nullif(F.regexp_extract(b, gps, i), F.lit("")).cast("double") for i in (1, 2))
    turned = F.abs(c) > 90 if gps_order is None else F.lit(gps_order == "lat_lon")
    lat = F.coalesce(_number(b, "latitude"), F.when(turned, a).otherwise(c))
    lon = F.coalesce(_number(b, "longitude"), F.when(turned, c).otherwise(a))
    alt = F.coalesce(_number(b, "abs_alt"), _number(b, "BAROMETER"), _number(b, "rel_alt"), F.lit(0.0))
    rows = blocks.select("file", F.col("seq").cast("long").alias("seq"), t.alias("t"), lat.alias("lat"), lon.alias("lon"), alt.alias("alt"))
    return rows.where("t is not null and lat is not null and lon is not null and not (lat = 0 and lon = 0)")


# fixed values: accepted header names, first match wins
COLUMNS = {"t": ("time", "timestamp", "seconds"), "lat": ("latitude", "lat"), "lon": ("longitude", "lon", "lng"), "alt": ("altitude", "abs_alt", "alt", "height")}


def pick_column(names: list[str], wanted: tuple[str, ...]) -> str | None:
    """The column that a wanted name equals or begins; wanted names come before columns."""
    for w in wanted:
        for n in names:
            if n.strip().lower() == w or n.strip().lower().startswith(w):
                return n
    return None


def read_columns(spark: SparkSession, path: str) -> DataFrame:
    """A headed table of numbers: names in lower case, what is no number is null, columns without a name are left out, short rows end in nulls."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    named = {c.strip().lower(): c for c in raw.columns if c.strip() and not c.startswith("_c")}
    return raw.select(*(F.trim(F.col(f"`{c}`")).try_cast("double").alias(n) for n, c in named.items()))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, t, lat, lon, alt) of one headed flight log."""
    raw = spark.read.option("header", True).csv(path)
    rows = log_rows(raw, path)
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("file").orderBy("t", "lat", "lon", "alt")).cast("long") - 1).select("file", "seq", "t", "lat", "lon", "alt")


def read_telemetry(spark: SparkSession, path: str, images: tuple[int, int] | None = None) -> DataFrame:
    """(file, seq, t, lat, lon, alt, h_acc, v_acc) of subtitles, a flight log, or a folder of image logs, without repeated positions.

    Fewer than two fixes raise; accuracies are null where the source has none.
    """
    low = path.lower().rstrip("/")
    if low.endswith(".srt"):
        rows = read_subtitles(spark, path)
    elif low.endswith(".csv"):
        rows = read_log(spark, path)
    elif images:
        rows = image_log_fixes(spark, path, *images)
    else:
        raise ValueError(f"{path}: telemetry is an .srt or .csv file, or a folder of image logs with its first and last image")
    for c in ("h_acc", "v_acc"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("double"))
    rows = tracks.deduped(rows, "file", "seq")
    if rows.limit(2).count() < 2:
        raise ValueError(f"{path}: fewer than 2 positions")
    return rows


# fixed values: files and columns of image logs; clocks are in microseconds
GPS_LOG, BARO_LOG, POSE_LOG, TRUTH_LOG, CLOCK = "OnboardGPS.csv", "BarometricPressure.csv", "OnboardPose.csv", "GroundTruthAGL.csv", "timpstemp"


def _log_window(spark: SparkSession, folder: str, name: str, first: int, last: int, margin: float) -> DataFrame:
    """Rows of a log from margin seconds before the first image to margin after the last, with t from the first image on."""
    gps = read_columns(spark, f"{folder}/{GPS_LOG}")
    ends = gps.agg(F.min(F.when(F.col("imgid") == first, F.col(CLOCK))).alias("__a"), F.min(F.when(F.col("imgid") == last, F.col(CLOCK))).alias("__b"))
    rows = read_columns(spark, f"{folder}/{name}").crossJoin(F.broadcast(ends)).withColumn("t", (F.col(CLOCK) - F.col("__a")) / 1e6)
    return rows.where(F.col("t").between(-margin, (F.col("__b") - F.col("__a")) / 1e6 + margin)).drop("__a", "__b")


def image_log_fixes(spark: SparkSession, folder: str, first: int, last: int, margin: float = 10.0) -> DataFrame:
    """(file, seq, t, lat, lon, alt, h_acc, v_acc) of three-dimensional fixes; a vertical accuracy of a centimetre or less is unset."""
    g = _log_window(spark, folder, GPS_LOG, first, last, margin).where("fix_type >= 3")
    rows = g.select(F.lit(folder).alias("file"), "t", "lat", "lon", "alt", F.col("eph_m").alias("h_acc"), F.when(F.col("epv_m") > 0.01, F.col("epv_m")).alias("v_acc"))
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("file").orderBy("t")).cast("long") - 1)


def image_log_heights(spark: SparkSession, folder: str, first: int, last: int, margin: float = 10.0) -> DataFrame:
    """(t, alt) of the barometer."""
    return _log_window(spark, folder, BARO_LOG, first, last, margin).select("t", F.col("altitude").alias("alt"))


def image_log_attitudes(spark: SparkSession, folder: str, first: int, last: int, margin: float = 10.0) -> DataFrame:
    """(t, yaw, pitch, roll) in degrees."""
    p = _log_window(spark, folder, POSE_LOG, first, last, margin)
    angles = quaternion_angles(*(F.col(f"attitude_{c}") for c in "wxyz"))
    return p.select("t", *(a.alias(n) for a, n in zip(angles, ("yaw", "pitch", "roll"))))


def frame_times(images: DataFrame, first: int, last: int) -> DataFrame:
    """(imgid, t): seconds since the first of a range of images, by their own clock."""
    some = images.where(F.col("imgid").between(first, last)).select(F.col("imgid").cast("long").alias("imgid"), F.col(CLOCK).alias("__c"))
    start = some.agg(F.min_by("__c", "imgid").alias("__s"))
    return some.crossJoin(F.broadcast(start)).select("imgid", ((F.col("__c") - F.col("__s")) / 1e6).alias("t"))


def reference_poses(poses: DataFrame, keyframes: DataFrame, first: int) -> DataFrame:
    """Keyframes (name, frame) within the range of reference poses (imgid, x_gt, y_gt, z_gt), with the pose between the images around theirs."""
    ref = poses.where(F.col("imgid").isNotNull() & ~F.isnan("imgid")).select(F.lit(0).alias("flight_id"), F.col("imgid").alias("t"), "x_gt", "y_gt", "z_gt")
    span = ref.agg(F.min("t").alias("__a"), F.max("t").alias("__b"))
    rows = keyframes.withColumn("q", F.col("frame") + F.lit(float(first))).crossJoin(F.broadcast(span)).where(F.col("q").between(F.col("__a"), F.col("__b"))).drop("__a", "__b")
    for c in ("x_gt", "y_gt", "z_gt"):
        at = tracks.interpolated(rows.select(F.lit(0).alias("flight_id"), "q").distinct(), ref, c).select("q", F.col(c).alias("r" + c[0]))
        rows = rows.join(at, "q")
    return rows.drop("q")


# fixed values: names of columns in tables of photo positions, first match wins
TABLE = {"lat": ("lat", "latitude"), "lon": ("lon", "lng", "longitude"), "alt": ("alt", "altitude", "abs_alt"), "id": ("imgid", "image_id", "id", "frame"), "time": ("headerstamp", "timestamp", "timpstemp", "time", "t")}


def photo_positions(photos: DataFrame, table: DataFrame, match: str = "id") -> DataFrame:
    """Photos (name) with lat, lon, alt from a table of text columns: by the number in their file name, equal to an id, or as a time between two rows.

    A name that is no number has no position; times outside of the table have none either.
    """
    names = {c.strip().lower(): c for c in table.columns}
    pick = lambda k: next((F.col(f"`{names[n]}`") for n in TABLE[k] if n in names), None)
    if match not in ("id", "time") or any(pick(k) is None for k in ("lat", "lon", match)):
        raise ValueError(f"the table needs a column of {match}, lat and lon; it has {table.columns}")
    num = lambda c: F.trim(c).try_cast("double")
    alt = F.coalesce(num(pick("alt")), F.lit(0.0)) if pick("alt") is not None else F.lit(0.0)
    known = table.select(num(pick(match)).alias("k"), num(pick("lat")).alias("lat"), num(pick("lon")).alias("lon"), alt.alias("alt")).where("k is not null and lat is not null and lon is not null")
    rows = photos.withColumn("k", F.regexp_replace("name", r"\.[^.]*$", "").try_cast("double"))
    if match == "id":
        one = known.groupBy("k").agg(F.min(F.struct("lat", "lon", "alt")).alias("p"))
        return rows.join(one, "k", "left").select(*photos.columns, "p.lat", "p.lon", "p.alt")
    fix = known.select(F.lit(0).alias("flight_id"), F.col("k").alias("t"), "lat", "lon", "alt")
    for c in ("lat", "lon", "alt"):
        at = tracks.interpolated(rows.where("k is not null").select(F.lit(0).alias("flight_id"), F.col("k").alias("q")).distinct(), fix, c, slack=0.0).select(F.col("q").alias("k"), c)
        rows = rows.join(at, "k", "left")
    return rows.drop("k")


def ordered_photos(photos: DataFrame, key: str = "folder") -> DataFrame:
    """Photos (key, name, taken) with seq: by capture time and name where all of a folder have a time, else by name."""
    all_timed = F.min(F.col("taken").isNotNull()).over(Window.partitionBy(key))
    p = photos.withColumn("__t", F.when(all_timed, F.col("taken")))
    return p.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy("__t", "name")).cast("long") - 1).drop("__t")


def capture_time(text: Column) -> Column:
    """Time in photos' own notation; null where it is none."""
    return F.try_to_timestamp(F.trim(F.replace(text, F.lit("\0"), F.lit(""))), F.lit("yyyy:MM:dd HH:mm:ss"))


def log_rows(raw: DataFrame, file: str = "log") -> DataFrame:
    """(file, t, lat, lon, alt) of a headed log whose columns are text; times start at 0, bad rows are dropped."""
    found = {k: pick_column(raw.columns, w) for k, w in COLUMNS.items()}
    if None in (found["t"], found["lat"], found["lon"]):
        raise ValueError("the log has no time, latitude or longitude column")
    col = lambda k: F.col(f"`{found[k]}`")
    scale = 0.001 if re.search("ms|milli", found["t"].lower()) else 1.0
    t = F.coalesce(col("t").try_cast("double") * scale, F.unix_micros(F.try_to_timestamp(col("t"))) / 1e6)
    alt = F.coalesce(col("alt").try_cast("double"), F.lit(0.0)) if found["alt"] else F.lit(0.0)
    rows = raw.select(F.lit(file).alias("file"), t.alias("t"), col("lat").try_cast("double").alias("lat"), col("lon").try_cast("double").alias("lon"), alt.alias("alt"))
    rows = rows.where("t is not null and lat is not null and lon is not null and not (lat = 0 and lon = 0)")
    return rows.withColumn("t", F.col("t") - F.min("t").over(Window.partitionBy("file")))


def srt_time(t: Column) -> Column:
    ms = F.round(t * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.pmod(F.floor(ms / 60000), F.lit(60)), F.pmod(F.floor(ms / 1000), F.lit(60)), F.pmod(ms, F.lit(1000)))


def subtitle_blocks(fixes: DataFrame, key: str = "flight_id") -> DataFrame:
    """(key, seq, block): the text of one subtitle for each fix, which lasts until the next."""
    w = Window.partitionBy(key).orderBy("seq")
    until = F.coalesce(F.lead("t").over(w), F.col("t") + 0.5)
    body = F.format_string("[latitude: %.7f] [longitude: %.7f] [rel_alt: 0.000 abs_alt: %.3f]", F.col("lat"), F.col("lon"), F.col("alt"))
    return fixes.select(key, "seq", F.concat((F.col("seq") + 1).cast("string"), F.lit("\n"), srt_time(F.col("t")), F.lit(" --> "), srt_time(until), F.lit("\n"), body).alias("block"))


def geo_lines(rows: DataFrame) -> DataFrame:
    """One georeferencing line for each image: name lon lat alt, three unknown angles, and accuracies of 5 cm or more."""
    low = lambda c: F.greatest(F.col(c).cast("double"), F.lit(0.05))
    return rows.select("name", F.format_string("%s %.9f %.9f %.3f nan nan nan %.3f %.3f", "name", *(F.col(c).cast("double") for c in ("lon", "lat", "alt")), low("h_std"), low("v_std")).alias("line"))
