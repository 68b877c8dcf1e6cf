"""Readers of building models, meshes and uncompressed point files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geodesy import utm_epsg

POINT_SCHEMA = "file string, point_id long, x double, y double, z double, red int, green int, blue int, classification short"


def building_surfaces(records: DataFrame, box: tuple[float, float, float, float] | None = None, prefix: str = "bldg") -> DataFrame:
    """(id, kind, ring) of rows that hold one building's markup each; with a box (x0, y0, x1, y1) only buildings with a corner in it."""
    rings = (
        records.select("value", F.regexp_extract("value", rf"<{prefix}:Building\b[^>]*?\bgml:id=\"([^\"]*)\"", 1).alias("id"))
        .where(F.col("value").contains(f"<{prefix}:Building"))
        .withColumn("surface", F.explode(F.regexp_extract_all("value", F.lit(rf"(?s)<{prefix}:((?:Wall|Roof|Ground)Surface)\b.*?</{prefix}:\1>"), F.lit(0))))
        .withColumn("kind", F.lower(F.regexp_extract("surface", rf"^<{prefix}:(Wall|Roof|Ground)Surface", 1)))
        .withColumn("list", F.explode(F.regexp_extract_all("surface", F.lit(r"<gml:posList[^>]*>([^<]*)</gml:posList>"), F.lit(1))))
        .withColumn("n", F.transform(F.split(F.trim(F.regexp_replace("list", r"\s+", " ")), " "), lambda v: v.try_cast("double")))
        .where(F.size("n") >= 3)
    )
    at = lambda i, k: F.get(F.col("n"), i * 3 + k)
    rings = rings.select("id", "kind", F.transform(F.sequence(F.lit(0), F.floor(F.size("n") / 3).cast("int") - 1), lambda i: F.struct(at(i, 0).alias("x"), at(i, 1).alias("y"), at(i, 2).alias("z"))).alias("ring"))
    if box is None:
        return rings
    x0, y0, x1, y1 = box
    near = rings.where(F.exists("ring", lambda p: p["x"].between(x0, x1) & p["y"].between(y0, y1))).select("id").distinct()
    return rings.join(near, "id", "left_semi")


def read_buildings(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, prefix: str = "bldg") -> DataFrame:
    """Files are split at the end of each building, so one large file is read by many tasks."""
    return building_surfaces(spark.read.option("lineSep", f"</{prefix}:Building>").text(path), box, prefix)


def read_mesh(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vertices (file, id, x, y, z) and faces (file, id, corners) of mesh texts; ids count from 0 in each file, a file is one row."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.filter(F.split("value", r"\r?\n"), lambda v: v.rlike("^[vf] ")).alias("lines"))

    def numbered(kind: str) -> DataFrame:
        mine = F.transform(F.filter("lines", lambda v: v.startswith(f"{kind} ")), lambda v: F.split(F.trim(v), r"\s+"))
        return files.select("file", F.posexplode(mine).alias("id", "part"))

    verts = numbered("v").select("file", "id", *(F.col("part")[i + 1].cast("double").alias(c) for i, c in enumerate("xyz")))
    faces = numbered("f").select("file", "id", F.transform(F.slice("part", 2, F.size("part") - 1), lambda v: F.substring_index(v, "/", 1).cast("int") - 1).alias("corners"))
    return verts, faces


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of uncompressed files of formats 6 and 7 (a task a file, at most 2 GB each); other formats raise."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, raw in zip(batch["path"], batch["content"]):
                start, kind, width = (int(np.frombuffer(raw, t, 1, at)[0]) for t, at in (("<u4", 96), ("u1", 104), ("<u2", 105)))
                if raw[:4] != b"LASF" or kind not in (6, 7):
                    raise ValueError(f"{name}: not an uncompressed point file of format 6 or 7")
                size, (scale, base) = int(np.frombuffer(raw, "<u8", 1, 247)[0]), np.frombuffer(raw, "<f8", 6, 131).reshape(2, 3)
                fields = {"xyz": ("<3i4", 0), "cls": ("u1", 16)} | ({"rgb": ("<3u2", 30)} if kind == 7 else {})
                layout = np.dtype({"names": list(fields), "formats": [f for f, _ in fields.values()], "offsets": [o for _, o in fields.values()], "itemsize": width})
                for first in range(0, size, 500_000):
                    p = np.frombuffer(raw, layout, min(500_000, size - first), start + first * width)
                    xyz, rgb = p["xyz"] * scale + base, p["rgb"] if kind == 7 else np.zeros((len(p), 3), int)
                    yield pd.DataFrame({"file": name, "point_id": np.arange(first, first + len(p)), **{c: xyz[:, i] for i, c in enumerate("xyz")}, **{c: rgb[:, i].astype("i4") for i, c in enumerate(("red", "green", "blue"))}, "classification": p["cls"].astype("i2")})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, POINT_SCHEMA)


_CAMERA = ["kind", "width", "height", "focal", "focal_x", "focal_y", "c_x", "c_y", "k1", "k2", "k3", "p1", "p2"]


def read_reconstruction(spark: SparkSession, path: str) -> DataFrame:
    """(shot, camera, rx, ry, rz, tx, ty, tz, kind, width, ... p2) of the first model of a reconstruction file."""
    camera = "struct<projection_type:string,width:int,height:int,focal:double,focal_x:double,focal_y:double,c_x:double,c_y:double,k1:double,k2:double,k3:double,p1:double,p2:double>"
    kind = f"array<struct<cameras:map<string,{camera}>,shots:map<string,struct<rotation:array<double>,translation:array<double>,camera:string>>>>"
    model = spark.read.text(path, wholetext=True).select(F.from_json("value", kind)[0].alias("m"))
    shots = model.select("m.cameras", F.explode("m.shots").alias("shot", "s"))
    c = F.col("cameras")[F.col("s.camera")]
    return shots.select("shot", F.col("s.camera").alias("camera"), *(F.col("s.rotation")[i].alias(f"r{a}") for i, a in enumerate("xyz")), *(F.col("s.translation")[i].alias(f"t{a}") for i, a in enumerate("xyz")), c["projection_type"].alias("kind"), *(c[n].alias(n) for n in _CAMERA[1:]))


def read_georeference(spark: SparkSession, path: str) -> DataFrame:
    """(epsg, east, north): zone and offset from a reconstruction's text of coordinates."""
    lines = F.split("value", r"\r?\n")
    part = F.split(F.trim(lines[1]), r"\s+")
    return spark.read.text(path, wholetext=True).select(utm_epsg(lines[0]).alias("epsg"), part[0].try_cast("double").alias("east"), F.get(part, F.lit(1)).try_cast("double").alias("north"))


def cloud_epsg(header: int | None, spark: SparkSession, path: str) -> int:
    """The header's code, else that of the coordinates beside the cloud; raises without either."""
    if header:
        return header
    found = read_georeference(spark, path).first()
    if found is None or found.epsg is None:
        raise ValueError("the cloud's coordinate system is not known")
    return found.epsg


def read_calibration(spark: SparkSession, path: str) -> DataFrame:
    """(fx, fy, px, py, dist, size_w, size_h) of a calibration in JSON."""
    c = spark.read.text(path, wholetext=True).select(F.from_json("value", "K array<array<double>>, dist array<double>, size array<int>").alias("c"))
    k = F.col("c.K")
    return c.select(k[0][0].alias("fx"), k[1][1].alias("fy"), k[0][2].alias("px"), k[1][2].alias("py"), F.col("c.dist").alias("dist"), F.get("c.size", F.lit(0)).alias("size_w"), F.get("c.size", F.lit(1)).alias("size_h"))


def read_way(spark: SparkSession, path: str, way: int) -> DataFrame:
    """(id, ring of (lat, lon), tags) of an outline in a map service's answer; ways without a geometry are left out."""
    kind = "elements array<struct<id:long,geometry:array<struct<lat:double,lon:double>>,tags:map<string,string>>>"
    e = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)["elements"]).alias("e"))
    return e.where((F.col("e.id") == way) & (F.size("e.geometry") > 0)).select("e.id", F.col("e.geometry").alias("ring"), "e.tags").limit(1)
