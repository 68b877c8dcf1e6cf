"""Cameras: poses, projection of points into photos and back, votes of label pictures, exposure, intrinsics, letterboxes, gap candidates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fits
from .points import majority, visible

#: Shots that are broadcast to the points at most: a row of some 200 bytes each.
MOST_SHOTS = 200_000

# fixed values: name, code of the point file standard, colour, labels of the picture model that belong to it
CLASSES = [
    ("unlabelled", 1, (128, 128, 128), []),
    ("ground", 2, (160, 120, 70), ["earth", "sand", "field", "land", "mountain", "hill", "rock", "dirt track"]),
    ("low vegetation", 3, (130, 210, 100), ["grass", "flower"]),
    ("high vegetation", 5, (40, 140, 40), ["tree", "plant", "palm"]),
    ("building", 6, (220, 60, 60), ["building", "house", "wall", "skyscraper", "hovel", "tower", "door", "windowpane", "awning", "roof", "column", "canopy", "booth"]),
    ("water", 9, (40, 130, 200), ["water", "sea", "river", "lake", "pool", "swimming pool", "fountain"]),
    ("road", 11, (150, 150, 150), ["road", "sidewalk", "path", "runway", "floor", "stairs", "step", "stairway"]),
    ("vehicle", 64, (255, 210, 0), ["car", "truck", "bus", "van", "bicycle", "minibike", "boat", "ship", "airplane"]),
    ("person", 65, (255, 0, 255), ["person", "animal"]),
    ("structure", 66, (255, 150, 0), ["fence", "pole", "streetlight", "signboard", "railing", "bridge", "bench", "traffic light", "bannister", "pier", "flag"]),
    ("sky", 1, (135, 206, 235), ["sky"]),
]
SKY = 10
#: Classes that estimated points may have.
FILLABLE = (1, 2, 3, 4, 6)


def class_of(label: Column) -> Column:
    """Class number of a picture model's label; 0 for labels of no class."""
    pairs = [F.lit(x) for k, (*_, labels) in enumerate(CLASSES) for name in labels for x in (name, k)]
    return F.coalesce(F.create_map(*pairs)[F.lower(F.trim(label))], F.lit(0))


def class_code(cls: Column) -> Column:
    return F.when(cls.isNotNull(), F.get(F.array(*(F.lit(c[1]) for c in CLASSES)), cls.cast("int")))


def legend(rows: DataFrame, code: str = "classification") -> DataFrame:
    """(code, name, colour, n, share) of the codes that occur; the first class of a code names it, sky has no part; other codes are shown as code 1."""
    first: dict[int, tuple] = {}
    for name, c, colour, _ in CLASSES[:SKY]:
        first.setdefault(c, (name, colour))
    named = F.create_map(*(F.lit(x) for c, (name, _) in first.items() for x in (c, name)))
    colours = F.create_map(*(x for c, (_, colour) in first.items() for x in (F.lit(c), F.array(*map(F.lit, colour)))))
    known = F.when(F.col(code).cast("int").isin(list(first)), F.col(code).cast("int")).otherwise(1)
    n = rows.groupBy(known.alias("code")).agg(F.count("*").alias("n"))
    return n.select("code", named[F.col("code")].alias("name"), colours[F.col("code")].alias("colour"), "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def rotation(rx: Column, ry: Column, rz: Column) -> list[list[Column]]:
    """The matrix of an axis times its angle; the unit matrix for angle 0."""
    angle = F.sqrt(rx * rx + ry * ry + rz * rz)
    x, y, z = (F.coalesce(F.try_divide(v, angle), F.lit(0.0)) for v in (rx, ry, rz))
    c, s = F.cos(angle), F.sin(angle)
    k = 1 - c
    return [[c + x * x * k, x * y * k - z * s, x * z * k + y * s], [y * x * k + z * s, c + y * y * k, y * z * k - x * s], [z * x * k - y * s, z * y * k + x * s, c + z * z * k]]


def with_pose(shots: DataFrame) -> DataFrame:
    """Adds the matrix r00 to r22 and the centre cx, cy, cz of shots with rotation (rx, ry, rz) and translation (tx, ty, tz)."""
    m = rotation(F.col("rx"), F.col("ry"), F.col("rz"))
    out = shots.withColumns({f"r{i}{j}": m[i][j] for i in range(3) for j in range(3)})
    return out.withColumns({f"c{a}": -sum((F.col(f"r{i}{j}") * F.col(f"t{b}") for i, b in list(enumerate("xyz"))[1:]), F.col(f"r0{j}") * F.col("tx")) for j, a in enumerate("xyz")})


def pixel(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Pixel column and row of a point in camera axes, by the camera's columns; null where depth is 0.

    kind brown has k1, k2, k3, p1, p2, focal_x, focal_y, c_x and c_y; others have focal, k1 and k2. Lengths are shares of the longer side.
    """
    u, v = F.try_divide(x, z), F.try_divide(y, z)
    r2 = u * u + v * v
    k = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    bend = 1 + k("k1") * r2 + k("k2") * r2 * r2
    full = bend + k("k3") * r2 * r2 * r2
    bu = u * full + 2 * k("p1") * u * v + k("p2") * (r2 + 2 * u * u)
    bv = v * full + k("p1") * (r2 + 2 * v * v) + 2 * k("p2") * u * v
    size, brown = F.greatest("width", "height"), F.col("kind") == "brown"
    col = F.when(brown, (F.col("focal_x") * bu + F.col("c_x")) * size).otherwise(F.col("focal") * u * bend * size)
    row = F.when(brown, (F.col("focal_y") * bv + F.col("c_y")) * size).otherwise(F.col("focal") * v * bend * size)
    return col - 0.5 + F.col("width") / 2, row - 0.5 + F.col("height") / 2


def in_view(points: DataFrame, shots: DataFrame, least_depth: float = 0.5) -> DataFrame:
    """(point_id, shot, u, v, depth, width, height) of every point in every shot that it falls into, farther than the least depth.

    Each point meets each shot, as the operation asks; the shots' number is checked before they are sent to the points.
    """
    if (n := shots.count()) > MOST_SHOTS:
        raise ValueError(f"{n} shots are too many to send to all points; split them")
    met = points.select("point_id", *"xyz").crossJoin(F.broadcast(with_pose(shots)))
    axis = lambda i: F.col(f"r{i}0") * F.col("x") + F.col(f"r{i}1") * F.col("y") + F.col(f"r{i}2") * F.col("z") + F.col("t" + "xyz"[i])
    met = met.select("point_id", *(c for c in shots.columns if c not in ("rx", "ry", "rz", "tx", "ty", "tz")), axis(0).alias("px"), axis(1).alias("py"), axis(2).alias("depth")).where(F.col("depth") > least_depth)
    u, v = pixel(F.col("px"), F.col("py"), F.col("depth"))
    seen = met.select("point_id", "shot", u.alias("u"), v.alias("v"), "depth", "width", "height")
    return seen.where((F.col("u") >= 0) & (F.col("u") < F.col("width")) & (F.col("v") >= 0) & (F.col("v") < F.col("height")))


def unhidden(seen: DataFrame, scale: float = 0.25, share: float = 0.01, slack: float = 0.3) -> DataFrame:
    """Points in view that are not behind the nearest one of their cell, a picture at the scale."""
    cells = seen.withColumns({"__r": F.floor(F.col("v") * scale), "__c": F.floor(F.col("u") * scale)})
    return visible(cells, ["shot", "__r", "__c"], "depth", share, slack).drop("__r", "__c")


def labelled(seen: DataFrame, labels: DataFrame, rows: int, cols: int) -> DataFrame:
    """Adds cls, the label under each point, from pictures (shot, row, col, cls) of rows by cols; shots without a picture are left out."""
    at = lambda x, size, n: F.least(F.floor(F.col(x) * n / F.col(size)), F.lit(n - 1)).cast("long")
    return seen.withColumns({"row": at("v", "height", rows), "col": at("u", "width", cols)}).join(labels, ["shot", "row", "col"])


def classified(points: DataFrame, votes: DataFrame, least: int = 2) -> DataFrame:
    """Points with views, cls (voted class or null) and classification: the voted class's code, else the point's own."""
    won = majority(votes, least, (0, SKY)).withColumnRenamed("voted", "cls")
    out = points.drop("cls", "views").join(won, "point_id", "left").withColumn("views", F.coalesce("views", F.lit(0)))
    return out.withColumn("classification", F.coalesce(class_code(F.col("cls")), F.col("classification")).cast("int"))


def classification_summary(rows: DataFrame) -> DataFrame:
    """One row: points, labelled share, median views (whole), share seen by two or more."""
    return rows.agg(F.count("*").alias("points"), F.round(F.avg(F.col("cls").isNotNull().cast("double")), 3).alias("labelled_share"), F.floor(F.median("views")).cast("long").alias("median_views"), F.round(F.avg((F.col("views") >= 2).cast("double")), 3).alias("seen_twice"))


def pixel_shares(labels: DataFrame, least: float = 0.001) -> DataFrame:
    """(cls, name, share) of the classes that have more than the least share of all pixels."""
    names = F.array(*(F.lit(c[0]) for c in CLASSES))
    n = labels.groupBy("cls").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return n.withColumn("share", share).where(F.col("share") > least).select("cls", F.element_at(names, F.col("cls").cast("int") + 1).alias("name"), F.round("share", 3).alias("share"))


def detections(rows: DataFrame, moving: Iterable[str]) -> DataFrame:
    """(label, n) of detected objects that move."""
    return rows.where(F.col("label").isin(list(moving))).groupBy("label").agg(F.count("*").alias("n"))


def mask_summary(masks: DataFrame, most: float = 0.85) -> DataFrame:
    """One row of masks (name, share): frames, written, their mean share, and the names left out as nearly all is masked."""
    ok = F.col("share") <= most
    return masks.agg(F.count("*").alias("frames"), F.count_if(ok).alias("written"), F.round(F.coalesce(F.avg(F.when(ok, F.col("share"))), F.lit(0.0)), 3).alias("mean_share"), F.array_sort(F.collect_list(F.when(~ok, F.col("name")))).alias("left_out"))


def exposure(stats: DataFrame, strength: float = 0.7) -> DataFrame:
    """(name, gain, shift) that draw each photo's (mean, std) of lightness part of the way to the medians of all."""
    goal = stats.agg(F.median("mean").alias("__m"), F.median("std").alias("__s"))
    gain = 1 + strength * (F.col("__s") / F.greatest("std", F.lit(1e-3)) - 1)
    return stats.crossJoin(F.broadcast(goal)).select("name", gain.alias("gain"), (strength * (F.col("__m") - F.col("mean"))).alias("shift"))


def exposure_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(F.round(F.median("mean"), 1).alias("target"), F.round(F.min("mean"), 1).alias("low"), F.round(F.max("mean"), 1).alias("high"))


def intrinsics(cameras: DataFrame) -> DataFrame:
    """Cameras (fx, fy, px, py, size_w, size_h or null, frame_w, frame_h, crop x0, y0, x1, y1) scaled to the frame and moved by the crop, with focal35."""
    sx, sy = (F.coalesce(F.col(f"frame_{a}") / F.col(f"size_{a}"), F.lit(1.0)) for a in "wh")
    out = cameras.withColumns({"fx": F.col("fx") * sx, "fy": F.col("fy") * sy, "px": F.col("px") * sx - F.col("x0"), "py": F.col("py") * sy - F.col("y0"), "width": F.col("x1") - F.col("x0"), "height": F.col("y1") - F.col("y0")})
    return out.withColumn("focal35", 36.0 * F.col("fx") / F.col("width")).drop("size_w", "size_h", "frame_w", "frame_h", "x0", "y0", "x1", "y1")


def lit_span(profile: DataFrame, *keys: str, dark: float = 20.0) -> DataFrame:
    """(keys, first, end) of the lit part of a brightness profile (i, value); bars below 2 % on both sides are no bars, others lose 2 pixels more."""
    lit = F.when(F.col("value") > dark, F.col("i"))
    g = profile.groupBy(*keys).agg(F.count("*").alias("n"), F.min(lit).alias("a"), (F.max(lit) + 1).alias("b"))
    whole = F.col("a").isNull() | ((F.col("a") < 0.02 * F.col("n")) & (F.col("n") - F.col("b") < 0.02 * F.col("n")))
    return g.select(*keys, F.when(whole, 0).otherwise(F.least(F.col("a") + 2, F.col("n"))).cast("long").alias("first"), F.when(whole, F.col("n")).otherwise(F.greatest(F.col("b") - 2, F.lit(0))).cast("long").alias("end"))


def back_projected(cells: DataFrame, shots: DataFrame, cell: int = 2) -> DataFrame:
    """(shot, col, row, x, y, z) of cells (shot, col, row, depth): the middle of each cell at its depth, in the points' axes."""
    size = F.greatest("width", "height")
    fx = F.coalesce("focal_x", "focal")
    at = lambda c, side, shift, f: ((((F.col(c) + 0.5) * cell + 0.5 - F.col(side) / 2) / size - F.coalesce(F.col(shift), F.lit(0.0))) / f) * F.col("depth")
    met = cells.join(F.broadcast(with_pose(shots)), "shot")
    met = met.withColumns({"q0": at("col", "width", "c_x", fx) - F.col("tx"), "q1": at("row", "height", "c_y", F.coalesce(F.col("focal_y"), fx)) - F.col("ty"), "q2": F.col("depth") - F.col("tz")})
    return met.select("shot", "col", "row", *((F.col("q0") * F.col(f"r0{j}") + F.col("q1") * F.col(f"r1{j}") + F.col("q2") * F.col(f"r2{j}")).alias(a) for j, a in enumerate("xyz")))


def depth_fits(near: DataFrame, guessed: DataFrame, least_cells: int = 500, most_error: float = 0.10) -> DataFrame:
    """(shot, slope, intercept, error, low, high, used) from nearest depths (shot, col, row, depth) and guessed ones (shot, col, row, guess).

    1 / depth is fitted as a line of the guess; error is the median relative one; shots with few cells have no row, and those with a
    large error are not used. low and high are the 2nd and 98th percentile of depth.
    """
    many = near.groupBy("shot").agg(F.count("*").alias("cells"), F.percentile("depth", F.lit(0.02)).alias("low"), F.percentile("depth", F.lit(0.98)).alias("high")).where(F.col("cells") >= least_cells)
    both = near.join(guessed, ["shot", "col", "row"]).join(F.broadcast(many.select("shot")), "shot", "left_semi").withColumn("near", 1 / F.col("depth"))
    line = fits.robust_line(both, "guess", "near", "shot")
    depth = F.try_divide(F.lit(1.0), F.col("slope") * F.col("guess") + F.col("intercept"))
    off = both.join(line, "shot").withColumn("fit", depth).where(F.col("fit") > 0).groupBy("shot").agg(F.median(F.abs(F.col("fit") - F.col("depth")) / F.col("depth")).alias("error"))
    out = many.join(line, "shot", "left").join(off, "shot", "left").withColumn("error", F.coalesce("error", F.lit(1.0)))
    return out.select("shot", "slope", "intercept", "error", "low", "high", (F.col("error") <= most_error).alias("used"))


def gap_cells(labels: DataFrame, near: DataFrame, reach: int, step: int = 2, fillable: tuple[int, ...] = FILLABLE) -> DataFrame:
    """(shot, col, row) of cells on every step-th column and row with a fillable label and no depth within reach."""
    holes = labels.where(F.col("cls").isin(list(fillable)) & (F.col("col") % step == 0) & (F.col("row") % step == 0)).select("shot", "col", "row")
    span = F.sequence(F.lit(-reach), F.lit(reach))
    close = near.select("shot", F.explode(F.transform(span, lambda a: F.col("col") + a)).alias("col"), "row").distinct()
    close = close.select("shot", "col", F.explode(F.transform(span, lambda a: F.col("row") + a)).alias("row"))
    return holes.join(close, ["shot", "col", "row"], "left_anti")


def gap_points(cells: DataFrame, guessed: DataFrame, fitted: DataFrame) -> DataFrame:
    """Cells with the depth of the shot's fit, where the shot is used and the depth lies between its percentiles."""
    met = cells.join(guessed, ["shot", "col", "row"]).join(F.broadcast(fitted.where("used")), "shot")
    depth = F.try_divide(F.lit(1.0), F.col("slope") * F.col("guess") + F.col("intercept"))
    return met.withColumn("depth", depth).where(F.col("depth").between(F.col("low"), F.col("high"))).select("shot", "col", "row", "depth")


def measured(lines: DataFrame) -> DataFrame:
    """Lines between two picked points (a and b of x, y, z) with their length and difference in height, to the centimetre."""
    d = [F.col(f"a.{c}") - F.col(f"b.{c}") for c in "xyz"]
    return lines.withColumns({"distance": F.round(F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]), 2), "height": F.round(F.abs(d[2]), 2)}).drop("a", "b")
