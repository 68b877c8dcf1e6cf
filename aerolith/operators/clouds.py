"""Operators on clouds and footprints: neighbours, normals, alignment, gap filling, samples, polygons, matching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import grouped, stored
from .fits import similarity_fit
from .points import blocks, distinct_rows, first_reach, nearest_in_cells, nearest_points


def icp(cloud: DataFrame, ref: DataFrame, *, levels: tuple[float, ...] = (8.0, 4.0, 2.0, 1.0, 0.5), rounds: int = 8, least: int = 1000, scaled: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
    """(scale, rotation, shift) that bring the cloud onto the reference; a level ends early below the least number of matches.

    The transform so far is three linear columns on the first cloud, so plans don't grow with the rounds.
    """
    scale, rot, shift = 1.0, np.eye(3), np.zeros(3)
    for radius in levels:
        for _ in range(rounds):
            moved = cloud.select("point_id", *((sum((F.col(b) * float(scale * rot[i, j]) for j, b in enumerate("xyz")), F.lit(float(shift[i])))).alias(a) for i, a in enumerate("xyz")))
            pairs = stored(nearest_points(moved, ref, radius), "icp")
            if pairs.count() < least:
                break
            s, r, t = similarity_fit(pairs, scaled)
            scale, rot, shift = s * scale, r @ rot, s * (r @ shift) + t
    return scale, rot, shift


_NEAR = "array<struct<x:double,y:double,z:double>>"


def _around(points: DataFrame, k: int, radius: float, finish: Callable[[np.ndarray], list[pa.Array]], columns: str) -> tuple[DataFrame, DataFrame]:
    """(point_id, x, y, z and the columns that `finish` makes of the coordinates of the k nearest of each point; the points left out).

    Of equal places only the k lowest ids can be near to anything. Further points of such a place are left out: their k nearest
    are the place itself, k times. The first round has a reach that suits the density; points whose k nearest don't all lie within it
    go on with twice the reach, and only cubes with such points are looked at again. Points without a place are near to nothing.
    """
    kind = points.schema["point_id"].dataType.simpleString()
    spark, keys = points.sparkSession, ["level", "bx", "by", "bz"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    nth = F.row_number().over(Window.partitionBy(*"xyz").orderBy("point_id"))
    placed = points.select("point_id", *"xyz").where(" and ".join(f"{c} is not null and not isnan({c})" for c in "xyz"))
    numbered = stored(placed.withColumn("nth", nth), "points")
    near, more = numbered.where(F.col("nth") <= k).drop("nth"), numbered.where(F.col("nth") > k).drop("nth")
    k = min(k, near.count())
    todo, done, reach = near, None, first_reach(near, radius, max(k, 1))
    while True:

        def search(batches: Iterator[pa.RecordBatch], reach=reach) -> Iterator[pa.RecordBatch]:
            for t in grouped(batches, keys):
                t = t.sort_by([(c, "ascending") for c in ("point_id", *"xyz")])
                x = np.stack([t.column(c).to_numpy() for c in "xyz"], 1)
                ask = t.column("asks").to_numpy(zero_copy_only=False)
                if not ask.any():
                    continue
                # a point that asks is there a second time, as one that is found
                own, other = t.filter(pa.array(ask)).select(["point_id", *"xyz"]), x[~ask]
                once, back = distinct_rows(x[ask])
                found, sure = nearest_in_cells(other, np.arange(len(other)), x[ask][once], k, reach)
                made = finish(other[found[back]] if len(other) else np.zeros((len(back), k, 3)))
                yield pa.RecordBatch.from_arrays([*own.combine_chunks().to_batches()[0].columns, *made, pa.array(sure[back])], names=[*own.column_names, *(c.split()[0] for c in columns.split(", ")), "sure"])

        both = todo.withColumn("asks", F.lit(True)).unionByName(near.withColumn("asks", F.lit(False)))
        dealt = blocks(both, reach * (1 + 1e-9), 16_000, 8, "asks", tasks).drop("inner").sortWithinPartitions(*keys)
        found = stored(dealt.mapInArrow(search, f"point_id {kind}, x double, y double, z double, {columns}, sure boolean"), "near")
        full = found.where("sure").drop("sure")
        done = full if done is None else done.unionByName(full)
        todo = found.where("not sure").select("point_id", *"xyz")
        if todo.isEmpty():
            return done, more
        reach *= 2


def neighbours(points: DataFrame, k: int, radius: float) -> DataFrame:
    """(point_id, x, y, z, near): the k nearest points, itself included, ties by id; fewer only where the cloud is smaller."""

    def lists(near: np.ndarray) -> list[pa.Array]:
        flat = pa.StructArray.from_arrays([pa.array(near[:, :, j].ravel()) for j in range(3)], list("xyz"))
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]), flat)]

    found, more = _around(points, k, radius, lists, f"near {_NEAR.replace(', ', ',')}")
    return found.unionByName(more.withColumn("near", F.array_repeat(F.struct(*"xyz"), k).cast(_NEAR)))


def normals(points: DataFrame, k: int = 16, radius: float = 1.0) -> DataFrame:
    """(point_id, nx, ny, nz, flatness): least axis of each neighbourhood, and its share of the spread; null where there is no spread."""

    def eigen(near: np.ndarray) -> list[pa.Array]:
        off = near - near.mean(1, keepdims=True) if near.shape[1] else near
        spread = np.einsum("nki,nkj->nij", off, off) / max(1, near.shape[1])
        size, axes = np.linalg.eigh(spread)
        total = size.sum(1)
        none = (near == near[:, :1]).all((1, 2)) | (total <= 0)
        flat = size[:, 0] / np.where(total > 0, total, 1.0)
        return [pa.array(np.ascontiguousarray(c), mask=none) for c in (axes[:, 0, 0], axes[:, 1, 0], axes[:, 2, 0], flat)]

    names = ("nx", "ny", "nz", "flatness")
    found, more = _around(points, k, radius, eigen, ", ".join(f"{c} double" for c in names))
    return found.select("point_id", *names).unionByName(more.select("point_id", *(F.lit(None).cast("double").alias(c) for c in names)))


def gap_filled(measured: DataFrame, offered: DataFrame, *, voxel: float = 0.15, least: float = 0.15, most: float = 1.5, share: float = 0.15) -> DataFrame:
    """(point_id, x, y, z, d): offered points, one a voxel, that extend the measured ones; at most a share of them, the closest first."""
    cells = {f"v{c}": F.floor(F.col(c) / voxel) for c in "xyz"}
    first = offered.withColumns(cells).groupBy(*cells).agg(F.min_by(F.struct("point_id", *"xyz"), "point_id").alias("p")).select("p.*")
    found = nearest_points(first, measured, most).where(F.col("d") > least).select("point_id", *"xyz", "d")
    return found.orderBy("d", "point_id").limit(int(share * measured.count()))


def hash_sample(rows: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by the order of their hashed ids: the same ones for the same seed, however rows are dealt."""
    return rows.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))), id_col).limit(n)


def evenly(rows: DataFrame, n: int, key: str, order: str) -> DataFrame:
    """At most n rows of each key at even steps from first to last."""
    at, size = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1, F.count("*").over(Window.partitionBy(key))
    numbered = rows.withColumns({"__at": at, "__n": size})
    wanted = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(i * (F.col("__n") - 1) / F.lit(float(max(n - 1, 1)))).cast("long"))
    return numbered.where((F.col("__n") <= n) | F.array_contains(wanted, F.col("__at").cast("long"))).drop("__at", "__n")


def with_inferred(measured: DataFrame, inferred: DataFrame) -> DataFrame:
    """Both clouds with a flag; views of points that were not seen are 0."""
    both = measured.withColumn("inferred", F.lit(False)).unionByName(inferred.withColumn("inferred", F.lit(True)), allowMissingColumns=True)
    return both.withColumn("views", F.coalesce("views", F.lit(0)))


def confidence_colour(views: Column, inferred: Column) -> Column:
    """Red to green with the views that saw a point, six at most; blue for inferred points."""
    t = F.least(views, F.lit(6)) / 6.0
    seen = F.struct((1 - t).alias("r"), (0.25 + 0.75 * t).alias("g"), F.lit(0.2).alias("b"))
    return F.when(inferred, F.struct(F.lit(0.25).alias("r"), F.lit(0.55).alias("g"), F.lit(1.0).alias("b"))).otherwise(seen)


def polygon_area(ring: Column) -> Column:
    """Area of a ring of structs (x, y), open or closed; null below three corners."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, following, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.when(F.size(ring) >= 3, F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2)


def filled_polygons(polygons: DataFrame, size: float) -> DataFrame:
    """(ix, iy, top): the highest polygon (ring of (x, y), height z) over the centre of each cell; even and odd crossings decide.

    An edge gives its crossing with each row of cell centres that it spans; sorted crossings of a polygon and row are
    in and out in turn, so cells come as whole spans and none is tested.
    """
    ring = F.col("ring")
    following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    numbered = polygons.where(F.size(ring) >= 3).withColumn("id", F.monotonically_increasing_id())
    edges = numbered.select("id", "z", F.explode(F.zip_with(ring, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("e"))
    ax, ay, bx, by = (F.col(f"e.{p}.{c}") for p in "ab" for c in "xy")
    first = lambda v: F.ceil(v / size - 0.5)  # noqa: E731  the first cell whose centre is at v or beyond
    low, high = first(F.least(ay, by)), first(F.greatest(ay, by)) - 1
    rows = edges.where(ay != by).select("id", "z", ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"), F.explode(F.when(low <= high, F.sequence(low, high))).alias("iy"))
    y = (F.col("iy") + 0.5) * size
    cross = rows.select("id", "z", "iy", (F.col("ax") + (y - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))).alias("x"))
    n = cross.groupBy("id", "z", "iy").agg(F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.collect_list("x").alias("all"))
    two = n.where("n = 2").select("z", "iy", "x0", "x1")
    turns = F.transform(F.sequence(F.lit(0), F.floor(F.col("n") / 2).cast("int") - 1), lambda i: F.struct(F.get(F.col("s"), 2 * i).alias("x0"), F.get(F.col("s"), 2 * i + 1).alias("x1")))
    more = n.where("n > 2").withColumn("s", F.array_sort("all")).select("z", "iy", F.explode(turns).alias("t")).select("z", "iy", "t.x0", "t.x1")
    left, right = first(F.col("x0")), first(F.col("x1")) - 1
    cells = two.unionByName(more).select("iy", "z", F.explode(F.when(left <= right, F.sequence(left, right))).alias("ix"))
    return cells.groupBy("ix", "iy").agg(F.max("z").alias("top"))


def greedy_matches(pairs: DataFrame) -> DataFrame:
    """(a, b, score): one-to-one pairs, best score first, ties to larger a, then larger b.

    A pair that is the best of both its sides is one that the greedy order takes; each round takes all such pairs
    and drops what touches them, so no task holds all pairs. The best of all pairs is always taken, so the rounds end.
    """
    left, out = stored(pairs.where("score is not null").select("a", "b", "score").distinct(), "pairs"), None
    rank = F.struct("score", "a", "b")
    while True:
        best = left.groupBy("a").agg(F.max(rank).alias("m")).select("m.*").intersect(left.groupBy("b").agg(F.max(rank).alias("m")).select("m.*"))
        best = stored(best, "matches").select("a", "b", "score")
        out = best if out is None else out.unionByName(best)
        left = stored(left.join(best.select("a"), "a", "left_anti").join(best.select("b"), "b", "left_anti").select("a", "b", "score"), "pairs")
        if left.isEmpty():
            return out


def spaced_photos(photos: DataFrame, min_move: float, blur: float = 0.5, key: str = "flight_id", order: str = "seq") -> DataFrame:
    """(key, order, verdict): kept, blurry (below a share of the median sharpness) or close to the last kept photo.

    Photos carry e, n, u (null without a fix; those are never close). The fold keeps only the last kept photo.
    """
    median = F.median("sharpness").over(Window.partitionBy(key))
    p = photos.withColumn("blurry", F.col("sharpness") < median * blur)
    g = p.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "e", "n", "u", "blurry"))).alias("all"))
    place = "struct<e:double,n:double,u:double>"
    start = F.struct(F.lit(None).cast(place).alias("last"), F.array().cast("array<string>").alias("out"))

    def step(state, photo):
        a = state["last"]
        d = F.sqrt(sum(((photo[c] - a[c]) * (photo[c] - a[c]) for c in "nu"), (photo["e"] - a["e"]) * (photo["e"] - a["e"])))
        said = F.when(photo["blurry"], "blurry").when(F.coalesce(d < min_move, F.lit(False)), "close").otherwise("kept")
        here = F.struct(*(photo[c].cast("double").alias(c) for c in "enu"))
        return F.struct(F.when(said == "kept", here).otherwise(a).alias("last"), F.concat(state["out"], F.array(said)).alias("out"))

    folded = g.withColumn("said", F.aggregate("all", start, step, lambda s: s["out"]))
    return folded.select(key, F.explode(F.arrays_zip("all", "said")).alias("z")).select(key, F.col(f"z.all.{order}").alias(order), F.col("z.said").alias("verdict"))
