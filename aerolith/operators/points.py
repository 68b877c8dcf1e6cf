"""Operators on point clouds, votes, voxels, rasters and file trees."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import grouped, stored

#: Cubes that are broadcast at most; more are joined.
MOST_CUBES = 100_000


def visible(rows: DataFrame, cell: list[str], depth: str, share: float = 0.02, slack: float = 0.5) -> DataFrame:
    """Rows not hidden behind the nearest depth of their cell."""
    near = F.min(depth).over(Window.partitionBy(*cell))
    return rows.withColumn("__near", near).where(F.col(depth) <= F.col("__near") * (1 + share) + slack).drop("__near")


def majority(votes: DataFrame, least: int = 2, skip: tuple[int, ...] = (0,)) -> DataFrame:
    """(point_id, views, voted): the class with most votes, the lowest on ties; null below the least number."""
    n = votes.groupBy("point_id", "cls").agg(F.count("*").alias("k"))
    valid = ~F.col("cls").isin(*skip)
    best = F.max_by(F.when(valid, F.col("cls")), F.when(valid, F.struct("k", -F.col("cls"))))
    out = n.groupBy("point_id").agg(F.sum("k").alias("views"), best.alias("voted"), F.max(F.when(valid, F.col("k"))).alias("top"))
    return out.select("point_id", "views", F.when(F.col("top") >= least, F.col("voted")).alias("voted"))


def class_shares(points: DataFrame) -> DataFrame:
    """(cls, n, share) from counts; the total is a sum over the few classes."""
    n = points.groupBy("cls").agg(F.count("*").alias("n"))
    return n.select("cls", "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def first_of_voxel(points: DataFrame, size: float) -> DataFrame:
    """The row with the smallest point_id of each cube; pre-aggregated, so dense cubes don't gather."""
    return points.withColumns({f"v{c}": F.floor(F.col(c) / size) for c in "xyz"}).groupBy("vx", "vy", "vz").agg(F.min_by(F.struct("point_id", *[c for c in points.columns if c != "point_id"]), "point_id").alias("p"), F.count("*").alias("n")).select("vx", "vy", "vz", "p.*", "n")


def blocks(points: DataFrame, reach: float, most: int = 4000, top: int = 4, asks: str | None = None, tasks: int | None = None) -> DataFrame:
    """(level, bx, by, bz, inner, point columns): points in cubes of a side of reach times a power of two, with all that lie within reach of a cube.

    A cube is halved while it holds more than `most` points and is larger than the reach, so dense places are dealt to many tasks. Counts
    of the smallest cubes are taken once; larger ones are their sums. With `asks`, cubes without a point that asks are left out; with
    `tasks`, cubes are dealt to as many tasks at most.
    """
    keys = ["bx", "by", "bz"]
    at = lambda c, level: F.floor(F.col(c) / (reach * 2.0**level)).cast("long")
    asking = F.count_if(asks) if asks else F.count("*")
    small = stored(points.groupBy(*(at(c, 0).alias(f"b{c}") for c in "xyz")).agg(F.count("*").alias("n"), asking.alias("a")), "cubes")
    levels = small.select(F.explode(F.sequence(F.lit(0), F.lit(top))).alias("level"), *keys, "n", "a")
    wide = [F.expr(f"shiftright({k}, level)").alias(k) for k in keys]
    calm = levels.select("level", *wide, "n", "a").groupBy("level", *keys).agg(F.sum("n").alias("n"), F.sum("a").alias("a")).where(f"(n <= {most} or level = 0) and a > 0")
    calm = stored(calm.select("level", *keys, "n"), "cubes")
    wider = calm.where("level > 0").select(F.col("level") - 1, *(F.explode(F.array(2 * F.col("bx"), 2 * F.col("bx") + 1)).alias("bx"),), "by", "bz").toDF("level", *keys)
    for k in keys[1:]:
        wider = wider.withColumn(k, F.explode(F.array(2 * F.col(k), 2 * F.col(k) + 1)))
    cubes = stored(calm.join(wider.where("level >= 0"), ["level", *keys], "left_anti").select("level", *keys), "cubes")
    counts = {r.level: r["count"] for r in cubes.groupBy("level").count().collect()}
    out = None
    for level in sorted(counts) or [0]:
        side, near = reach * 2.0**level, points
        for c in "xyz":
            near = near.withColumn(f"b{c}", F.explode(F.sequence(F.floor((F.col(c) - reach) / side).cast("long"), F.floor((F.col(c) + reach) / side).cast("long"))))
        inner = (F.col("bx") == at("x", level)) & (F.col("by") == at("y", level)) & (F.col("bz") == at("z", level))
        own = cubes.where(F.col("level") == level)
        near = near.withColumn("inner", inner)
        near = near.where(f"inner or not {asks}") if asks else near
        near = near.join(F.broadcast(own) if counts.get(level, 0) <= MOST_CUBES else own, keys).select("level", *keys, "inner", *points.columns)
        out = near if out is None else out.unionByName(near)
    return out.repartition(max(1, min(tasks, sum(counts.values()))), "level", *keys) if tasks else out


def first_reach(points: DataFrame, radius: float, k: int = 1) -> float:
    """The radius or its half, quarter, .. from which a search in rounds begins: less, the more points a cube of the radius holds.

    Points of a cube that lie on lines are within radius / n of each other, those that fill it within radius / n^(1/3).
    """
    cells = points.groupBy(*(F.floor(F.col(c) / radius).alias(c) for c in "xyz")).agg(F.count("*").alias("n")).agg(F.avg("n").alias("n")).first()
    return radius / 2.0 ** min(20, max(0, math.floor(math.log2(max(1.0, (cells.n or 1.0) / (4 * k))) / 2)))


def nearest_in_cells(x: np.ndarray, rank: np.ndarray, own: np.ndarray, k: int, reach: float, rooted: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(places in x of the k nearest to each own point by distance (squared unless rooted) then rank; whether all k lie within reach; places are -1 where not).

    Points are sorted by the cells of a grid, and each own point looks at the 27 cells around; one with fewer than k points
    within a cell's side goes on with cells of twice the side, up to the reach. No more than some millions of pairs are held.
    """
    found = np.full((len(own), k), -1)
    if not len(x) or not len(own):
        return found, np.zeros(len(own), bool)
    low = np.minimum(x.min(0), own.min(0))
    span, halvings = np.maximum(x.max(0), own.max(0)) - low, 0
    while halvings < 24 and (span / (reach / 2 ** (halvings + 1))).prod(where=span > 0) < 2.0**50 and len(x) / _occupied(x, low, reach / 2 ** (halvings + 1)) >= 2 * k:
        halvings += 1
    todo = np.arange(len(own))
    for h in (reach / 2**i for i in range(halvings, -1, -1)):
        side = h * (1 + 1e-9)
        cell, at = ((np.floor((p - low) / side).astype(np.int64) + 1) for p in (x, own[todo]))
        n = np.maximum(cell.max(0), at.max(0)) + 2
        key = (cell[:, 0] * n[1] + cell[:, 1]) * n[2] + cell[:, 2]
        order = np.argsort(key, kind="stable")
        key = key[order]
        base = (at[:, 0] * n[1] + at[:, 1]) * n[2] + at[:, 2]
        rows = base[:, None] + np.array([(i * n[1] + j) * n[2] for i in (-1, 0, 1) for j in (-1, 0, 1)])
        first, last = np.searchsorted(key, rows - 1), np.searchsorted(key, rows + 1, "right")
        total = np.cumsum((last - first).sum(1))
        left = []
        for a, b in _cuts(total, 2_000_000):
            size = (last[a:b] - first[a:b]).ravel()
            ask = np.repeat(np.repeat(np.arange(a, b), 9), size)
            other = order[np.repeat(first[a:b].ravel() - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            d = np.zeros(len(ask))
            for j in range(3):
                d += (own[todo[ask], j] - x[other, j]) ** 2
            near = d <= h * h
            ask, other, d = ask[near], other[near], d[near]
            many = np.bincount(ask - a, minlength=b - a) >= k
            left.append(todo[a:b][~many])
            near = many[ask - a]
            ask, other, d = ask[near], other[near], d[near]
            by = np.lexsort((rank[other], np.sqrt(d) if rooted else d, ask))
            ask, other = ask[by], other[by]
            nth = np.arange(len(ask)) - np.searchsorted(ask, ask)
            found[todo[a:b][many]] = other[nth < k].reshape(-1, k)
        todo = np.concatenate(left) if left else todo[:0]
        if not len(todo):
            break
    return found, found[:, 0] >= 0


def _occupied(x: np.ndarray, low: np.ndarray, side: float) -> int:
    c = np.floor((x - low) / side).astype(np.int64)
    n = c.max(0) + 1
    return len(np.unique((c[:, 0] * n[1] + c[:, 1]) * n[2] + c[:, 2]))


def _cuts(total: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose running totals grow by at most `most`, or of one row."""
    a = 0
    while a < len(total):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def distinct_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first of each distinct row, number of its distinct row for each row)."""
    order = np.lexsort(x.T[::-1])
    new = np.ones(len(x), bool)
    new[1:] = (x[order][1:] != x[order][:-1]).any(1)
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


def nearest_ranked(left: DataFrame, right: DataFrame, radius: float, endless: bool = False) -> DataFrame:
    """(point_id, x, y, z, rx, ry, rz, rank, d) of each left point: the nearest right point (x, y, z, rank) nearer than the radius, or nulls; endless: however far.

    On ties the lowest rank, then the first by place. Equal right points count once, and equal left points of a cube ask once. The first
    round has a reach that suits the density; left points that find nothing in it go on with twice the reach, and only cubes with such
    points are looked at again.
    """
    kind = left.schema["point_id"].dataType
    keys = ["level", "bx", "by", "bz"]
    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    right = stored(right.groupBy(*"xyz").agg(F.min("rank").cast("int").alias("rank")), "right")
    todo, reach, out = stored(left.select("point_id", *"xyz"), "left"), first_reach(right, radius), None
    if endless:  # nothing is near to what has no place, however far one looks
        placed = " and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('inf')" for c in "xyz")
        out = todo.where(f"not ({placed})").selectExpr("*", *(f"double(null) as r{c}" for c in "xyz"), "int(null) as rank", "double(null) as d")
        todo, right = todo.where(placed), right.where(placed)
        if right.isEmpty():
            return out.unionByName(todo.selectExpr("*", *(f"double(null) as r{c}" for c in "xyz"), "int(null) as rank", "double(null) as d"))
    while True:
        last = not endless and reach >= radius

        def run(batches: Iterator[pa.RecordBatch], reach=reach, last=last) -> Iterator[pa.RecordBatch]:
            for t in grouped(batches, keys):
                asks = t.column("asks").to_numpy(zero_copy_only=False)
                if not asks.any():
                    continue
                x = np.stack([t.column(c).to_numpy() for c in "xyz"], 1)
                own, other, rank = x[asks], x[~asks], t.column("rank").filter(pa.array(~asks)).to_numpy()
                order = np.lexsort((*other.T[::-1], rank))
                other, rank = other[order], rank[order]
                once, back = distinct_rows(own)
                found, hit = nearest_in_cells(other, np.arange(len(other)), own[once], 1, reach, rooted=True)
                at = np.where(hit, found[:, 0], 0)
                r = np.zeros(len(once))
                for j in range(3):
                    r += (own[once, j] - other[at, j]) ** 2 if len(other) else 0.0
                r = np.sqrt(r)
                hit &= (r < reach) | (not last)
                at, r, hit = at[back], r[back], hit[back]
                rows = t.filter(pa.array(asks)).select(["point_id", *"xyz"]).combine_chunks().to_batches()[0]
                ends = [pa.array(other[at, j] if len(other) else np.zeros(len(at)), mask=~hit) for j in range(3)]
                ranks = pa.array(rank[at].astype(np.int32) if len(other) else np.zeros(len(at), np.int32), mask=~hit)
                yield pa.RecordBatch.from_arrays([*rows.columns, *ends, ranks, pa.array(r, mask=~hit)], names=["point_id", *"xyz", "rx", "ry", "rz", "rank", "d"])

        none = F.lit(None)
        both = todo.select("point_id", *"xyz", F.lit(True).alias("asks"), none.cast("int").alias("rank")).unionByName(right.select(none.cast(kind).alias("point_id"), *"xyz", F.lit(False).alias("asks"), "rank"))
        dealt = blocks(both, reach * (1 + 1e-9), 16_000, 8, "asks", tasks).drop("inner").sortWithinPartitions(*keys)
        found = dealt.mapInArrow(run, f"point_id {kind.simpleString()}, x double, y double, z double, rx double, ry double, rz double, rank int, d double")
        found = found if last else stored(found, "found")
        near = found if last else found.where("d is not null")
        out = near if out is None else out.unionByName(near)
        if last:
            return out
        todo = found.where("d is null").select("point_id", *"xyz")
        if todo.isEmpty():
            return out
        reach = reach * 2 if endless else min(reach * 2, radius)


def _search(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    return nearest_ranked(left, right.select(*"xyz", F.lit(0).alias("rank")), radius)


def nearest_points(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """(point_id, x, y, z, rx, ry, rz, d): the nearest right point nearer than the radius; rows without one are left out."""
    return _search(left, right, radius).where("d is not null").drop("rank")


def nearest_within(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """(point_id, d): distance to the nearest right point nearer than the radius; null if none."""
    return _search(left, right, radius).select("point_id", "d")


def distance_stats(rows: DataFrame, d: str, *keys: str) -> DataFrame:
    """Median, 90th percentile and shares below 0.5 and 1."""
    return rows.where(F.col(d).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.percentile(d, F.lit(0.5)).alias("median_m"), F.percentile(d, F.lit(0.9)).alias("p90_m"), F.avg((F.col(d) < 0.5).cast("double")).alias("within_05"), F.avg((F.col(d) < 1.0).cast("double")).alias("within_1"))


def surface(points: DataFrame, size: float) -> DataFrame:
    """(ix, iy, top, n): highest point of each square cell."""
    return points.groupBy(F.floor(F.col("x") / size).alias("ix"), F.floor(F.col("y") / size).alias("iy")).agg(F.max("z").alias("top"), F.count("*").alias("n"))


def dilated(cells: DataFrame, reach: int = 1) -> DataFrame:
    """Cells with all neighbours within reach."""
    span = F.sequence(F.lit(-reach), F.lit(reach))
    return cells.select("ix", "iy").withColumn("a", F.explode(span)).withColumn("b", F.explode(span)).select((F.col("ix") + F.col("a")).alias("ix"), (F.col("iy") + F.col("b")).alias("iy")).distinct()


def eroded(cells: DataFrame, reach: int = 1) -> DataFrame:
    """Cells all of whose neighbours within reach are there."""
    span = F.sequence(F.lit(-reach), F.lit(reach))
    votes = cells.select("ix", "iy").distinct().withColumn("a", F.explode(span)).withColumn("b", F.explode(span)).groupBy((F.col("ix") + F.col("a")).alias("ix"), (F.col("iy") + F.col("b")).alias("iy")).agg(F.count("*").alias("k"))
    return votes.where(F.col("k") == (2 * reach + 1) ** 2).select("ix", "iy")


def closed(cells: DataFrame, reach: int = 1) -> DataFrame:
    return eroded(dilated(cells, reach), reach)


def opened(cells: DataFrame, reach: int = 1) -> DataFrame:
    return dilated(eroded(cells, reach), reach)


def position_errors(rows: DataFrame, key: str) -> DataFrame:
    """Errors of positions (e, n, u) against references (re, rn, ru), raw and without the mean offset."""
    d = rows.select(key, (F.col("e") - F.col("re")).alias("de"), (F.col("n") - F.col("rn")).alias("dn"), (F.col("u") - F.col("ru")).alias("du"))
    w = Window.partitionBy(key)
    d = d.withColumns({"h": F.hypot("de", "dn"), "h0": F.hypot(F.col("de") - F.avg("de").over(w), F.col("dn") - F.avg("dn").over(w))})
    return d.groupBy(key).agg(F.count("*").alias("n"), F.percentile("h", F.lit(0.5)).alias("h_median"), F.percentile("h", F.lit(0.9)).alias("h_p90"), F.max("h").alias("h_max"), F.percentile(F.abs("du"), F.lit(0.5)).alias("v_median"), F.percentile("h0", F.lit(0.5)).alias("h_median_no_offset"), F.percentile("h0", F.lit(0.9)).alias("h_p90_no_offset"))


def storage(files: DataFrame) -> DataFrame:
    """(target, n_files, logical, unique_bytes): a file that is linked twice counts once, for its first target."""
    once = files.groupBy("ino").agg(F.min("target").alias("target"), F.min("size").alias("size")).groupBy("target").agg(F.sum("size").alias("unique_bytes"))
    return files.groupBy("target").agg(F.count("*").alias("n_files"), F.sum("size").alias("logical")).join(once, "target", "left").withColumn("unique_bytes", F.coalesce("unique_bytes", F.lit(0)).cast("long"))
