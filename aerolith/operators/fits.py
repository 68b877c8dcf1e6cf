"""Fits and votes: lines that shed outliers, rigid and similarity fits, roll by consensus, raster components."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored


def robust_line(rows: DataFrame, x: str, y: str, *keys: str, rounds: int = 5, keep: float = 0.8) -> DataFrame:
    """(keys, slope, intercept): least squares over and over on the rows whose residual is within the keep quantile of all.

    Rows are stored once; between rounds only a line and a limit for each key are kept.
    """
    on = list(keys)
    data = stored(rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*on, F.col(x).alias("x"), F.col(y).alias("y")), "points")
    met = lambda state: data.join(state, on) if on else data.crossJoin(F.broadcast(state))  # noqa: E731  one row without keys
    off = F.abs(F.col("slope") * F.col("x") + F.col("intercept") - F.col("y"))
    inside = data
    for i in range(rounds):
        line = inside.groupBy(*on).agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))
        if i == rounds - 1:
            break
        line = stored(line, "line")
        limit = met(line).groupBy(*on, "slope", "intercept").agg(F.percentile(off, F.lit(keep)).alias("limit"))
        inside = met(stored(limit, "limit")).where(off <= F.col("limit"))
    return line


def similarity_fit(pairs: DataFrame, scaled: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
    """(scale, rotation, shift) that take (x, y, z) nearest to (rx, ry, rz); sums in the engine, a 3 by 3 decomposition here."""
    means = pairs.agg(*(F.avg(c).alias(c) for c in ("x", "y", "z", "rx", "ry", "rz"))).first()
    src, ref = [F.col(c) - F.lit(means[c]) for c in "xyz"], [F.col(f"r{c}") - F.lit(means[f"r{c}"]) for c in "xyz"]
    got = pairs.agg(*(F.avg(r * s) for r in ref for s in src), sum((F.avg(s * s) for s in src[1:]), F.avg(src[0] * src[0]))).first()
    u, size, vt = np.linalg.svd(np.array(got[:9], float).reshape(3, 3))
    sign = np.array([1.0, 1.0, 1.0 if np.linalg.det(u @ vt) > 0 else -1.0])
    rot = (u * sign) @ vt
    scale = float(size @ sign / got[9]) if scaled else 1.0
    return scale, rot, np.array([means[f"r{c}"] for c in "xyz"]) - scale * rot @ np.array([means[c] for c in "xyz"])


def roll_votes(normals: DataFrame, axis: tuple[float, float], degrees: list[float], tolerance_deg: float) -> DataFrame:
    """(deg, votes): normals (nx, ny, nz) that become level when turned about a level axis; one pass, one sum for each angle."""
    side, tol = F.col("ny") * axis[0] - F.col("nx") * axis[1], math.sin(math.radians(tolerance_deg))
    votes = [F.sum((F.abs(F.col("nz") * math.cos(math.radians(d)) + side * math.sin(math.radians(d))) < tol).cast("long")).alias("v") for d in degrees]
    packed = normals.agg(F.array(*(F.struct(F.lit(float(d)).alias("deg"), F.coalesce(v, F.lit(0)).alias("votes")) for d, v in zip(degrees, votes))).alias("all"))
    return packed.select(F.inline("all"))


def raster_components(cells: DataFrame) -> DataFrame:
    """(ix, iy, component) over eight neighbours; a component is named by its smallest cell (x, then y).

    Each round takes the least label around a cell and then that label's own label; each is a table in the shared folder. Labels only become
    smaller, so the rounds end.
    """
    key, span = F.struct("ix", "iy"), F.sequence(F.lit(-1), F.lit(1))
    now = stored(cells.select("ix", "iy").distinct().withColumn("component", key), "cells")
    while True:
        sent = now.withColumn("a", F.explode(span)).withColumn("b", F.explode(span)).select((F.col("ix") + F.col("a")).alias("ix"), (F.col("iy") + F.col("b")).alias("iy"), "component")
        low = now.select("ix", "iy", F.col("component").alias("old")).join(sent.groupBy("ix", "iy").agg(F.min("component").alias("component")), ["ix", "iy"])
        roots = now.select(F.struct("ix", "iy").alias("c"), F.col("component").alias("up"))
        new = stored(low.join(roots, F.col("component") == F.col("c")).select("ix", "iy", "old", F.least("component", "up").alias("component")), "cells")
        now = new.select("ix", "iy", "component")
        if new.where("old <> component").isEmpty():
            return now
