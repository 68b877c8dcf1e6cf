"""Fusion of position fixes: a gated constant-velocity filter with a backward smoother, judged against the raw fixes.

The state is recursive, so each flight is one group of `applyInPandas`; a flight is bounded by its duration. All other
steps (local axes, accuracies, way back to degrees) are column expressions around it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesy
from .tracks import KEY, local_track

# fixed values: gate in sigmas, rejections before the sensor is trusted again, growth of noise per rejection and its
# largest power, quantile of steps that the gate allows, shares and factors for warning and fallback, least accuracy (m)
GATE, REACQUIRE, INFLATION, INFLATION_CAP, STEP_QUANTILE = 4.0, 10, 4.0, 3, 0.9
WARN_SHARE, FALLBACK_SHARE, WARN_FACTOR, FALLBACK_FACTOR, LEAST_SCALE = 0.1, 0.3, 2.0, 4.0, 2.0
Q_HORIZONTAL, Q_VERTICAL = 0.02, 0.2


def smooth(t: np.ndarray, z: np.ndarray, var: np.ndarray, at: np.ndarray, q: float, gate: float = GATE) -> dict[str, np.ndarray]:
    """Smoothed z and its deviation at the times `at` and at the fixes, with the innovation and the fate of each fix.

    Fixes are in time order. The covariance is kept as its three numbers; noise between two events grows with the run of
    rejections before them. A fix decides by the larger of its variance and the track's own steps, and weighs by its own.
    """
    m = len(t)
    typical = float(np.quantile(np.abs(np.diff(z)), STEP_QUANTILE)) if m >= 3 else 0.0
    allowed = np.maximum(var, typical**2)
    head = slice(0, min(10, m))
    dt = np.diff(t[head])
    rates = np.diff(z[head])[dt > 0] / dt[dt > 0]
    pause = float(np.median(np.diff(t))) if m >= 2 else 1.0
    pos, vel = float(np.median(z[head])), float(np.median(rates)) if len(rates) else 0.0
    a, b, c = float(np.median(allowed[head])), 0.0, max(25.0, (typical / max(pause, 1e-3)) ** 2)

    when = np.concatenate([t, at])
    events = np.argsort(when, kind="stable")
    gaps = np.diff(when[events], prepend=when[events[0]])
    ahead, behind = np.empty((len(events), 5)), np.empty((len(events), 5))
    innovation, taken, run = np.zeros(m), np.zeros(m, bool), 0
    for k, (i, d) in enumerate(zip(events.tolist(), gaps.tolist())):
        noise = q * INFLATION ** min(run, INFLATION_CAP)
        pos += vel * d
        a, b, c = a + d * (2 * b + d * c) + noise * d**3 / 3, b + d * c + noise * d * d / 2, c + noise * d
        ahead[k] = pos, vel, a, b, c
        if i < m:
            off = float(z[i]) - pos
            innovation[i] = abs(off)
            if off * off <= gate * gate * (a + allowed[i]) or run >= REACQUIRE:
                g, h = a / (a + var[i]), b / (a + var[i])
                pos, vel = pos + g * off, vel + h * off
                a, b, c = a - g * a, b - g * b, c - h * b
                taken[i], run = True, 0
            else:
                run += 1
        behind[k] = pos, vel, a, b, c

    out = behind[:, [0, 2]].copy()  # position and its variance
    s, last = behind[-1, :2].copy(), behind[-1, 2:].copy()
    for k in range(len(events) - 2, -1, -1):
        d, (_, _, a, b, c), (_, _, pa, pb, pc) = gaps[k + 1], behind[k], ahead[k + 1]
        det = pa * pc - pb * pb
        if det > 1e-12 * max(pa * pc, 1e-300):
            back = np.array([[a + d * b, b], [b + d * c, c]]) @ np.array([[pc, -pb], [-pb, pa]]) / det
        else:
            back = np.array([[a + d * b, b], [b + d * c, c]]) @ np.linalg.pinv(np.array([[pa, pb], [pb, pc]]))
        s = behind[k, :2] + back @ (s - ahead[k + 1, :2])
        more = last - ahead[k + 1, 2:]
        cov = back @ np.array([[more[0], more[1]], [more[1], more[2]]]) @ back.T
        last = behind[k, 2:] + np.array([cov[0, 0], cov[0, 1], cov[1, 1]])
        out[k] = s[0], last[0]
    place = np.empty(len(events), np.int64)
    place[events] = np.arange(len(events))
    return {"at": out[place[m:], 0], "std": np.sqrt(np.maximum(out[place[m:], 1], 0)), "fixes": out[place[:m], 0], "innovation": innovation, "taken": taken}


_OUT = "q double, e double, n double, u double, h_std double, v_std double, gps_fixes long, rejected_east long, rejected_north long, rejected_up long, rejection_ratio double, median_residual_m double, max_innovation_m double, quality string"


def _flight(key: str, q_h: float, q_v: float, gate: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kind = rows["kind"].to_numpy()
        fx = rows[kind < 2].sort_values(["t", "kind", "u"])
        gps = fx[fx["kind"] == 0]
        at = np.sort(rows["t"].to_numpy()[kind == 2])
        if not len(gps) or not len(at):
            return pd.DataFrame(columns=[key, *(c.split()[0] for c in _OUT.split(", "))])
        t, e, n, u, h, v = (gps[c].to_numpy(float) for c in ("t", "e", "n", "u", "h", "v"))
        east, north = smooth(t, e, h**2, at, q_h, gate), smooth(t, n, h**2, at, q_h, gate)
        up = smooth(fx["t"].to_numpy(float), fx["u"].to_numpy(float), fx["v"].to_numpy(float) ** 2, at, q_v, gate)
        lost = [int((~x["taken"]).sum()) for x in (east, north, up)]
        share = max(lost[:2]) / len(t)
        residual = float(np.median(np.hypot(east["fixes"] - e, north["fixes"] - n)))
        scale = max(LEAST_SCALE, float(np.median(h)))
        if share > FALLBACK_SHARE or residual > FALLBACK_FACTOR * scale:
            j = np.clip(np.searchsorted(t, at), 1, max(1, len(t) - 1))
            near = np.where(at - t[j - 1] <= t[np.minimum(j, len(t) - 1)] - at, j - 1, np.minimum(j, len(t) - 1))
            near = np.searchsorted(t, t[near], "left")  # the first fix of a time
            values, quality = (e[near], n[near], u[near], h[near], v[near]), "fallback"
        else:
            values = (east["at"], north["at"], up["at"], np.hypot(east["std"], north["std"]), up["std"])
            quality = "degraded" if share > WARN_SHARE or residual > WARN_FACTOR * scale else "ok"
        out = pd.DataFrame(dict(zip(("q", "e", "n", "u", "h_std", "v_std"), (at, *values))))
        out.insert(0, key, rows[key].iloc[0])
        found = dict(zip(("rejected_east", "rejected_north", "rejected_up"), lost), gps_fixes=len(t), rejection_ratio=round(share, 3), median_residual_m=round(residual, 2), max_innovation_m=round(float(np.hypot(east["innovation"], north["innovation"]).max()), 2), quality=quality)
        return out.assign(**found)[[key, *(c.split()[0] for c in _OUT.split(", "))]]

    return run


def fused(fixes: DataFrame, queries: DataFrame, baro: DataFrame | None = None, *, key: str = KEY, q_h: float = Q_HORIZONTAL, q_v: float = Q_VERTICAL, gate: float = GATE) -> DataFrame:
    """(key, q, e, n, u, lat, lon, alt, deviations, counts, quality) at each query time.

    Quality is ok, degraded or fallback; on fallback each time takes the nearest raw fix with its own accuracy. Fixes that
    aren't finite are dropped; flights without fixes have no rows. `baro` (key, t, u, v) adds heights to the up axis.
    """
    track = local_track(fixes, key)
    v = F.col("v_acc") if "v_acc" in fixes.columns else F.lit(None).cast("double")
    rows = track.select(key, F.lit(0).alias("kind"), "t", "e", "n", "u", geodesy.horizontal_accuracy(F.col("h_acc")).alias("h"), geodesy.vertical_accuracy(v, F.col("h_acc")).alias("v"))
    none = lambda *names: [F.lit(None).cast("double").alias(c) for c in names]
    rows = rows.unionByName(queries.select(key, F.lit(2).alias("kind"), F.col("q").alias("t"), *none("e", "n", "u", "h", "v")))
    if baro is not None:
        rows = rows.unionByName(baro.select(key, F.lit(1).alias("kind"), "t", *none("e", "n", "h"), "u", "v"))
    kind = fixes.schema[key].dataType.simpleString()
    out = rows.groupBy(key).applyInPandas(_flight(key, q_h, q_v, gate), f"`{key}` {kind}, {_OUT}")
    origin = fixes.where(" and ".join(f"{c} is not null and not isnan({c}) and abs({c}) < double('infinity')" for c in ("lat", "lon", "alt"))).groupBy(key).agg(*(F.median(c).alias(f"{c}0") for c in ("lat", "lon", "alt")))
    x0, y0, z0 = geodesy.ecef(F.col("lat0"), F.col("lon0"), F.col("alt0"))
    la, lo, e, n, u = F.radians("lat0"), F.radians("lon0"), F.col("e"), F.col("n"), F.col("u")
    x = x0 - F.sin(lo) * e - F.sin(la) * F.cos(lo) * n + F.cos(la) * F.cos(lo) * u
    y = y0 + F.cos(lo) * e - F.sin(la) * F.sin(lo) * n + F.cos(la) * F.sin(lo) * u
    z = z0 + F.cos(la) * n + F.sin(la) * u
    return geodesy.with_geodetic(out.join(origin, key), x, y, z).drop("lat0", "lon0", "alt0")


def baro_heights(fixes: DataFrame, baro: DataFrame, half: float = 30.0, sigma: float = 0.5, key: str = KEY) -> DataFrame:
    """(key, t, u, v): barometer heights (key, t, alt) on the local up axis, led by the rolling median offset to the fixes."""
    from .tracks import interpolated, rolling_median

    up = interpolated(baro.select(key, F.col("t").alias("q")), local_track(fixes, key), "u", key).select(key, F.col("q").alias("t"), "u").dropDuplicates([key, "t"])
    rel = baro.withColumn("rel", F.col("alt") - F.min_by("alt", "t").over(Window.partitionBy(key)))
    off = rolling_median(rel.join(up, [key, "t"]).withColumn("off", F.col("u") - F.col("rel")), "off", half, key)
    return off.select(key, "t", (F.col("rel") + F.col("rolling")).alias("u"), F.lit(sigma).alias("v"))
