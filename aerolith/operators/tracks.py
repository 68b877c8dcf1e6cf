"""Operators on ordered tracks. Rows carry a key and an ordinal; nothing relies on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geodesy import enu, heading, turn

KEY, ORDER = "flight_id", "seq"


def _by(key: str = KEY, order: str = ORDER):
    return Window.partitionBy(key).orderBy(order)


def deduped(fixes: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Without fixes whose position equals that of the fix right before."""
    w = _by(key, order)
    same = F.lit(True)
    for c in ("lat", "lon", "alt"):
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c))
    return fixes.withColumn("__same", same & F.lag(F.lit(1)).over(w).isNotNull()).where("not __same").drop("__same")


def local_track(fixes: DataFrame, key: str = KEY) -> DataFrame:
    """East, north, up from the flight's median position; rows that aren't finite are dropped."""
    finite = F.lit(True)
    for c in ("lat", "lon", "alt"):
        finite = finite & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    good = fixes.where(finite)
    origin = good.groupBy(key).agg(*(F.median(c).alias(f"{c}0") for c in ("lat", "lon", "alt")))
    e, n, u = enu(*(F.col(c) for c in ("lat", "lon", "alt", "lat0", "lon0", "alt0")))
    return good.join(origin, key).select(*fixes.columns, e.alias("e"), n.alias("n"), u.alias("u"))


def noise(track: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """(key, sigma): noise of a fix from the spread of second differences; 0 below five fixes."""
    w = _by(key, order)
    second = lambda c: F.lead(c).over(w) - 2 * F.col(c) + F.lag(c).over(w)
    d = track.select(key, second("e").alias("de"), second("n").alias("dn"))
    mid = d.groupBy(key).agg(F.median("de").alias("me"), F.median("dn").alias("mn"), F.count("*").alias("k"))
    spread = d.join(mid, key).groupBy(key).agg(F.median(F.abs(F.col("de") - F.col("me"))).alias("se"), F.median(F.abs(F.col("dn") - F.col("mn"))).alias("sn"), F.first("k").alias("k"))
    unit = 0.6745 * 6**0.5
    return spread.select(key, F.when(F.col("k") < 5, 0.0).otherwise((F.col("se") + F.col("sn")) / 2 / unit).alias("sigma"))


def spikes(track: DataFrame, gate: Column, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Adds spike: farther than the gate from the median of two fixes before and two after; never at an end."""
    w = _by(key, order)
    gone = F.lit(0.0)
    for c in ("e", "n", "u"):
        near = [F.lag(c, 2).over(w), F.lag(c, 1).over(w), F.lead(c, 1).over(w), F.lead(c, 2).over(w)]
        middle = (sum(near[1:], near[0]) - F.greatest(*near) - F.least(*near)) / 2
        gone = gone + (F.col(c) - middle) * (F.col(c) - middle)
    inner = F.lag("e", 2).over(w).isNotNull() & F.lead("e", 2).over(w).isNotNull()
    return track.withColumn("spike", inner & F.coalesce(F.sqrt(gone) > gate, F.lit(False)))


def steps(track: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Adds step: horizontal distance from the fix before."""
    w = _by(key, order)
    return track.withColumn("step", F.hypot(F.col("e") - F.lag("e").over(w), F.col("n") - F.lag("n").over(w)))


def window_speeds(track: DataFrame, least_s: float = 1.0, top: float = 30.0, slack: float = 25.0, key: str = KEY) -> DataFrame:
    """(key, steps_judged, discontinuous, max_speed) over spans to the first fix at least least_s later."""
    ahead = f"partition by `{key}` order by t range between {float(least_s)}D following and unbounded following"
    rows = track.withColumn("to", F.expr(f"first(struct(t, e, n)) over ({ahead})")).where("to is not null")
    span = F.col("to.t") - F.col("t")
    far = F.hypot(F.col("to.e") - F.col("e"), F.col("to.n") - F.col("n"))
    rows = rows.select(key, far.alias("far"), span.alias("span"))
    return rows.groupBy(key).agg(F.count("*").alias("steps_judged"), F.avg((F.col("far") > top * F.col("span") + slack).cast("double")).alias("discontinuous"), F.max(F.col("far") / F.col("span")).alias("max_speed"))


def interpolated(queries: DataFrame, fixes: DataFrame, value: str, key: str = KEY, slack: float | None = None, offset: float = 0.0) -> DataFrame:
    """(key, q, value): linear between the fixes around q, held at the ends; null beyond slack where one is given.

    The offset is added to the fixes' times.

    An as-of join by one union and two running windows: no row meets more than its neighbours.
    """
    fixes = fixes.withColumn("t", F.col("t") + offset) if offset else fixes
    fx = fixes.where(F.col(value).isNotNull()).select(key, F.col("t").alias("at"), F.lit(0).alias("kind"), F.struct("t", F.col(value).alias("v")).alias("fix"))
    qs = queries.select(key, F.col("q").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(fx.schema["fix"].dataType).alias("fix"))
    back = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = fx.unionByName(qs).withColumns({"b": F.last("fix", True).over(back), "f": F.last("fix", True).over(ahead)}).where("kind = 1")
    inside = F.col("b.v") + (F.col("f.v") - F.col("b.v")) * (F.col("at") - F.col("b.t")) / F.nullif(F.col("f.t") - F.col("b.t"), F.lit(0.0))
    v = F.coalesce(inside, F.col("b.v"), F.col("f.v"))
    if slack is not None:
        out = (F.col("b").isNull() & (F.col("f.t") - F.col("at") > slack)) | (F.col("f").isNull() & (F.col("at") - F.col("b.t") > slack))
        v = F.when(~out, v)
    return both.select(key, F.col("at").alias("q"), v.alias(value))


def nearest_fix(queries: DataFrame, fixes: DataFrame, value: str, key: str = KEY) -> DataFrame:
    """(key, q, value) of the fix nearest in time; the earlier one wins a tie."""
    fx = fixes.select(key, F.col("t").alias("at"), F.lit(0).alias("kind"), F.struct("t", F.col(value).alias("v")).alias("fix"))
    qs = queries.select(key, F.col("q").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(fx.schema["fix"].dataType).alias("fix"))
    back = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = fx.unionByName(qs).withColumns({"b": F.last("fix", True).over(back), "f": F.last("fix", True).over(ahead)}).where("kind = 1")
    take_back = F.col("f").isNull() | (F.col("at") - F.col("b.t") <= F.col("f.t") - F.col("at"))
    return both.select(key, F.col("at").alias("q"), F.when(take_back, F.col("b.v")).otherwise(F.col("f.v")).alias(value))


def rolling_median(rows: DataFrame, value: str, half: float = 30.0, key: str = KEY) -> DataFrame:
    """Adds rolling: median over the fixes within half seconds."""
    w = f"partition by `{key}` order by t range between {float(half)}D preceding and {float(half)}D following"
    return rows.withColumn("rolling", F.expr(f"percentile(`{value}`, 0.5) over ({w})"))


def strips(rows: DataFrame, limit: float = 45.0, key: str = KEY, order: str = ORDER) -> DataFrame:
    """Adds strip: photos between turns of more than limit degrees; the first two photos are in strip 0."""
    w = _by(key, order)
    go = rows.withColumn("__h", heading(F.col("e") - F.lag("e").over(w), F.col("n") - F.lag("n").over(w)))
    bend = F.coalesce((F.abs(turn(F.lag("__h").over(w), F.col("__h"))) > limit).cast("int"), F.lit(0))
    return go.withColumn("__b", bend).withColumn("strip", F.sum("__b").over(w).cast("long")).drop("__h", "__b")


def shots(cands: DataFrame, key: str = "shot_key") -> DataFrame:
    """Adds shot: candidates from one cut to the next; a cut on the first candidate opens nothing."""
    w = _by(key, "frame")
    first = F.lag("frame").over(w).isNull()
    return cands.withColumn("__c", F.when(first, 0).otherwise(F.col("is_cut").cast("int"))).withColumn("shot", F.sum("__c").over(w).cast("long")).drop("__c")


def cut_proposals(frames: DataFrame, diff: str, window: int, ratio: float, least: float = 12.0, key: str = "shot_key") -> DataFrame:
    """Frames whose difference exceeds both the least and a multiple of the median of the frames right before (0 if none)."""
    recent = F.expr(f"percentile(`{diff}`, 0.5) over (partition by `{key}` order by frame rows between {int(window)} preceding and 1 preceding)")
    return frames.withColumn("recent", F.coalesce(recent, F.lit(0.0))).where(F.col(diff) > F.greatest(F.lit(least), ratio * F.col("recent")))


def keyframes(cands: DataFrame, min_shift: float = 0.10, max_gap: float = 2.0, blur: float = 0.5, key: str = "shot_key", min_move: float | None = None) -> DataFrame:
    """The sharpest candidate of each motion bin, with blurry and gap_before.

    A step is the larger of motion and time as shares of their limits; motion is the way between fixes (e, n, u) where
    min_move is given and both are known, else the shift, and 1 where that is unknown. Bins are whole numbers of summed steps. Ties go to the earlier frame.
    A gap is a jump of more than two bins between frames that aren't blurry. Expects the column shot.
    """
    if min(min_shift, max_gap, min_move or 1.0) <= 0:
        raise ValueError("limits must be above 0")
    own = Window.partitionBy(key, "shot").orderBy("frame")
    move = F.when(F.col("shift").isNull(), 1.0).otherwise(F.col("shift") / min_shift)
    if min_move:
        way = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(own), F.lit(2)) for c in "nu"), F.pow(F.col("e") - F.lag("e").over(own), F.lit(2))))
        move = F.coalesce(way / min_move, move)
    step = F.when(F.lag("frame").over(own).isNull(), 0.0).otherwise(F.greatest(move, (F.col("t") - F.lag("t").over(own)) / max_gap))
    binned = cands.withColumn("__s", step).withColumn("bin", F.floor(F.sum("__s").over(own) + 1e-9).cast("long"))
    best = Window.partitionBy(key, "shot", "bin").orderBy(F.desc("sharpness"), "frame")
    med = binned.groupBy(key, "shot").agg(F.percentile("sharpness", F.lit(0.5)).alias("__m"))
    kept = binned.withColumn("__r", F.row_number().over(best)).where("__r = 1").join(med, [key, "shot"]).withColumn("blurry", F.col("sharpness") < blur * F.col("__m"))
    last = F.last(F.when(~F.col("blurry"), F.col("bin")), True).over(own.rowsBetween(Window.unboundedPreceding, -1))
    return kept.select(key, "shot", "bin", "frame", "t", "sharpness", "blurry", (~F.col("blurry") & F.coalesce(F.col("bin") - last > 2, F.lit(False))).alias("gap_before"))


def split_at_cuts(cands: DataFrame, cuts: DataFrame, key: str = "shot_key") -> DataFrame:
    """Adds shot: a candidate opens one when a cut (key, frame) lies after the candidate before it and not after itself.

    Cuts and candidates are one ordered stream, so a cut meets only its neighbours.
    """
    both = cands.withColumn("__k", F.lit(1)).unionByName(cuts.select(key, "frame", F.lit(0).alias("__k")), allowMissingColumns=True)
    before = Window.partitionBy(key).orderBy("frame", "__k").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__n", F.sum(1 - F.col("__k")).over(before)).where("__k = 1").drop("__k")
    w = _by(key, "frame")
    new = F.coalesce((F.col("__n") > F.lag("__n").over(w)).cast("int"), F.lit(0))
    return seen.withColumn("__c", new).withColumn("shot", F.sum("__c").over(w).cast("long")).drop("__c", "__n")


def segment_choice(cands: DataFrame, choice: str | int = "all", key: str = "shot_key") -> DataFrame:
    """Candidates of the chosen shots: all, the longest (the first on ties), or the one of a number."""
    if choice == "all":
        return cands
    if choice != "longest":
        return cands.where(F.col("shot") == int(choice))
    size = cands.groupBy(key, "shot").agg(F.count("*").alias("__n"))
    best = size.groupBy(key).agg(F.max_by("shot", F.struct("__n", -F.col("shot"))).alias("shot"))
    return cands.join(best, [key, "shot"], "left_semi")


def every_nth(rows: DataFrame, n: int, key: str = KEY, order: str = ORDER) -> DataFrame:
    """The first row of each key and every n-th after it."""
    return rows.withColumn("__r", F.row_number().over(_by(key, order)) - 1).where(F.col("__r") % n == 0).drop("__r")


def chronological(rows: DataFrame, value: str, key: str = KEY, order: str = ORDER) -> DataFrame:
    """(key, in_order): whether the value never falls."""
    ok = rows.withColumn("__ok", F.coalesce(F.col(value) >= F.lag(value).over(_by(key, order)), F.lit(True)))
    return ok.groupBy(key).agg(F.bool_and("__ok").alias("in_order"))


def gps_summary(track: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """(key, tagged_frames, track_length_m, median_spacing_m, low_m, high_m) of fixes (e, n, u); heights from the first fix."""
    w = _by(key, order)
    way = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), F.lit(2)) for c in "nu"), F.pow(F.col("e") - F.lag("e").over(w), F.lit(2))))
    p = track.withColumns({"way": way, "h": F.col("u") - F.first("u").over(w)})
    return p.groupBy(key).agg(F.count("*").alias("tagged_frames"), F.coalesce(F.sum("way"), F.lit(0.0)).alias("track_length_m"), F.coalesce(F.median("way"), F.lit(0.0)).alias("median_spacing_m"), F.min("h").alias("low_m"), F.max("h").alias("high_m"))


def strip_counts(strips_: DataFrame, key: str = KEY) -> DataFrame:
    """(key, strip, photos, most): photos of each strip; most marks the fullest one, the first on ties."""
    n = strips_.groupBy(key, "strip").agg(F.count("*").alias("photos"))
    best = F.max_by("strip", F.struct("photos", -F.col("strip"))).over(Window.partitionBy(key))
    return n.withColumn("most", F.col("strip") == best)


def coverage(times: DataFrame, fixes: DataFrame, margin: float = 0.5, key: str = KEY) -> DataFrame:
    """(key, keyframes, outside, covered): how many times t lie within the telemetry, give or take the margin; null without telemetry."""
    span = fixes.groupBy(key).agg(F.min("t").alias("__a"), F.max("t").alias("__b"))
    inside = F.col("t").between(F.col("__a") - margin, F.col("__b") + margin).cast("long")
    g = times.join(span, key, "left").groupBy(key).agg(F.count("*").alias("keyframes"), F.sum(1 - inside).alias("outside"), F.avg(inside).alias("covered"))
    return g


def logical_flights(spans: DataFrame, gap_s: float = 30.0, key: str = KEY) -> DataFrame:
    """Adds flight: consecutive shots join when the pause is short and the jump is one that a drone can make in it."""
    w = _by(key, "shot")
    pause = F.col("start_s") - F.lag("end_s").over(w)
    jump = F.hypot(F.col("start_e") - F.lag("end_e").over(w), F.col("start_n") - F.lag("end_n").over(w))
    apart = F.when(F.lag("shot").over(w).isNull(), 0).otherwise(((pause > gap_s) | F.coalesce(jump > 25.0 + 30.0 * F.greatest(pause, F.lit(0.0)), F.lit(False))).cast("int"))
    return spans.withColumn("__a", apart).withColumn("flight", F.sum("__a").over(w).cast("long")).drop("__a")


def flight_summaries(spans: DataFrame, key: str = KEY) -> DataFrame:
    """(key, flight, shots, frames, start_s, end_s, duration_s, distance_m, largest) of shots with their flight; the first of the largest on ties."""
    g = spans.groupBy(key, "flight").agg(F.count("*").alias("shots"), F.sum("frames").alias("frames"), F.min("start_s").alias("start_s"), F.max_by("end_s", "shot").alias("end_s"), F.sum("distance_m").alias("distance_m"))
    best = F.max_by("flight", F.struct("frames", -F.col("flight"))).over(Window.partitionBy(key))
    return g.withColumn("duration_s", F.col("end_s") - F.col("start_s")).withColumn("largest", F.col("flight") == best)


def count_reversals(values: Column, limit: Column) -> Column:
    """Turns of at least limit in an array of positions, by a fold with hysteresis."""
    start = F.struct(F.lit(0).alias("dir"), F.element_at(values, 1).alias("ext"), F.lit(0).alias("n"))
    state = lambda d, x, n: F.struct(d.cast("int").alias("dir"), x.alias("ext"), n.cast("int").alias("n"))

    def step(s, v):
        ahead = (v - s["ext"]) * s["dir"]
        return (
            F.when((s["dir"] == 0) & (F.abs(v - s["ext"]) >= limit), state(F.when(v > s["ext"], 1).otherwise(-1), v, s["n"]))
            .when(s["dir"] == 0, state(s["dir"], s["ext"], s["n"]))
            .when(ahead > 0, state(s["dir"], v, s["n"]))
            .when(-ahead >= limit, state(-s["dir"], v, s["n"] + 1))
            .otherwise(state(s["dir"], s["ext"], s["n"]))
        )

    return F.when(F.size(values) < 2, 0).otherwise(F.aggregate(values, start, step, lambda s: s["n"]))


def revisits(track: DataFrame, key: str = KEY) -> DataFrame:
    """(key, revisit_score, loop_closures) of a track with arc, radius and away.

    A point revisits when an earlier one lies within the radius and at least `away` metres of path before it. Points
    meet through a grid of cells of the radius, so only neighbours are compared.
    """
    p = track.withColumns({"ci": F.floor(F.col("e") / F.col("radius")), "cj": F.floor(F.col("n") / F.col("radius"))})
    old = p.select(F.col(key).alias("k2"), F.col("e").alias("e2"), F.col("n").alias("n2"), F.col("arc").alias("a2"), F.explode(F.sequence(F.col("ci") - 1, F.col("ci") + 1)).alias("gi"), "cj")
    old = old.select("k2", "e2", "n2", "a2", "gi", F.explode(F.sequence(F.col("cj") - 1, F.col("cj") + 1)).alias("gj"))
    near = (F.col(key) == F.col("k2")) & (F.col("ci") == F.col("gi")) & (F.col("cj") == F.col("gj")) & (F.col("a2") <= F.col("arc") - F.col("away")) & (F.hypot(F.col("e") - F.col("e2"), F.col("n") - F.col("n2")) <= F.col("radius"))
    hits = p.join(old, near, "left_semi").select(key, ORDER, F.lit(1).alias("hit"))
    flags = track.select(key, ORDER).join(hits, [key, ORDER], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    w = _by(key, ORDER)
    rise = ((F.col("hit") == 1) & (F.coalesce(F.lag("hit").over(w), F.lit(0)) == 0)).cast("long")
    return flags.withColumn("rise", rise).groupBy(key).agg(F.avg("hit").alias("revisit_score"), F.sum("rise").alias("loop_closures"))
