"""Flight validation: metrics of each track, and a verdict on whether it is one continuous forward pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geodesy import heading
from ..operators import tracks
from ..sources.scratch import stored

KEY, ORDER = tracks.KEY, tracks.ORDER


def metrics(fixes: DataFrame) -> DataFrame:
    """One row for each flight: points, noise, spikes, path, axis, reversals and revisits; null where not measured."""
    track = tracks.local_track(fixes)
    sigma = tracks.noise(track)
    marked = stored(tracks.spikes(track.join(sigma, KEY), F.greatest(F.lit(15.0), 6.0 * F.col("sigma"))), "marked")
    size = marked.groupBy(KEY).agg(F.count("*").alias("points"), F.sum(F.col("spike").cast("long")).alias("gps_outliers_removed"), (F.max("t") - F.min("t")).alias("duration_s"), F.first("sigma").alias("sigma"))
    w = Window.partitionBy(KEY).orderBy("t", ORDER)
    clean = marked.where("not spike").withColumn("i", F.row_number().over(w) - 1).drop("spike")
    speed = tracks.window_speeds(clean)

    # thinning: kept points lie about six sigma apart, and at least ten are kept
    timed = clean.withColumn("dt", F.col("t") - F.lag("t").over(w))
    ends = timed.groupBy(KEY).agg(F.count("*").alias("m"), F.median("dt").alias("dt"), (F.max("t") - F.min("t")).alias("span"), F.min_by(F.struct("e", "n"), "i").alias("a"), F.max_by(F.struct("e", "n"), "i").alias("b"), F.first("sigma").alias("s"))
    pace = F.greatest(F.hypot(F.col("b.e") - F.col("a.e"), F.col("b.n") - F.col("a.n")) / F.col("span") * F.col("dt"), F.lit(1e-9))
    bound = F.greatest(F.lit(1), F.floor(F.col("m") / 10))
    stride = F.when((F.col("m") < 3) | (F.col("s") <= 0) | (F.col("span") <= 0) | (F.col("dt") <= 0), 1).otherwise(F.greatest(F.lit(1), F.least(F.bround(6.0 * F.col("s") / F.when(F.col("span") > 0, pace)), bound)))
    strides = ends.select(KEY, "m", stride.cast("int").alias("stride"))

    # a centred mean whose width differs by flight, only at the kept points
    sums = clean.join(strides, KEY)
    lists = sums.groupBy(KEY).agg(F.first("m").alias("m"), F.first("stride").alias("stride"), F.array_sort(F.collect_list(F.struct("i", "e", "n"))).alias("p"))
    half = F.floor(F.col("stride") / 2).cast("int")
    picked = lists.select(KEY, "m", "stride", half.alias("half"), "p", F.explode(F.array_distinct(F.concat(F.sequence(F.lit(0), (F.col("m") - 1).cast("int"), F.col("stride")), F.array((F.col("m") - 1).cast("int"))))).alias("i"))
    part = F.slice("p", F.greatest(F.lit(0), F.col("i") - F.col("half")) + 1, F.least(F.col("m").cast("int") - 1, F.col("i") + F.col("half")) - F.greatest(F.lit(0), F.col("i") - F.col("half")) + 1)
    mean = lambda c: F.aggregate("__part", F.lit(0.0), lambda a, x: a + x[c]) / F.size("__part")
    thin = picked.withColumn("__part", part)
    extra = (F.col("i") == F.col("m") - 1) & (F.pmod(F.col("m") - 1, F.col("stride")) != 0)  # the real last position
    thin = thin.select(KEY, F.col("i").cast("long").alias(ORDER), *(F.when(extra, F.element_at("p", -1)[c]).otherwise(mean(c)).alias(c) for c in ("e", "n")))

    own = Window.partitionBy(KEY).orderBy(ORDER)
    walk = tracks.steps(stored(thin, "thinned")).withColumn("arc", F.sum(F.coalesce("step", F.lit(0.0))).over(own))
    shape = walk.groupBy(KEY).agg(
        F.count("*").alias("thinned_points"), F.sum("step").alias("path"), F.median("step").alias("median_step"), F.min_by(F.struct("e", "n"), ORDER).alias("a"), F.max_by(F.struct("e", "n"), ORDER).alias("b"),
        F.var_pop("e").alias("vee"), F.var_pop("n").alias("vnn"), F.covar_pop("e", "n").alias("ven"))
    de, dn = F.col("b.e") - F.col("a.e"), F.col("b.n") - F.col("a.n")
    root = F.sqrt(F.pow((F.col("vee") - F.col("vnn")) / 2, F.lit(2)) + F.col("ven") * F.col("ven"))
    angle = F.atan2(2 * F.col("ven"), F.col("vee") - F.col("vnn")) / 2
    ax, ay = F.cos(angle), F.sin(angle)
    along = ax * de + ay * dn
    flip = F.when(F.abs(along) < 1e-9, F.when((ax < 0) | ((ax == 0) & (ay < 0)), -1.0).otherwise(1.0)).when(along < 0, -1.0).otherwise(1.0)
    total = F.greatest(F.col("vee") + F.col("vnn"), F.lit(1e-12))
    shape = shape.withColumns({"displacement": F.hypot(de, dn), "ax": ax * flip, "ay": ay * flip, "straight": ((F.col("vee") + F.col("vnn")) / 2 + root) / total})
    shape = shape.withColumns({"radius": F.greatest(F.lit(4.0), F.least(F.lit(20.0), 0.02 * F.col("path")))}).withColumn("away", F.greatest(2 * F.col("radius"), 0.05 * F.col("path")))
    shape = stored(shape, "shape")
    on = walk.join(shape.select(KEY, "ax", "ay", "a", "radius", "away"), KEY)
    on = on.withColumns({"along": (F.col("e") - F.col("a.e")) * F.col("ax") + (F.col("n") - F.col("a.n")) * F.col("ay"), "side": F.abs((F.col("n") - F.col("a.n")) * F.col("ax") - (F.col("e") - F.col("a.e")) * F.col("ay"))})
    go = on.withColumn("d", F.col("along") - F.lag("along").over(own))
    axis = go.groupBy(KEY).agg(F.sum(F.greatest("d", F.lit(0.0))).alias("fw"), F.sum(F.greatest(-F.col("d"), F.lit(0.0))).alias("bw"), F.percentile("side", F.lit(0.9)).alias("lateral"), (F.max("along") - F.min("along")).alias("reach"), F.array_sort(F.collect_list(F.struct(ORDER, "along"))).alias("path_along"))
    axis = axis.withColumn("direction_reversals", tracks.count_reversals(F.transform("path_along", lambda x: x["along"]), F.greatest(F.lit(5.0), 0.1 * F.col("reach")))).drop("path_along", "reach")
    back = tracks.revisits(on.select(KEY, ORDER, "e", "n", "arc", "radius", "away"))

    out = size.join(speed, KEY, "left").join(strides, KEY, "left").join(shape, KEY, "left").join(axis, KEY, "left").join(back, KEY, "left")
    judged = (F.col("points") >= 8) & (F.col("points") - F.col("gps_outliers_removed") >= 8)
    long = judged & (F.col("path") >= 20.0)
    r = lambda c, k: F.round(c, k)
    return out.select(
        KEY, F.col("points").cast("long").alias("points"), r("duration_s", 2).alias("duration_s"), F.col("gps_outliers_removed").cast("long").alias("gps_outliers_removed"), F.col("sigma"),
        r(F.coalesce("discontinuous", F.lit(0.0)), 3).alias("discontinuous_step_fraction"), r("max_speed", 2).alias("max_speed_mps"),
        F.when(judged, F.col("stride").cast("long")).alias("thinning_stride"), F.when(judged, F.col("thinned_points").cast("long")).alias("thinned_points"), F.when(judged, r("median_step", 2)).alias("median_track_step_m"),
        F.when(judged, r("path", 2)).alias("path_length_m"), F.when(judged, r("displacement", 2)).alias("displacement_m"),
        F.when(judged, F.when(F.col("path") > 0, r(F.col("displacement") / F.when(F.col("path") > 0, F.col("path")), 3)).otherwise(0.0)).alias("path_efficiency"),
        F.when(long, r(heading(F.col("ax"), F.col("ay")), 1)).alias("dominant_heading_deg"), F.when(long, r("straight", 3)).alias("straightness"), F.when(long, r("lateral", 2)).alias("lateral_deviation_m"),
        F.when(long, r(F.col("fw") / F.greatest(F.col("fw") + F.col("bw"), F.lit(1e-9)), 3)).alias("forward_fraction"), F.when(long, F.col("direction_reversals").cast("long")).alias("direction_reversals"),
        F.when(long, r("revisit_score", 3)).alias("revisit_score"), F.when(long, F.col("loop_closures").cast("long")).alias("loop_closures"),
    )


def verdicts(m: DataFrame) -> DataFrame:
    """Adds status, single_pass and reasons by fixed rules, in order: not judgeable, not continuous, hard, soft, weak, clean."""
    c = F.col
    fired = lambda *pairs: F.array_compact(F.array(*(F.when(cond, F.lit(name)) for cond, name in pairs)))
    hard = fired((c("path_efficiency") < 0.15, "closed_loop"), ((c("revisit_score") >= 0.6) & (c("path_efficiency") < 0.3), "re-covers_ground"), (1 - c("forward_fraction") >= 0.55, "repeated_passes"))
    soft = fired((c("path_efficiency") < 0.55, "weak_progress"), (1 - c("forward_fraction") > 0.2, "goes_backwards"), (c("revisit_score") > 0.25, "comes_back"), (c("direction_reversals") > 2, "turn_backs"))
    weak = fired((c("path_length_m") < 50.0, "short"), (c("gps_outliers_removed") >= F.greatest(F.lit(3.0), 0.1 * c("points")), "spikes_removed"), (c("points") < 20, "few_positions"))
    early = F.when(c("points") < 8, "too_few_positions").when(c("points") - c("gps_outliers_removed") < 8, "nearly_all_outliers").when(c("path_length_m") < 20.0, "too_short").when(c("discontinuous_step_fraction") > 0.15, "not_continuous")
    noisy = (c("sigma") > 0) & (c("median_track_step_m") < 3.0 * c("sigma"))
    x = m.withColumns({"__early": early, "__hard": hard, "__soft": soft, "__weak": weak})
    negative = F.size("__hard") + F.size("__soft") > 0
    status = F.when(c("__early").isNotNull() | (negative & noisy), "unknown").when(F.size("__hard") > 0, "invalid").when(F.size("__soft") > 0, "suspicious").when(F.size("__weak") > 0, "valid_with_warning").otherwise("valid")
    why = F.when(c("__early").isNotNull(), F.array("__early")).when(negative & noisy, F.array(F.lit("jitter"))).when(F.size("__hard") > 0, c("__hard")).when(F.size("__soft") > 0, c("__soft")).otherwise(c("__weak"))
    x = x.withColumns({"status": status, "reasons": F.concat_ws(",", why)})
    single = F.when(c("status").isin("valid", "valid_with_warning"), True).when(c("status").isin("suspicious", "invalid"), False)
    return x.withColumn("single_pass", single).withColumn("sigma", F.round("sigma", 2)).drop("__early", "__hard", "__soft", "__weak")


def combined(tracks_: DataFrame, key: str = KEY) -> DataFrame:
    """The verdict over a flight's tracks: the most severe that could be judged, the first track on ties; unknown has no say."""
    severity = F.create_map(*(F.lit(x) for kv in {"valid": 0, "valid_with_warning": 1, "suspicious": 3, "invalid": 4}.items() for x in kv))
    t = tracks_.withColumn("sev", severity[F.col("status")])
    return t.groupBy(key).agg(F.coalesce(F.max_by("status", F.struct("sev", -F.col("ord"))), F.lit("unknown")).alias("status"), F.count("sev").alias("judged"))


def decision(status, policy: str = "enforce", allow: bool = False):
    """continue, stop or overridden, as a column."""
    bad = status.isin("suspicious", "invalid")
    return F.when(~bad | F.lit(policy in ("warn", "off")), "continue").when(F.lit(allow), "overridden").otherwise("stop")
