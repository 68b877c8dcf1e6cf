"""Reports on runs: the flight's verdict over both tracks, what a run established, timings, lines for people."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from ..operators import tracks
from . import flight

# fixed values: names and limits that reports state
THRESHOLDS = {
    "max_plausible_speed_mps": 30.0, "discontinuous_step_fraction": 0.15, "min_track_points": 8, "min_path_length_m": 20.0, "short_track_m": 50.0,
    "efficiency_invalid": 0.15, "efficiency_suspicious": 0.55, "backward_invalid": 0.55, "backward_suspicious": 0.20, "revisit_invalid": 0.60, "revisit_suspicious": 0.25,
    "reversals_suspicious": 2, "min_speed_window_s": 1.0, "speed_noise_allowance_m": 25.0, "revisit_radius_m": [4.0, 20.0], "reversal_min_m": [5.0, 0.10], "keyframe_coverage_missing": 0.05,
}
SEVERITY = {"valid": 0, "valid_with_warning": 1, "suspicious": 3, "invalid": 4}
SOURCES = ("keyframes_fused", "telemetry_fused")
COPIED = ["path_length_m", "displacement_m", "path_efficiency", "dominant_heading_deg", "lateral_deviation_m", "straightness", "direction_reversals", "forward_fraction", "revisit_score", "loop_closures", "discontinuous_step_fraction", "max_speed_mps", "gps_outliers_removed", "duration_s", "points", "thinned_points", "thinning_stride", "median_track_step_m"]


def severity(status: Column) -> Column:
    """Rank of a verdict; null for one that could not be given."""
    return F.create_map(*(F.lit(x) for kv in SEVERITY.items() for x in kv))[status]


def thresholds() -> Column:
    """The limits as a map from name to JSON text."""
    import json

    return F.create_map(*(F.lit(x) for k, v in THRESHOLDS.items() for x in (k, json.dumps(v))))


def place(lat: Column, lon: Column, alt: Column) -> Column:
    return F.struct(F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"), F.round(alt, 2).alias("alt"))


def combined(judged: DataFrame, key: str = flight.KEY) -> DataFrame:
    """(key, status, single_pass, source, reasons, warnings, unjudged) from tracks (key, ord, source, status, single_pass, reasons, warnings).

    The most severe verdict that could be given wins, the first track on ties; its reasons are those of all tracks as severe. Without any
    the verdict is unknown, for all tracks' reasons. Warnings of tracks that could not be judged come last. Lists keep their first of equal entries.
    """
    t = judged.withColumn("__s", severity(F.col("status")))
    w = Window.partitionBy(key)
    t = t.withColumns({"__top": F.max("__s").over(w), "__say": F.col("__s").isNull()})
    lead = F.coalesce(F.col("__s") == F.col("__top"), F.lit(False))
    none = F.col("__top").isNull()
    items = lambda c, when: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("ord", c)))), lambda x: x[c])
    unite = lambda a: F.array_distinct(F.flatten(a))
    first = lambda c: F.min_by(c, F.when(lead, F.col("ord")))
    g = t.groupBy(key).agg(
        F.coalesce(F.max("__top").isNotNull(), F.lit(False)).alias("__any"), first("status").alias("__status"), first("single_pass").alias("__single"), first("source").alias("__source"),
        unite(items("reasons", lead | none)).alias("reasons"), items("warnings", lead).alias("__w1"), items("warnings", F.col("__say")).alias("__w2"), F.transform(F.array_sort(F.collect_list(F.when(F.col("__say"), F.struct("ord", "source")))), lambda x: x["source"]).alias("unjudged"))
    return g.select(
        key, F.when(F.col("__any"), F.col("__status")).otherwise("unknown").alias("status"), F.when(F.col("__any"), F.col("__single")).alias("single_pass"), F.when(F.col("__any"), F.col("__source")).alias("source"),
        F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.when(F.col("__any"), F.array().cast("array<string>")).otherwise(F.array(F.lit("no_judgeable_track")))).alias("reasons"),
        unite(F.concat("__w1", "__w2")).alias("warnings"), "unjudged")


def decided(status: Column, policy: str = "enforce", allow: bool = False) -> Column:
    """(action, overridden) of a verdict: enforce stops suspicious and invalid runs unless allowed, warn and off go on."""
    bad = status.isin("suspicious", "invalid")
    held = F.lit(policy == "enforce") & bad
    return F.struct(F.when(held & F.lit(not allow), "stop").otherwise("continue").alias("action"), (held & F.lit(allow)).alias("overridden"))


def validated(keyframes: DataFrame, telemetry: DataFrame | None = None, *, fallback: DataFrame | None = None, logical: DataFrame | None = None, policy: str = "enforce", allow: bool = False, key: str = flight.KEY) -> DataFrame:
    """One row for each run: verdict over the keyframe track and the telemetry track, the deciding track's metrics, warnings and what to do.

    keyframes and telemetry are fixes (key, seq, t, lat, lon, alt); a keyframe without a position has nulls. Over a twentieth of the keyframes
    outside the telemetry's times leaves the keyframe track unjudged, and a good verdict without a judged keyframe track is unknown. fallback (key, fallback_used) and logical (key, shots, flights) add warnings.
    """
    runs = keyframes.groupBy(key).agg(F.count("*").alias("keyframes"), F.count_if(F.col("lat").isNotNull() & ~F.isnan("lat")).alias("keyframes_with_position"))
    known = keyframes.where("lat is not null and lon is not null and alt is not null and not isnan(lat)")
    ends = known.groupBy(key).agg(*(f(place(*(F.col(c) for c in ("lat", "lon", "alt"))), "seq").alias(n) for f, n in ((F.min_by, "trajectory_start"), (F.max_by, "trajectory_end"))))
    runs = runs.join(ends, key, "left")
    if policy == "off":
        return runs.select(key, F.lit("skipped").alias("status"), F.lit(None).cast("boolean").alias("single_pass"), F.lit("continue").alias("action"), F.lit(False).alias("overridden"), "keyframes", "keyframes_with_position", F.array(F.lit("not_checked")).alias("warnings"))
    given = telemetry if telemetry is not None else keyframes.limit(0)
    cover = tracks.coverage(keyframes, given, key=key).select(key, "outside", F.round("covered", 3).alias("covered"))
    runs = runs.join(cover, key, "left").join(given.groupBy(key).agg(F.count("*").alias("telemetry_fixes")), key, "left").withColumn("telemetry_fixes", F.coalesce("telemetry_fixes", F.lit(0)))
    lost = F.coalesce(F.col("outside") > THRESHOLDS["keyframe_coverage_missing"] * F.col("keyframes"), F.lit(False))
    judged = []
    for i, (source, fixes) in enumerate(zip(SOURCES, (keyframes, given))):
        m = flight.verdicts(flight.metrics(fixes)).withColumns({"ord": F.lit(i), "source": F.lit(source), "reasons": F.filter(F.split("reasons", ","), lambda x: x != "")})
        if not i:
            m = runs.select(key, lost.alias("__lost")).join(m.drop("ord", "source"), key, "left").withColumns({"ord": F.lit(0), "source": F.lit(source), "status": F.when(F.col("__lost"), "unknown").otherwise(F.coalesce("status", F.lit("unknown")))})
            m = m.withColumn("single_pass", F.when(~F.col("__lost"), F.col("single_pass"))).withColumn("reasons", F.concat(F.when(F.col("__lost"), F.array(F.lit("keyframes_outside_telemetry"))).otherwise(F.array().cast("array<string>")), F.coalesce("reasons", F.array(F.lit("too_few_positions"))))).drop("__lost")
        judged.append(m.withColumn("warnings", F.when(F.col("status") == "unknown", F.array(F.concat(F.col("source"), F.lit(":"), F.coalesce(F.get("reasons", F.lit(0)), F.lit("no_verdict"))))).otherwise(F.array().cast("array<string>"))))
    both = flight.stored(judged[0].unionByName(judged[1], allowMissingColumns=True), "judged")
    own = both.where("ord = 0").select(key, F.col("status").alias("__own"), F.get("reasons", F.lit(0)).alias("__why"))
    out = runs.join(combined(both, key), key).join(own, key)
    downgraded = F.col("status").isin("valid", "valid_with_warning") & (F.col("__own") == "unknown")
    out = out.withColumns({"__down": downgraded}).withColumns({"reasons": F.when(F.col("__down"), F.concat(F.array(F.concat(F.lit("keyframe_track_unjudged:"), F.coalesce("__why", F.lit("no_verdict")))), "reasons")).otherwise(F.col("reasons")), "single_pass": F.when(~F.col("__down"), F.col("single_pass")), "source": F.when(~F.col("__down"), F.col("source")), "status": F.when(F.col("__down"), "unknown").otherwise(F.col("status"))})
    for extra, columns in ((fallback, {"fallback_used": "boolean"}), (logical, {"shots": "long", "flights": "long"})):
        out = out.join(extra.select(key, *columns), key, "left") if extra is not None else out.withColumns({c: F.lit(None).cast(k) for c, k in columns.items()})
    missing = F.col("keyframes") - F.col("keyframes_with_position")
    say = lambda cond, text: F.when(F.coalesce(cond, F.lit(False)), text)
    early = [say(F.col("flights") > 1, F.concat(F.lit("several_flights:"), F.col("flights").cast("string"))), say(F.col("telemetry_fixes") == 0, F.lit("no_telemetry"))]
    late = [say(F.col("source").isNotNull() & (F.size("unjudged") > 0), F.concat(F.lit("verdict_from:"), "source")), say(missing > 0, F.concat(F.lit("keyframes_without_position:"), missing.cast("string"))), say(F.col("outside") > 0, F.concat(F.lit("keyframes_outside_telemetry:"), F.col("outside").cast("string"))), say(F.col("fallback_used"), F.lit("fusion_fallback"))]
    notes = F.array_distinct(F.concat(F.array_compact(F.array(*early)), "warnings", F.array_compact(F.array(*late))))
    metrics = both.select(key, "source", F.col("status").alias("__status"), *COPIED)
    out = out.withColumn("warnings", notes).withColumn("__do", decided(F.col("status"), policy, allow)).join(metrics, [key, "source"], "left")
    same = F.col("__status") == F.col("status")
    return out.select(
        key, "status", "single_pass", F.col("__do.action").alias("action"), F.col("__do.overridden").alias("overridden"), F.when(same, F.col("source")).alias("trajectory_source"), "telemetry_fixes", "keyframes", "keyframes_with_position", F.col("outside").alias("keyframes_outside_telemetry"), F.col("covered").alias("telemetry_coverage"),
        "trajectory_start", "trajectory_end", F.col("shots").alias("video_shots"), F.col("flights").alias("logical_flights"), "reasons", "warnings", *(F.when(same, F.col(c)).alias(c) for c in COPIED))


def report_lines(runs: DataFrame, key: str = flight.KEY) -> DataFrame:
    """(key, n, line): a summary line, then reasons, then warnings of each run, in order."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    head = F.concat(F.lit("Flight validation: "), F.upper("status"), F.lit(" (single pass "), text("single_pass"), F.lit(")  path "), text("path_length_m"), F.lit(" m  displacement "), text("displacement_m"), F.lit(" m  efficiency "), text("path_efficiency"), F.lit("  reversals "), text("direction_reversals"), F.lit("  revisit "), text("revisit_score"))
    listed = F.concat(F.array(head), F.transform("reasons", lambda x: F.concat(F.lit("  - "), x)), F.transform("warnings", lambda x: F.concat(F.lit("WARNING: "), x)))
    lines = F.when(F.col("status") == "skipped", F.array(F.lit("Flight validation: skipped"))).otherwise(listed)
    return runs.select(key, F.posexplode(lines).alias("n", "line"))


def timings(stages: DataFrame, key: str = "run") -> DataFrame:
    """(key, stages, seconds, minutes) of stage times (key, stage, seconds)."""
    return stages.groupBy(key).agg(F.count("*").alias("stages"), F.round(F.sum("seconds"), 1).alias("seconds"), F.round(F.sum("seconds") / 60, 1).alias("minutes"))


# fixed values: parts of a run's report, and the numbers that each claim states from its part
_CLAIMED = {
    "point_cloud": ("classified_cloud", {"points": "points", "seen_by_2plus_cameras": "seen_by_2plus_cameras", "median_cameras_per_point": "median_views"}),
    "ai_classification": ("classified_cloud", {"labelled_share": "labelled_by_ai"}),
    "gap_filling": ("gap_filling", {"inferred_points": "inferred_points_added", "inferred_share": "inferred_share", "measured_points": "measured_points", "median_depth_fit_error": "median_depth_fit_error"}),
}
_FLOWN = ("single_pass", "path_efficiency", "revisit_score", "direction_reversals", "trajectory_source", "policy", "overridden", "warnings")
_FUSED = {"gps_fusion_quality": "quality", "median_horizontal_gps_std_m": "median_h_std_m", "fusion_fallback_used": "fallback_used"}
REFERENCES = ("accuracy_vs_lidar", "accuracy_vs_buildings", "accuracy_camera_positions")


class _Number(str):
    pass


@F.pandas_udf(MapType(StringType(), StringType()))
def _numbers(reports: pd.Series) -> pd.Series:
    """Numbers of the parts of reports, as part.name, in the report's own digits."""
    def of(text: str | None) -> dict[str, str]:
        try:
            report = json.loads(text if isinstance(text, str) else "{}", parse_float=_Number, parse_int=_Number)
        except (ValueError, RecursionError):
            return {}
        parts = report.items() if isinstance(report, dict) else ()
        return {f"{part}.{name}": str(v) for part, values in parts if isinstance(values, dict) for name, v in values.items() if isinstance(v, _Number)}

    return reports.map(of)


def quality_summary(runs: DataFrame, key: str = "run") -> DataFrame:
    """(key, claim, status, facts) of runs' reports (key, report: JSON text): six claims, each from its own part; what was not run says so.

    facts maps names to JSON text, null where the report has no number: nothing is worked out or filled in here. Numbers
    stay as the report writes them (0.10, 1e3), of which get_json_object would make 0.1 and 1000.0.
    """
    at = lambda path: F.get_json_object("report", f"$.{path}")
    runs = runs.select(key, "report", _numbers("report").alias("written"))

    def fact(part: str, name: str) -> Column:
        text, exact = at(f"{part}.{name}"), F.try_element_at("written", F.lit(f"{part}.{name}"))
        return F.when(text.try_cast("double") == exact.try_cast("double"), exact).otherwise(text)

    there = lambda path: at(path).isNotNull() & ~at(path).isin("", "{}", "[]", "null", "false", "0")
    ok = F.coalesce(at("reconstruction.ok") == "true", F.lit(False))
    tried = F.coalesce(at("reconstruction.attempted") == "true", F.lit(False))
    facts = lambda **k: F.create_map(*(x for name, v in k.items() for x in (F.lit(name), v)))
    truth = F.coalesce(*(F.when(there(r), at(r)) for r in REFERENCES))
    gps = {k: fact("gps_fusion", v) for k, v in _FUSED.items()} | {"accuracy_vs_reference": truth}
    claims = [
        ("reconstruction", F.when(ok, "success").when(tried, "failed").otherwise("not_attempted"), facts(attempts=fact("reconstruction", "attempts"), outputs=F.when(there("outputs"), F.to_json(F.array_sort(F.json_object_keys(at("outputs"))))))),
        ("single_pass", F.coalesce(at("flight_validation.status"), F.lit("unknown")), facts(**{c: fact("flight_validation", c) for c in _FLOWN})),
        ("georeferencing", F.when(truth.isNotNull(), "measured_against_reference").when(ok, "gps_anchored_no_independent_reference").otherwise("not_run"), facts(**gps)),
    ]
    for claim, (part, columns) in _CLAIMED.items():
        other = F.when(ok, "measured_not_classified").otherwise("not_run") if claim == "point_cloud" else F.lit("not_run")
        claims.append((claim, F.when(there(part), "measured").otherwise(other), facts(**{k: fact(part, v) for k, v in columns.items()})))
    rows = F.array(*(F.struct(F.lit(n).alias("claim"), s.alias("status"), f.cast("map<string,string>").alias("facts")) for n, s, f in claims))
    return runs.select(key, F.inline(rows))
