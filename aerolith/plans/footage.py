"""Queries on candidates, segments, flights and photo tracks, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tracks as T
from .catalog import _SHOTS, _SPANS, CANDS, ENU, FIXES, _kept, cands, fixes, plane, query, r6

_PLACED = f"select c.*, p.e, p.n, p.u from ({_SHOTS}) c left join (select flight_id, seq * 6 as frame, e, n, u from ({ENU}) q) p on p.flight_id = c.shot_key and p.frame = c.frame"
_WAY = "sqrt(pow(e - lag(e) over w, 2) + pow(n - lag(n) over w, 2) + pow(u - lag(u) over w, 2))"


@query(_kept(_PLACED, f"coalesce({_WAY} / 8.0, case when shift is null then 1.0 else shift / 0.1 end)"))
def keyframes_by_move(s, d):
    at = plane(s, d).select(F.col("flight_id").alias("shot_key"), (F.col("seq") * 6).alias("frame"), "e", "n", "u")
    return T.keyframes(T.shots(cands(s, d)).join(at, ["shot_key", "frame"], "left"), min_move=8.0).withColumn("t", F.round("t", 6))


_CUTS = f"select shot_key, frame - 3 as frame from ({CANDS}) c where is_cut union all select shot_key, frame as frame from ({CANDS}) c where is_cut and sharpness > 50 union all select distinct shot_key, 99999 as frame from ({CANDS}) c"
_SEGMENTS = f"""with c as ({CANDS}), x as ({_CUTS}), k as (select c.shot_key, c.frame, c.t, count(x.frame) as n from c left join x on x.shot_key = c.shot_key and x.frame <= c.frame group by all),
f as (select *, coalesce(case when n > lag(n) over (partition by shot_key order by frame) then 1 else 0 end, 0) as new from k), g as (select shot_key, frame, t, cast(sum(new) over (partition by shot_key order by frame) as bigint) as shot from f)"""


def _segments(s, d):
    c = cands(s, d)
    cuts = c.where("is_cut").select("shot_key", F.explode(F.when(F.col("sharpness") > 50, F.array(F.col("frame") - 3, F.col("frame"))).otherwise(F.array(F.col("frame") - 3))).alias("frame"))
    return T.split_at_cuts(c, cuts.unionByName(c.select("shot_key", F.lit(99999).cast("long").alias("frame")).distinct()))


@query(f"{_SEGMENTS} select shot_key, frame, shot from g")
def segments_at_cuts(s, d):
    return _segments(s, d).select("shot_key", "frame", "shot")


@query(f"{_SEGMENTS}, z as (select shot_key, shot, count(*) as k from g group by all), b as (select shot_key, shot from (select *, row_number() over (partition by shot_key order by k desc, shot) as rn from z) y where rn = 1) select g.shot_key, frame, g.shot from g join b on g.shot_key = b.shot_key and g.shot = b.shot")
def longest_segment(s, d):
    return T.segment_choice(_segments(s, d), "longest").select("shot_key", "frame", "shot")


@query(f"select flight_id, seq from (select *, row_number() over (partition by flight_id order by seq) as rn from ({FIXES}) f) g where (rn - 1) % 7 = 0")
def every_seventh_fix(s, d):
    return T.every_nth(fixes(s, d), 7).select("flight_id", "seq")


@query(f"select flight_id, bool_and(coalesce(alt >= p, true)) as in_order from (select *, lag(alt) over (partition by flight_id order by seq) as p from ({FIXES}) f) g group by flight_id")
def chronological(s, d):
    return T.chronological(fixes(s, d), "alt")


@query(f"""with p as (select *, {_WAY} as way, u - first_value(u) over w as h from ({ENU}) q window w as (partition by flight_id order by seq))
select flight_id, count(*) as tagged_frames, round(coalesce(sum(way), 0), 5) as track_length_m, round(coalesce(median(way), 0), 5) as median_spacing_m, round(min(h), 5) as low_m, round(max(h), 5) as high_m from p group by flight_id""")
def gps_summary(s, d):
    return T.gps_summary(plane(s, d)).select("flight_id", "tagged_frames", *(F.round(c, 5).alias(c) for c in ("track_length_m", "median_spacing_m", "low_m", "high_m")))


@query(f"""with p as ({ENU}), h as (select *, degrees(atan2(e - lag(e) over w, n - lag(n) over w)) as h from p window w as (partition by flight_id order by seq)),
b as (select flight_id, seq, case when abs((h - lag(h) over w + 180.0) - 360.0 * floor((h - lag(h) over w + 180.0) / 360.0) - 180.0) > 45.0 then 1 else 0 end as b from h window w as (partition by flight_id order by seq)),
c as (select flight_id, cast(sum(b) over (partition by flight_id order by seq) as bigint) as strip from b), g as (select flight_id, strip, count(*) as photos from c group by all)
select flight_id, strip, photos, row_number() over (partition by flight_id order by photos desc, strip) = 1 as most from g""")
def strip_counts(s, d):
    return T.strip_counts(T.strips(plane(s, d)))


_EARLY = f"select flight_id, seq * 1.7e0 - 3.0e0 as t from ({FIXES}) f"


@query(f"""with q as ({_EARLY}), r as (select flight_id, min(t) as a, max(t) as b from ({FIXES}) f group by flight_id)
select q.flight_id, count(*) as keyframes, cast(sum(case when t between a - 0.5 and b + 0.5 then 0 else 1 end) as bigint) as outside, round(avg(case when t between a - 0.5 and b + 0.5 then 1.0 else 0.0 end), 6) as covered from q join r on q.flight_id = r.flight_id group by q.flight_id""")
def telemetry_coverage(s, d):
    q = fixes(s, d).select("flight_id", (F.col("seq") * 1.7 - 3.0).alias("t"))
    return T.coverage(q, fixes(s, d)).withColumn("covered", F.round("covered", 6))


@query(f"""with f as (select flight_id, t + 4.25e0 as t, alt from ({FIXES}) x), q as (select flight_id, t as q from ({_EARLY}) y), r as (select flight_id, min(t) as a, max(t) as b from f group by flight_id),
b as (select q.flight_id, q.q, max_by(f.t, f.t) filter (f.t <= q.q) as bt, max_by(f.alt, f.t) filter (f.t <= q.q) as bv, min_by(f.t, f.t) filter (f.t >= q.q) as ft, min_by(f.alt, f.t) filter (f.t >= q.q) as fv from q join f on q.flight_id = f.flight_id group by q.flight_id, q.q)
select b.flight_id, round(q, 6) as q, round(case when q < a - 0.5 or q > r.b + 0.5 then null when bt is null then fv when ft is null then bv when ft = bt then bv else bv + (fv - bv) * (q - bt) / (ft - bt) end, 6) as alt from b join r on b.flight_id = r.flight_id""")
def interpolation_with_offset(s, d):
    q = fixes(s, d).select("flight_id", (F.col("seq") * 1.7 - 3.0).cast("double").alias("q"))
    return T.interpolated(q, fixes(s, d), "alt", slack=0.5, offset=4.25).select("flight_id", r6("q"), r6("alt"))


_FRAMED = _SPANS.replace("select flight_id, seq // 8 as shot", "select flight_id, seq // 8 as shot, count(*) as frames")


@query(f"""with s as ({_FRAMED}), a as (select *, sqrt(pow(end_e - start_e, 2) + pow(end_n - start_n, 2)) as distance_m, case when lag(shot) over w is null then 0 when start_s - lag(end_s) over w > 1.2 or sqrt(pow(start_e - lag(end_e) over w, 2) + pow(start_n - lag(end_n) over w, 2)) > 25.0 + 30.0 * greatest(start_s - lag(end_s) over w, 0) then 1 else 0 end as apart from s window w as (partition by flight_id order by shot)),
b as (select *, cast(sum(apart) over (partition by flight_id order by shot) as bigint) as flight from a), g as (select flight_id, flight, count(*) as shots, cast(sum(frames) as bigint) as frames, min(start_s) as start_s, max_by(end_s, shot) as end_s, sum(distance_m) as distance_m from b group by all)
select flight_id, flight, shots, frames, round(start_s, 6) as start_s, round(end_s - start_s, 6) as duration_s, round(distance_m, 5) as distance_m, row_number() over (partition by flight_id order by frames desc, flight) = 1 as largest from g""")
def flight_summaries(s, d):
    p = plane(s, d).withColumn("shot", F.expr("seq div 8"))
    spans = p.groupBy("flight_id", "shot").agg(F.count("*").alias("frames"), F.min("t").alias("start_s"), F.max("t").alias("end_s"), *(f(c, "seq").alias(f"{k}_{c}") for k, f in (("start", F.min_by), ("end", F.max_by)) for c in "en"))
    spans = spans.withColumn("distance_m", F.hypot(F.col("end_e") - F.col("start_e"), F.col("end_n") - F.col("start_n")))
    g = T.flight_summaries(T.logical_flights(spans, 1.2))
    return g.select("flight_id", "flight", "shots", "frames", r6("start_s"), r6("duration_s"), F.round("distance_m", 5).alias("distance_m"), "largest")
