"""Queries over the tables, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geodesy
from ..operators import fits, fusion
from ..operators import points as P
from ..operators import tracks as T
from . import flight

FLAGSHIP = "flight_validation"

# Views over the tables, in SQL that both engines read.
FIXES = """select flight_id, seq, cast(cast(seq as double)+cast(k%10 as double)/20.0 as double) as t,
       cast(41.0+n/111320.0 as double) as lat, cast(-81.0+e/84015.0 as double) as lon,
       cast(300.0+cast(k%7 as double) as double) as alt, cast(1+k%5 as double) as h_acc
from (select flight_id, seq, k,
        cast(case flight_id%5 when 0 then seq*5.0 when 1 then 5.0*(33-abs(33-seq))
             when 2 then 60.0*sin(seq*0.0951997774) when 3 then 8.0*floor(seq/16.0)
             else seq*0.1 end + (k-50)/50.0 as double) as e,
        cast(case flight_id%5 when 2 then 60.0*(1-cos(seq*0.0951997774))
             when 3 then 8.0*(8-abs(8-seq%16)) else 0.0 end + ((k*7)%100-50)/50.0 as double) as n
      from (select user_id as flight_id,
                   cast(row_number() over (partition by user_id order by event_id)-1 as bigint) as seq,
                   cast(regexp_extract(props,'[0-9]+',0) as int) as k
            from events) a) b"""
CANDS = """select user_id as shot_key, seq*6 as frame, cast(seq*0.2 as double) as t, value as sharpness,
       case when k%17=0 then null else cast((k%23)/100.0 as double) end as shift, event_type='error' as is_cut
from (select user_id, value, event_type,
             cast(row_number() over (partition by user_id order by event_id)-1 as bigint) as seq,
             cast(regexp_extract(props,'[0-9]+',0) as int) as k
      from events) a"""
POINTS = """select cast(l_orderkey*10+l_linenumber as bigint) as point_id, cast(l_quantity as double) as x, cast(l_extendedprice/1000.0 as double) as y,
       cast(l_discount*100.0 as double) as z, case l_returnflag when 'A' then 6 when 'N' then 2 else 5 end as classification,
       l_suppkey as shot, cast(l_linenumber as int) as cls from lineitem"""
FILES = "select doc_id, source as target, md5(text) as ino, cast(n_chars as bigint) as size from documents"
ENU = f"""select flight_id, seq, t, (lon + 81.0) * 84015.0 as e, (lat - 41.0) * 111320.0 as n, alt - 300.0 as u from ({FIXES}) f"""



def _bound(spark: SparkSession, sf_dir: str, sql: str, tables: tuple[str, ...]) -> DataFrame:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    sql = sql.replace("{", "{{").replace("}", "}}")
    for t in tables:
        sql = sql.replace(f"from {t}", f"from {{{t}}}")
    return spark.sql(sql, **frames)


fixes = lambda s, d: _bound(s, d, FIXES, ("events",))
cands = lambda s, d: _bound(s, d, CANDS, ("events",))
cloud = lambda s, d: _bound(s, d, POINTS, ("lineitem",))
files = lambda s, d: _bound(s, d, FILES, ("documents",))
plane = lambda s, d: _bound(s, d, ENU, ("events",))
r6 = lambda c, name=None: F.round(c, 6).alias(name or c)

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _ecef(lat: str, lon: str, alt: str) -> str:
    n = f"(6378137.0e0 / sqrt(1 - 0.0066943799901413165e0 * sin(radians({lat})) * sin(radians({lat}))))"
    return f"({n} + {alt}) * cos(radians({lat})) * cos(radians({lon})) as x, ({n} + {alt}) * cos(radians({lat})) * sin(radians({lon})) as y, ({n} * (1 - 0.0066943799901413165e0) + {alt}) * sin(radians({lat})) as z"


_BY, _BY_I = "partition by flight_id order by t, seq", "partition by flight_id order by i"
_METRICS = f"""f as ({FIXES}), o as (select flight_id, median(lat) as lat0, median(lon) as lon0, median(alt) as alt0 from f group by flight_id),
c as (select flight_id, seq, t, {_ecef("lat", "lon", "alt")} from f), c0 as (select flight_id, lat0, lon0, {_ecef("lat0", "lon0", "alt0")} from o),
tr as (select c.flight_id, seq, t, -sin(radians(lon0)) * (c.x - c0.x) + cos(radians(lon0)) * (c.y - c0.y) as e, -sin(radians(lat0)) * cos(radians(lon0)) * (c.x - c0.x) - sin(radians(lat0)) * sin(radians(lon0)) * (c.y - c0.y) + cos(radians(lat0)) * (c.z - c0.z) as n,
 cos(radians(lat0)) * cos(radians(lon0)) * (c.x - c0.x) + cos(radians(lat0)) * sin(radians(lon0)) * (c.y - c0.y) + sin(radians(lat0)) * (c.z - c0.z) as u from c join c0 on c.flight_id = c0.flight_id),
sd as (select flight_id, lead(e) over w - 2 * e + lag(e) over w as de, lead(n) over w - 2 * n + lag(n) over w as dn from tr window w as (partition by flight_id order by seq)),
sm as (select flight_id, median(de) as me, median(dn) as mn, count(*) as k from sd group by flight_id),
sg as (select sd.flight_id, case when any_value(k) < 5 then 0.0e0 else (median(abs(de - me)) + median(abs(dn - mn))) / 2 / (0.6745e0 * sqrt(6.0e0)) end as sigma from sd join sm on sd.flight_id = sm.flight_id group by sd.flight_id),
nb as (select *, lag(e, 2) over w as e1, lag(e) over w as e2, lead(e) over w as e3, lead(e, 2) over w as e4, lag(n, 2) over w as n1, lag(n) over w as n2, lead(n) over w as n3, lead(n, 2) over w as n4, lag(u, 2) over w as u1, lag(u) over w as u2, lead(u) over w as u3, lead(u, 2) over w as u4 from tr window w as (partition by flight_id order by seq)),
mk as (select nb.flight_id, seq, t, e, n, sigma, coalesce(sqrt(pow(e - list_median([e1, e2, e3, e4]), 2) + pow(n - list_median([n1, n2, n3, n4]), 2) + pow(u - list_median([u1, u2, u3, u4]), 2)) > greatest(15.0, 6.0 * sigma), false) and e1 is not null and e4 is not null as spike from nb join sg on nb.flight_id = sg.flight_id),
sz as (select flight_id, count(*) as points, sum(case when spike then 1 else 0 end) as outliers, max(t) - min(t) as duration, any_value(sigma) as sigma from mk group by flight_id),
cl as (select flight_id, t, e, n, sigma, row_number() over ({_BY}) - 1 as i from mk where not spike),
sj as (select a.flight_id, a.t, a.e, a.n, min(b.t) as t2 from cl a join cl b on a.flight_id = b.flight_id and b.t >= a.t + 1.0 group by all),
sp as (select sj.flight_id, avg(case when sqrt(pow(b.e - sj.e, 2) + pow(b.n - sj.n, 2)) > 30.0 * (t2 - sj.t) + 25.0 then 1.0e0 else 0.0e0 end) as discontinuous, max(sqrt(pow(b.e - sj.e, 2) + pow(b.n - sj.n, 2)) / (t2 - sj.t)) as max_speed from sj join cl b on b.flight_id = sj.flight_id and b.t = t2 group by sj.flight_id),
dt as (select *, t - lag(t) over ({_BY_I}) as dt from cl), en as (select flight_id, count(*) as m, median(dt) as dt, max(t) - min(t) as span, min_by(e, i) as ae, min_by(n, i) as an, max_by(e, i) as be, max_by(n, i) as bn, any_value(sigma) as s from dt group by flight_id),
st as (select flight_id, m, cast(case when m < 3 or s <= 0 or span <= 0 or dt <= 0 then 1 else greatest(1, least(round_even(6.0 * s / greatest(sqrt(pow(be - ae, 2) + pow(bn - an, 2)) / span * dt, 1e-9), 0), greatest(1, floor(m / 10)))) end as bigint) as stride from en),
pk as (select st.flight_id, m, stride, stride // 2 as half, unnest(list_distinct(list_append(range(0, m, stride), m - 1))) as i from st),
th as (select pk.flight_id, pk.i, case when any_value(pk.i = m - 1 and (m - 1) % stride <> 0) then max_by(cl.e, cl.i) filter (cl.i = m - 1) else avg(cl.e) end as e, case when any_value(pk.i = m - 1 and (m - 1) % stride <> 0) then max_by(cl.n, cl.i) filter (cl.i = m - 1) else avg(cl.n) end as n
 from pk join cl on cl.flight_id = pk.flight_id and cl.i between pk.i - half and pk.i + half group by pk.flight_id, pk.i),
ws as (select *, sqrt(pow(e - lag(e) over ({_BY_I}), 2) + pow(n - lag(n) over ({_BY_I}), 2)) as step from th), wk as (select *, sum(coalesce(step, 0)) over ({_BY_I}) as arc, row_number() over ({_BY_I}) - 1 as j from ws),
s1 as (select flight_id, count(*) as thin, sum(step) as path, median(step) as mstep, min_by(e, i) as ae, min_by(n, i) as an, max_by(e, i) - min_by(e, i) as de, max_by(n, i) - min_by(n, i) as dn, var_pop(e) as vee, var_pop(n) as vnn, covar_pop(e, n) as ven from wk group by flight_id),
s2 as (select *, sqrt(de * de + dn * dn) as displacement, atan2(2 * ven, vee - vnn) / 2 as angle, ((vee + vnn) / 2 + sqrt(pow((vee - vnn) / 2, 2) + ven * ven)) / greatest(vee + vnn, 1e-12) as straight, greatest(4.0, least(20.0, 0.02 * path)) as radius from s1),
s3 as (select *, cos(angle) * de + sin(angle) * dn as al from s2),
s4 as (select *, case when abs(al) < 1e-9 then case when cos(angle) < 0 or (cos(angle) = 0 and sin(angle) < 0) then -1.0e0 else 1.0e0 end when al < 0 then -1.0e0 else 1.0e0 end as flip, greatest(2 * radius, 0.05 * path) as away from s3),
sh as (select *, cos(angle) * flip as ax, sin(angle) * flip as ay from s4),
on1 as (select wk.flight_id, i, j, e, n, arc, radius, away, (e - ae) * ax + (n - an) * ay as along, abs((n - an) * ax - (e - ae) * ay) as side from wk join sh on wk.flight_id = sh.flight_id),
go as (select *, along - lag(along) over ({_BY_I}) as d from on1),
ax1 as (select flight_id, sum(greatest(d, 0)) as fw, sum(greatest(-d, 0)) as bw, quantile_cont(side, 0.9) as aside, max(along) - min(along) as reach from go group by flight_id),
rv as (select g.flight_id, j, along as ext, 0 as dir, 0 as turns, greatest(5.0, 0.1 * reach) as eps from on1 g join ax1 a on a.flight_id = g.flight_id where j = 0
 union all select g.flight_id, g.j, case when dir = 0 and abs(along - ext) >= eps then along when dir = 0 then ext when (along - ext) * dir > 0 then along when -(along - ext) * dir >= eps then along else ext end,
 case when dir = 0 and abs(along - ext) >= eps then case when along > ext then 1 else -1 end when dir = 0 then 0 when (along - ext) * dir > 0 then dir when -(along - ext) * dir >= eps then -dir else dir end,
 case when dir <> 0 and (along - ext) * dir <= 0 and -(along - ext) * dir >= eps then turns + 1 else turns end, eps from rv join on1 g on g.flight_id = rv.flight_id and g.j = rv.j + 1),
rt as (select flight_id, max_by(turns, j) as reversals from rv group by flight_id),
ht as (select a.flight_id, a.i, exists (select 1 from on1 b where b.flight_id = a.flight_id and b.arc <= a.arc - a.away and sqrt(pow(a.e - b.e, 2) + pow(a.n - b.n, 2)) <= a.radius) as hit from on1 a),
ri as (select *, hit and not coalesce(lag(hit) over ({_BY_I}), false) as rise from ht), bk as (select flight_id, avg(case when hit then 1.0e0 else 0.0e0 end) as score, sum(case when rise then 1 else 0 end) as loops from ri group by flight_id),
al as (select sz.flight_id, points, duration, outliers, sigma, coalesce(discontinuous, 0) as dc, max_speed, stride, thin, mstep, path, displacement, ax, ay, straight, aside, fw, bw, reversals, score, loops, points >= 8 and points - outliers >= 8 as judged from sz left join sp using (flight_id) left join st using (flight_id) left join sh using (flight_id) left join ax1 using (flight_id) left join rt using (flight_id) left join bk using (flight_id)),
me as (select flight_id, cast(points as bigint) as points, round(duration, 2) as duration_s, cast(outliers as bigint) as gps_outliers_removed, sigma, round(dc, 3) as discontinuous_step_fraction, round(max_speed, 2) as max_speed_mps, case when judged then stride end as thinning_stride, case when judged then cast(thin as bigint) end as thinned_points, case when judged then round(mstep, 2) end as median_track_step_m, case when judged then round(path, 2) end as path_length_m, case when judged then round(displacement, 2) end as displacement_m,
 case when judged then case when path > 0 then round(displacement / path, 3) else 0.0 end end as path_efficiency, judged and path >= 20 as long_, degrees(atan2(ax, ay)) as hd, straight, aside, fw, bw, reversals, score, loops from al),
m as (select flight_id, points, duration_s, gps_outliers_removed, sigma, discontinuous_step_fraction, max_speed_mps, thinning_stride, thinned_points, median_track_step_m, path_length_m, displacement_m, path_efficiency, case when long_ then round(hd - 360 * floor(hd / 360), 1) end as dominant_heading_deg, case when long_ then round(straight, 3) end as straightness, case when long_ then round(aside, 2) end as lateral_deviation_m,
 case when long_ then round(fw / greatest(fw + bw, 1e-9), 3) end as forward_fraction, case when long_ then cast(reversals as bigint) end as direction_reversals, case when long_ then round(score, 3) end as revisit_score, case when long_ then cast(loops as bigint) end as loop_closures from me)"""


def _fired(*pairs: tuple[str, str]) -> str:
    return "list_filter([" + ", ".join(f"case when {c} then '{name}' end" for c, name in pairs) + "], lambda x: x is not null)"


_VERDICT = f"""with recursive {_METRICS}, v as (select *, case when points < 8 then 'too_few_positions' when points - gps_outliers_removed < 8 then 'nearly_all_outliers' when path_length_m < 20 then 'too_short' when discontinuous_step_fraction > 0.15 then 'not_continuous' end as early,
{_fired(("path_efficiency < 0.15", "closed_loop"), ("revisit_score >= 0.6 and path_efficiency < 0.3", "re-covers_ground"), ("1 - forward_fraction >= 0.55", "repeated_passes"))} as hard,
{_fired(("path_efficiency < 0.55", "weak_progress"), ("1 - forward_fraction > 0.2", "goes_backwards"), ("revisit_score > 0.25", "comes_back"), ("direction_reversals > 2", "turn_backs"))} as soft,
{_fired(("path_length_m < 50", "short"), ("gps_outliers_removed >= greatest(3.0, 0.1 * points)", "spikes_removed"), ("points < 20", "few_positions"))} as weak, coalesce(sigma > 0 and median_track_step_m < 3.0 * sigma, false) as noisy from m),
s as (select *, case when early is not null or (len(hard) + len(soft) > 0 and noisy) then 'unknown' when len(hard) > 0 then 'invalid' when len(soft) > 0 then 'suspicious' when len(weak) > 0 then 'valid_with_warning' else 'valid' end as status,
 array_to_string(case when early is not null then [early] when len(hard) + len(soft) > 0 and noisy then ['jitter'] when len(hard) > 0 then hard when len(soft) > 0 then soft else weak end, ',') as reasons from v)
select * exclude (early, hard, soft, weak, noisy, sigma), round(sigma, 2) as sigma, case when status in ('valid', 'valid_with_warning') then true when status in ('suspicious', 'invalid') then false end as single_pass from s"""


@query(_VERDICT)
def flight_validation(s, d):
    return flight.verdicts(flight.metrics(fixes(s, d)))


@query(f"with f as ({FIXES}), g as (select *, lag(lat) over w as a, lag(lon) over w as b, lag(alt) over w as c, lag(seq) over w as p from f window w as (partition by flight_id order by seq)) select flight_id, seq, round(t, 6) as t from g where p is null or not (lat = a and lon = b and alt = c)")
def dedupe_fixes(s, d):
    return T.deduped(fixes(s, d)).select("flight_id", "seq", r6("t"))


@query(f"with f as ({FIXES}) select flight_id, count(*) as n, round(max(t) - min(t), 6) as duration_s, median(h_acc) as h_acc, count(alt) > 0 as has_alt from f group by flight_id")
def telemetry_summary(s, d):
    return fixes(s, d).groupBy("flight_id").agg(F.count("*").alias("n"), F.round(F.max("t") - F.min("t"), 6).alias("duration_s"), F.median("h_acc").alias("h_acc"), (F.count("alt") > 0).alias("has_alt"))


@query(f"""with f as ({FIXES}), x as (select flight_id, seq, radians(lat) as la, radians(lon) as lo, alt, 6378137.0 / sqrt(1 - 0.0066943799901413165 * sin(radians(lat)) * sin(radians(lat))) as nn from f)
select flight_id, seq, round((nn + alt) * cos(la) * cos(lo), 4) as x, round((nn + alt) * cos(la) * sin(lo), 4) as y, round((nn * (1 - 0.0066943799901413165) + alt) * sin(la), 4) as z from x""")
def geodetic_to_ecef(s, d):
    x, y, z = geodesy.ecef(F.col("lat"), F.col("lon"), F.col("alt"))
    return fixes(s, d).select("flight_id", "seq", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"), F.round(z, 4).alias("z"))


@query(f"with f as ({FIXES}) select flight_id, seq, round(lat, 7) as lat, round(lon, 7) as lon, round(alt, 4) as alt from f")
def ecef_round_trip(s, d):
    x, y, z = geodesy.ecef(F.col("lat"), F.col("lon"), F.col("alt"))
    there = fixes(s, d).select("flight_id", "seq", x.alias("x"), y.alias("y"), z.alias("z"))
    back = geodesy.with_geodetic(there, F.col("x"), F.col("y"), F.col("z"))
    return back.select("flight_id", "seq", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"), F.round("alt", 4).alias("alt"))


@query(f"with p as ({ENU}), q as (select *, e - lag(e) over w as de, n - lag(n) over w as dn from p window w as (partition by flight_id order by seq)) select flight_id, seq, round(sqrt(de * de + dn * dn), 6) as step, round(degrees(atan2(de, dn)) - 360 * floor(degrees(atan2(de, dn)) / 360), 4) as heading from q")
def steps_and_headings(s, d):
    w = Window.partitionBy("flight_id").orderBy("seq")
    p = T.steps(plane(s, d))
    return p.select("flight_id", "seq", r6("step"), F.round(geodesy.heading(F.col("e") - F.lag("e").over(w), F.col("n") - F.lag("n").over(w)), 4).alias("heading"))


@query(f"""with p as ({ENU}), q as (select *, e - lag(e) over w as de, n - lag(n) over w as dn from p window w as (partition by flight_id order by seq))
select flight_id, round(sum(sqrt(de * de + dn * dn)), 5) as path, round(sqrt(pow(max_by(e, seq) - min_by(e, seq), 2) + pow(max_by(n, seq) - min_by(n, seq), 2)), 5) as displacement, round(median(sqrt(de * de + dn * dn)), 5) as median_step from q group by flight_id""")
def path_summary(s, d):
    a, b = F.min_by(F.struct("e", "n"), "seq"), F.max_by(F.struct("e", "n"), "seq")
    g = T.steps(plane(s, d)).groupBy("flight_id").agg(F.sum("step").alias("path"), a.alias("a"), b.alias("b"), F.median("step").alias("m"))
    return g.select("flight_id", F.round("path", 5).alias("path"), F.round(F.hypot(F.col("b.e") - F.col("a.e"), F.col("b.n") - F.col("a.n")), 5).alias("displacement"), F.round("m", 5).alias("median_step"))


@query(f"""with p as ({ENU}), q as (select flight_id, lead(e) over w - 2 * e + lag(e) over w as de, lead(n) over w - 2 * n + lag(n) over w as dn from p window w as (partition by flight_id order by seq)),
m as (select flight_id, median(de) as me, median(dn) as mn, count(*) as k from q group by flight_id)
select q.flight_id, round(case when any_value(k) < 5 then 0.0 else (median(abs(de - me)) + median(abs(dn - mn))) / 2 / (0.6745 * sqrt(6.0)) end, 6) as sigma from q join m on q.flight_id = m.flight_id group by q.flight_id""")
def position_noise(s, d):
    return T.noise(plane(s, d)).select("flight_id", r6("sigma"))


@query(f"""with p as ({ENU}), q as (select *, lag(e, 2) over w as e1, lag(e) over w as e2, lead(e) over w as e3, lead(e, 2) over w as e4, lag(n, 2) over w as n1, lag(n) over w as n2, lead(n) over w as n3, lead(n, 2) over w as n4,
 lag(u, 2) over w as u1, lag(u) over w as u2, lead(u) over w as u3, lead(u, 2) over w as u4 from p window w as (partition by flight_id order by seq))
select flight_id, seq, coalesce(sqrt(pow(e - list_median([e1, e2, e3, e4]), 2) + pow(n - list_median([n1, n2, n3, n4]), 2) + pow(u - list_median([u1, u2, u3, u4]), 2)) > 8.0, false) and e1 is not null and e4 is not null as spike from q""")
def despike(s, d):
    return T.spikes(plane(s, d), F.lit(8.0)).select("flight_id", "seq", "spike")


@query(f"""with p as ({ENU}), j as (select a.flight_id, a.seq, a.t, a.e, a.n, min(b.t) as t2 from p a join p b on a.flight_id = b.flight_id and b.t >= a.t + 1.0 group by all),
k as (select j.*, b.e as e2, b.n as n2 from j join p b on j.flight_id = b.flight_id and j.t2 = b.t)
select flight_id, count(*) as steps_judged, round(max(sqrt(pow(e2 - e, 2) + pow(n2 - n, 2)) / (t2 - t)), 6) as max_speed, round(avg(case when sqrt(pow(e2 - e, 2) + pow(n2 - n, 2)) > 30.0 * (t2 - t) + 25.0 then 1.0 else 0.0 end), 6) as discontinuous from k group by flight_id""")
def window_speeds(s, d):
    return T.window_speeds(plane(s, d)).select("flight_id", "steps_judged", r6("max_speed"), r6("discontinuous"))


_Q = f"select flight_id, cast(seq as double) * 1.7e0 - 3.0e0 as q from ({FIXES}) x"


@query(f"""with f as ({FIXES}), q as (select flight_id, cast(q as double) as q from ({_Q}) y), b as (select q.flight_id, q.q, max_by(f.t, f.t) filter (f.t <= q.q) as bt, max_by(f.alt, f.t) filter (f.t <= q.q) as bv, min_by(f.t, f.t) filter (f.t >= q.q) as ft, min_by(f.alt, f.t) filter (f.t >= q.q) as fv
from q join f on q.flight_id = f.flight_id group by q.flight_id, q.q)
select flight_id, round(q, 6) as q, round(case when bt is null then fv when ft is null then bv when ft = bt then bv else bv + (fv - bv) * (q - bt) / (ft - bt) end, 6) as alt from b""")
def interpolation_join(s, d):
    q = fixes(s, d).select("flight_id", (F.col("seq") * 1.7 - 3.0).cast("double").alias("q"))
    return T.interpolated(q, fixes(s, d), "alt").select("flight_id", r6("q"), r6("alt"))


@query(f"""with f as ({FIXES}), q as (select flight_id, cast(q as double) as q from ({_Q}) y)
select flight_id, round(q, 6) as q, alt from (select q.flight_id, q.q, f.alt, row_number() over (partition by q.flight_id, q.q order by abs(f.t - q.q), f.t) as rn from q join f on q.flight_id = f.flight_id) z where rn = 1""")
def nearest_fix_join(s, d):
    q = fixes(s, d).select("flight_id", (F.col("seq") * 1.7 - 3.0).cast("double").alias("q"))
    return T.nearest_fix(q, fixes(s, d), "alt").select("flight_id", r6("q"), "alt")


@query(f"with f as ({FIXES}) select flight_id, seq, quantile_cont(alt, 0.5) over (partition by flight_id order by t range between 30.0 preceding and 30.0 following) as rolling from f")
def rolling_median(s, d):
    return T.rolling_median(fixes(s, d), "alt").select("flight_id", "seq", "rolling")


_SHOTS = f"select *, sum(case when frame = 0 then 0 when is_cut then 1 else 0 end) over (partition by shot_key order by frame) as shot from ({CANDS}) c"


def _kept(source: str, move: str) -> str:
    return f"""with k as ({source}), st as (select *, case when lag(frame) over w is null then 0.0 else greatest({move}, (t - lag(t) over w) / 2.0) end as step from k window w as (partition by shot_key, shot order by frame)),
b as (select *, floor(sum(step) over (partition by shot_key, shot order by frame) + 1e-9) as bin from st),
m as (select shot_key, shot, quantile_cont(sharpness, 0.5) as med from b group by shot_key, shot),
r as (select b.*, sharpness < 0.5 * med as blurry, row_number() over (partition by b.shot_key, b.shot, bin order by sharpness desc, frame) as rn from b join m on b.shot_key = m.shot_key and b.shot = m.shot),
f as (select *, last_value(case when not blurry then bin end ignore nulls) over (partition by shot_key, shot order by frame rows between unbounded preceding and 1 preceding) as last from r where rn = 1)
select shot_key, cast(shot as bigint) as shot, cast(bin as bigint) as bin, frame, round(t, 6) as t, sharpness, blurry, not blurry and coalesce(bin - last > 2, false) as gap_before from f"""


@query(_kept(_SHOTS, "case when shift is null then 1.0 else shift / 0.1 end"))
def select_keyframes(s, d):
    return T.keyframes(T.shots(cands(s, d))).withColumn("t", F.round("t", 6))


@query(f"""with c as ({CANDS}), k as (select *, sum(case when frame = 0 then 0 when is_cut then 1 else 0 end) over (partition by shot_key order by frame) as shot from c)
select shot_key, cast(shot as bigint) as shot, round(min(t), 6) as start_s, round(max(t), 6) as end_s, count(*) as frames from k group by shot_key, shot""")
def split_shots(s, d):
    return T.shots(cands(s, d)).groupBy("shot_key", "shot").agg(F.round(F.min("t"), 6).alias("start_s"), F.round(F.max("t"), 6).alias("end_s"), F.count("*").alias("frames"))


_SPANS = f"select flight_id, seq // 8 as shot, min(t) as start_s, max(t) as end_s, min_by(e, seq) as start_e, max_by(e, seq) as end_e, min_by(n, seq) as start_n, max_by(n, seq) as end_n from ({ENU}) p group by flight_id, seq // 8"


@query(f"""with s as ({_SPANS}), a as (select *, case when lag(shot) over w is null then 0 when start_s - lag(end_s) over w > 1.2 or sqrt(pow(start_e - lag(end_e) over w, 2) + pow(start_n - lag(end_n) over w, 2)) > 25.0 + 30.0 * greatest(start_s - lag(end_s) over w, 0) then 1 else 0 end as apart from s window w as (partition by flight_id order by shot))
select flight_id, cast(shot as bigint) as shot, cast(sum(apart) over (partition by flight_id order by shot) as bigint) as flight from a""")
def logical_flights(s, d):
    p = plane(s, d).withColumn("shot", F.expr("seq div 8"))
    spans = p.groupBy("flight_id", "shot").agg(F.min("t").alias("start_s"), F.max("t").alias("end_s"), *(f(c, "seq").alias(f"{k}_{c}") for k, f in (("start", F.min_by), ("end", F.max_by)) for c in "en"))
    return T.logical_flights(spans, 1.2).select("flight_id", "shot", "flight")


@query(f"""with p as ({ENU}), h as (select *, degrees(atan2(e - lag(e) over w, n - lag(n) over w)) as h from p window w as (partition by flight_id order by seq)),
b as (select flight_id, seq, case when abs((h - lag(h) over w + 180.0) - 360.0 * floor((h - lag(h) over w + 180.0) / 360.0) - 180.0) > 45.0 then 1 else 0 end as b from h window w as (partition by flight_id order by seq))
select flight_id, seq, cast(sum(b) over (partition by flight_id order by seq) as bigint) as strip from b""")
def photo_strips(s, d):
    return T.strips(plane(s, d)).select("flight_id", "seq", "strip")


@query(f"""with recursive p as ({ENU}), f as (select flight_id, seq, e as ext, 0 as dir, 0 as turns from p where seq = 0
union all select p.flight_id, p.seq, case when dir = 0 and abs(e - ext) >= 5.0 then e when dir = 0 then ext when (e - ext) * dir > 0 then e when -(e - ext) * dir >= 5.0 then e else ext end,
case when dir = 0 and abs(e - ext) >= 5.0 then case when e > ext then 1 else -1 end when dir = 0 then 0 when (e - ext) * dir > 0 then dir when -(e - ext) * dir >= 5.0 then -dir else dir end,
case when dir <> 0 and (e - ext) * dir <= 0 and -(e - ext) * dir >= 5.0 then turns + 1 else turns end from f join p on p.flight_id = f.flight_id and p.seq = f.seq + 1)
select flight_id, cast(max_by(turns, seq) as bigint) as reversals from f group by flight_id""")
def direction_reversals(s, d):
    g = plane(s, d).groupBy("flight_id").agg(F.array_sort(F.collect_list(F.struct("seq", "e"))).alias("p"))
    return g.select("flight_id", T.count_reversals(F.transform("p", lambda x: x["e"]), F.lit(5.0)).cast("long").alias("reversals"))


@query(f"""with p as ({ENU}), a as (select *, sum(coalesce(step, 0)) over (partition by flight_id order by seq) as arc from (select *, sqrt(pow(e - lag(e) over w, 2) + pow(n - lag(n) over w, 2)) as step from p window w as (partition by flight_id order by seq)) z),
h as (select a.flight_id, a.seq, exists (select 1 from a b where b.flight_id = a.flight_id and b.arc <= a.arc - 20.0 and sqrt(pow(a.e - b.e, 2) + pow(a.n - b.n, 2)) <= 4.0) as hit from a),
r as (select *, hit and not coalesce(lag(hit) over (partition by flight_id order by seq), false) as rise from h)
select flight_id, round(avg(case when hit then 1.0 else 0.0 end), 6) as revisit_score, cast(sum(case when rise then 1 else 0 end) as bigint) as loop_closures from r group by flight_id""")
def revisits(s, d):
    w = Window.partitionBy("flight_id").orderBy("seq")
    p = T.steps(plane(s, d)).withColumns({"arc": F.sum(F.coalesce("step", F.lit(0.0))).over(w), "radius": F.lit(4.0), "away": F.lit(20.0)})
    return T.revisits(p).select("flight_id", r6("revisit_score"), "loop_closures")


@query(f"""with f as ({FIXES}), k as (select *, case when seq % 4 = 0 then null else h_acc end as h from f)
select flight_id, seq, greatest(0.02, least(50.0, coalesce(h, 3.0))) as h_std, greatest(0.03, least(75.0, 1.5 * greatest(0.02, least(50.0, coalesce(h, 3.0))))) as v_std from k""")
def accuracy_defaults(s, d):
    h = F.when(F.col("seq") % 4 != 0, F.col("h_acc"))
    return fixes(s, d).select("flight_id", "seq", geodesy.horizontal_accuracy(h).alias("h_std"), geodesy.vertical_accuracy(F.lit(None).cast("double"), h).alias("v_std"))


@query(f"with p as ({POINTS}), m as (select *, min(z) over (partition by shot, floor(x / 10)) as near from p) select point_id, shot, x, z from m where z <= near * 1.02 + 0.5")
def z_buffer(s, d):
    p = cloud(s, d).withColumn("cell", F.floor(F.col("x") / 10))
    return P.visible(p, ["shot", "cell"], "z").select("point_id", "shot", "x", "z")


@query(f"""with p as (select shot as point_id, cls from ({POINTS}) q), n as (select point_id, cls, count(*) as k from p group by point_id, cls),
b as (select *, row_number() over (partition by point_id order by case when cls = 7 then 1 else 0 end, k desc, cls) as rn from n)
select point_id, cast(sum(k) as bigint) as views, max(case when rn = 1 and cls <> 7 and k >= 2 then cls end) as voted from b group by point_id""")
def majority_vote(s, d):
    return P.majority(cloud(s, d).select(F.col("shot").alias("point_id"), "cls"), 2, (7,))


@query(f"with p as ({POINTS}) select cls, count(*) as n, round(count(*) * 1.0 / (select count(*) from p), 6) as share from p group by cls")
def class_shares(s, d):
    return P.class_shares(cloud(s, d)).select("cls", "n", r6("share"))


@query(f"with p as ({POINTS}) select cast(floor(x / 2) as bigint) as vx, cast(floor(y / 2) as bigint) as vy, cast(floor(z / 2) as bigint) as vz, min(point_id) as point_id, count(*) as n from p group by 1, 2, 3")
def voxel_first(s, d):
    return P.first_of_voxel(cloud(s, d).select("point_id", "x", "y", "z"), 2.0).select("vx", "vy", "vz", "point_id", "n")


@query(f"""with p as ({POINTS}), a as (select distinct point_id, x, y, z from p where classification = 6), b as (select distinct x, y, z from p where classification = 2)
select a.point_id, a.x, round(a.y, 6) as y, round(a.z, 6) as z, round(min(case when sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) < 1.5 then sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) end), 6) as d
from (select *, unnest([floor(x / 2) - 1, floor(x / 2), floor(x / 2) + 1]) as gx from a) a left join b on floor(b.x / 2) = gx and abs(a.y - b.y) < 1.5 group by all""")
def nearest_within(s, d):
    p = cloud(s, d)
    return _nearest(p.where("classification = 6"), p.where("classification = 2"))


def _nearest(left, right):
    a = left.select("point_id", "x", "y", "z").distinct().withColumn("pid", F.struct("point_id", "x", "y", "z"))
    near = P.nearest_within(a.drop("point_id").withColumnRenamed("pid", "point_id"), right.select("x", "y", "z").distinct(), 1.5)
    return near.select("point_id.point_id", "point_id.x", F.round("point_id.y", 6).alias("y"), F.round("point_id.z", 6).alias("z"), r6("d"))


@query(f"with p as ({POINTS}) select classification, count(*) as n, round(quantile_cont(y, 0.5), 6) as median_m, round(quantile_cont(y, 0.9), 6) as p90_m, round(avg(case when y < 0.5 then 1.0 else 0.0 end), 6) as within_05, round(avg(case when y < 1.0 then 1.0 else 0.0 end), 6) as within_1 from p group by classification")
def distance_stats(s, d):
    return P.distance_stats(cloud(s, d), "y", "classification").select("classification", "n", *(r6(c) for c in ("median_m", "p90_m", "within_05", "within_1")))


@query(f"with p as ({POINTS}) select cast(floor(x / 1.0) as bigint) as ix, cast(floor(y / 1.0) as bigint) as iy, round(max(z), 6) as top, count(*) as n from p group by 1, 2")
def surface_model(s, d):
    return P.surface(cloud(s, d), 1.0).select("ix", "iy", r6("top"), "n")


_CELLS = f"select distinct cast(floor(x / 1.0) as bigint) as ix, cast(floor(y / 2.0) as bigint) as iy from ({POINTS}) p"
_NEXT = "(select unnest([-1, 0, 1]) as a) g, (select unnest([-1, 0, 1]) as b) h"


def _cells(s, d):
    return cloud(s, d).select(F.floor("x").alias("ix"), F.floor(F.col("y") / 2.0).alias("iy")).distinct()


@query(f"with c as ({_CELLS}), dil as (select distinct ix + a as ix, iy + b as iy from c, {_NEXT}) select ix + a as ix, iy + b as iy from dil, {_NEXT} group by 1, 2 having count(*) = 9")
def raster_close(s, d):
    return P.closed(_cells(s, d))


@query(f"with c as ({_CELLS}), er as (select ix + a as ix, iy + b as iy from c, {_NEXT} group by 1, 2 having count(*) = 9) select distinct ix + a as ix, iy + b as iy from er, {_NEXT}")
def raster_open(s, d):
    return P.opened(_cells(s, d))


@query(f"""with p as ({ENU}), x as (select flight_id, e - round(e) as de, n - round(n) as dn, u - round(u / 2) * 2 as du from p), y as (select *, avg(de) over (partition by flight_id) as me, avg(dn) over (partition by flight_id) as mn from x)
select flight_id, count(*) as n, round(quantile_cont(sqrt(de * de + dn * dn), 0.5), 5) as h_median, round(quantile_cont(sqrt(de * de + dn * dn), 0.9), 5) as h_p90, round(quantile_cont(abs(du), 0.5), 5) as v_median, round(quantile_cont(sqrt(pow(de - me, 2) + pow(dn - mn, 2)), 0.5), 5) as h_median_no_offset from y group by flight_id""")
def position_errors(s, d):
    p = plane(s, d).withColumns({"re": F.round("e"), "rn": F.round("n"), "ru": F.round(F.col("u") / 2) * 2})
    return P.position_errors(p, "flight_id").select("flight_id", "n", *(F.round(c, 5).alias(c) for c in ("h_median", "h_p90", "v_median", "h_median_no_offset")))


@query(f"""with f as ({FILES}), o as (select ino, min(target) as target, min(size) as size from f group by ino), u as (select target, cast(sum(size) as bigint) as unique_bytes from o group by target)
select f.target, count(*) as n_files, cast(sum(f.size) as bigint) as logical, coalesce(any_value(u.unique_bytes), 0) as unique_bytes, case when sum(f.size) < 1024 then printf('%d B', sum(f.size)::bigint) when sum(f.size) < 1048576 then printf('%.1f KB', sum(f.size) / 1024.0) else printf('%.1f MB', sum(f.size) / 1048576.0) end as human from f left join u on f.target = u.target group by f.target""")
def storage_usage(s, d):
    return P.storage(files(s, d)).withColumn("human", geodesy.human_size(F.col("logical")))


@query()
def gps_fusion(s, d):
    f = fixes(s, d)
    return fusion.fused(f, f.select("flight_id", (F.col("t") + 0.2).alias("q")))


_UNIT = f"select x / r as nx, y / r as ny, z / r as nz from (select x, y, z, sqrt(x * x + y * y + z * z) as r from ({POINTS}) p) q"


@query(f"""with n as ({_UNIT}), g as (select unnest(range(-60, 61, 2)) * 1e0 as deg)
select deg, cast(sum(case when abs(nz * cos(radians(deg)) + (0.6e0 * ny - 0.8e0 * nx) * sin(radians(deg))) < sin(radians(3e0)) then 1 else 0 end) as bigint) as votes from n, g group by deg""")
def roll_votes(s, d):
    r = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    n = cloud(s, d).select(*((F.col(c) / r).alias(f"n{c}") for c in "xyz"))
    return fits.roll_votes(n, (0.6, 0.8), [float(a) for a in range(-60, 61, 2)], 3.0)


@query(f"""with recursive c as ({_CELLS}), g(ix, iy, l) using key (ix, iy) as (select ix, iy, ix * 1000000 + iy as l from c
union select a.ix, a.iy, min(b.l) from recurring.g a join recurring.g b on abs(a.ix - b.ix) <= 1 and abs(a.iy - b.iy) <= 1 group by a.ix, a.iy, a.l having min(b.l) < a.l)
select ix, iy, cast(floor(l / 1000000) as bigint) as cx, cast(l % 1000000 as bigint) as cy from g""")
def raster_components(s, d):
    return fits.raster_components(_cells(s, d)).select("ix", "iy", F.col("component.ix").alias("cx"), F.col("component.iy").alias("cy"))


_RESIDUE = "abs(slope * x + intercept - y)"


def _line_rounds(source: str, key: str, rounds: int = 5) -> str:
    out = [f"d as ({source})", f"l1 as (select {key}, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept from d group by {key})"]
    for i in range(1, rounds):
        out.append(f"q{i} as (select d.{key}, slope, intercept, quantile_cont({_RESIDUE}, 0.8) as lim from d join l{i} on d.{key} = l{i}.{key} group by all)")
        out.append(f"l{i + 1} as (select d.{key}, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept from d join q{i} on d.{key} = q{i}.{key} where {_RESIDUE} <= lim group by d.{key})")
    return ", ".join(out)


@query(f"with {_line_rounds(f'select cls, x, y from ({POINTS}) p', 'cls')} select cls, round(slope, 6) as slope, round(intercept, 6) as intercept from l5")
def robust_lines(s, d):
    return fits.robust_line(cloud(s, d), "x", "y", "cls").select("cls", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(f"""with c as ({CANDS}), m as (select *, coalesce(quantile_cont(sharpness, 0.5) over (partition by shot_key order by frame rows between 5 preceding and 1 preceding), 0.0) as recent from c)
select shot_key, frame, sharpness, recent from m where sharpness > greatest(12.0, 2.0 * recent)""")
def cut_proposals(s, d):
    return T.cut_proposals(cands(s, d), "sharpness", 5, 2.0).select("shot_key", "frame", "sharpness", "recent")
