"""Queries on cameras, votes of label pictures and gap candidates, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cameras as C
from .catalog import POINTS, _bound, _line_rounds, cloud, query, r6

# One shot for each nation, every second one with the larger camera model.
SHOTS = """select n_nationkey as shot, 0.013 * n_nationkey as rx, -0.02 * n_nationkey + 0.1 as ry, 0.03 * n_nationkey as rz, n_nationkey - 35.0 as tx, -40.0 - n_nationkey as ty, 30.0 + n_nationkey as tz,
       case when n_nationkey % 2 = 0 then 'brown' else 'perspective' end as kind, 400 as width, 300 as height, 0.85 as focal, 0.84 as focal_x, 0.86 as focal_y, 0.01 as c_x, -0.02 as c_y, -0.02 as k1, 0.01 as k2, 0.001 as k3, 0.0005 as p1, -0.0003 as p2 from nation"""
_D = ("rx", "ry", "rz", "tx", "ty", "tz", "focal", "focal_x", "focal_y", "c_x", "c_y", "k1", "k2", "k3", "p1", "p2")
SHOTS = f"select shot, kind, width, height, {', '.join(f'cast({c} as double) as {c}' for c in _D)} from ({SHOTS}) s"
_ANGLE = f"""select *, cos(a) as co, sin(a) as si, 1 - cos(a) as k, case when a > 0 then rx / a else 0 end as ax, case when a > 0 then ry / a else 0 end as ay, case when a > 0 then rz / a else 0 end as az from (select *, sqrt(rx * rx + ry * ry + rz * rz) as a from ({SHOTS}) s0) s1"""
_POSE = f"""select *, co + ax * ax * k as r00, ax * ay * k - az * si as r01, ax * az * k + ay * si as r02, ay * ax * k + az * si as r10, co + ay * ay * k as r11, ay * az * k - ax * si as r12, az * ax * k - ay * si as r20, az * ay * k + ax * si as r21, co + az * az * k as r22 from ({_ANGLE}) s2"""
_SEEN = f"""select *, case when kind = 'brown' then (focal_x * (nx * full_ + 2 * p1 * nx * ny + p2 * (r2 + 2 * nx * nx)) + c_x) * 400 else focal * nx * bend * 400 end - 0.5 + 200 as u, case when kind = 'brown' then (focal_y * (ny * full_ + p1 * (r2 + 2 * ny * ny) + 2 * p2 * nx * ny) + c_y) * 400 else focal * ny * bend * 400 end - 0.5 + 150 as v
from (select *, 1 + k1 * r2 + k2 * r2 * r2 as bend, 1 + k1 * r2 + k2 * r2 * r2 + k3 * r2 * r2 * r2 as full_ from (select *, nx * nx + ny * ny as r2 from (select *, px / depth as nx, py / depth as ny
from (select point_id, s.*, r00 * p.x + r01 * p.y + r02 * p.z + tx as px, r10 * p.x + r11 * p.y + r12 * p.z + ty as py, r20 * p.x + r21 * p.y + r22 * p.z + tz as depth from ({POINTS}) p, ({_POSE}) s) d0 where depth > 0.5) d1) d2) d3"""
_IN = f"select * from ({_SEEN}) d4 where u >= 0 and u < 400 and v >= 0 and v < 300"
_SHOWN = f"select * from (select *, min(depth) over (partition by shot, floor(v * 0.25), floor(u * 0.25)) as nearest from ({_IN}) d5) d6 where depth <= nearest * 1.01 + 0.3"
_ROWS, _COLS = 75, 100
LABELS = f"select shot, r as row, c as col, (r * 7 + c * 3 + shot) % 11 as cls from (select n_nationkey as shot from nation where n_name <> 'FRANCE') n, (select unnest(range(0, {_ROWS})) as r) a, (select unnest(range(0, {_COLS})) as c) b"
_VOTES = f"select d.point_id, l.cls from ({_SHOWN}) d join ({LABELS}) l on l.shot = d.shot and l.row = least(floor(v * {_ROWS} / 300), {_ROWS - 1}) and l.col = least(floor(u * {_COLS} / 400), {_COLS - 1})"
_WON = f"""select point_id, views, case when k >= 2 then cls end as cls from (select *, row_number() over (partition by point_id order by case when cls in (0, 10) then 1 else 0 end, k desc, cls) as rn, sum(k) over (partition by point_id) as views from (select point_id, cls, count(*) as k from ({_VOTES}) v group by all) n) w where rn = 1"""
_WON = f"select point_id, views, case when cls in (0, 10) then null else cls end as cls from ({_WON}) w0"
_CODES = "[" + ", ".join(str(c[1]) for c in C.CLASSES) + "]"
_CLASSIFIED = f"select p.point_id, coalesce(w.views, 0) as views, w.cls, coalesce({_CODES}[w.cls + 1], p.classification) as classification from ({POINTS}) p left join ({_WON}) w on w.point_id = p.point_id"


def shots(s, d):
    return _bound(s, d, SHOTS, ("nation",))


def labels(s, d):
    n = s.read.parquet(f"{d}/nation.parquet").where("n_name <> 'FRANCE'").select(F.col("n_nationkey").alias("shot"))
    grid = n.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(_ROWS - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(_COLS - 1))))
    return grid.select("shot", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), ((F.col("row") * 7 + F.col("col") * 3 + F.col("shot")) % 11).cast("int").alias("cls"))


def _labelled(s, d):
    return C.labelled(C.unhidden(C.in_view(cloud(s, d), shots(s, d))), labels(s, d), _ROWS, _COLS)


@query(f"with s as ({_POSE}) select shot, round(-(r00 * tx + r10 * ty + r20 * tz), 6) as cx, round(-(r01 * tx + r11 * ty + r21 * tz), 6) as cy, round(-(r02 * tx + r12 * ty + r22 * tz), 6) as cz, round(r00, 6) as r00, round(r12, 6) as r12, round(r20, 6) as r20 from s")
def camera_centres(s, d):
    return C.with_pose(shots(s, d)).select("shot", *(r6(c) for c in ("cx", "cy", "cz", "r00", "r12", "r20")))


@query(f"select point_id, shot, round(u, 3) as u, round(v, 3) as v, round(depth, 3) as depth from ({_IN}) d")
def points_in_view(s, d):
    return C.in_view(cloud(s, d), shots(s, d)).select("point_id", "shot", *(F.round(c, 3).alias(c) for c in ("u", "v", "depth")))


@query(f"select shot, count(*) as n, round(avg(depth), 6) as depth from ({_SHOWN}) d group by shot")
def points_unhidden(s, d):
    return C.unhidden(C.in_view(cloud(s, d), shots(s, d))).groupBy("shot").agg(F.count("*").alias("n"), F.round(F.avg("depth"), 6).alias("depth"))


@query(f"select point_id, cls, count(*) as n from ({_VOTES}) v group by all")
def label_votes(s, d):
    return _labelled(s, d).groupBy("point_id", "cls").agg(F.count("*").alias("n"))


@query(f"select point_id, cast(views as bigint) as views, cls, classification from ({_CLASSIFIED}) c")
def classified_points(s, d):
    return C.classified(cloud(s, d), _labelled(s, d)).select("point_id", "views", "cls", "classification")


@query(f"select count(*) as points, round(avg(case when cls is not null then 1.0 else 0.0 end), 3) as labelled_share, cast(floor(median(views)) as bigint) as median_views, round(avg(case when views >= 2 then 1.0 else 0.0 end), 3) as seen_twice from ({_CLASSIFIED}) c")
def classification_summary(s, d):
    return C.classification_summary(C.classified(cloud(s, d), _labelled(s, d)))


_NAMED = "[" + ", ".join(f"'{c[0]}'" for c in C.CLASSES) + "]"


@query(f"with n as (select cls, count(*) as n from ({LABELS}) l group by cls) select cls, {_NAMED}[cls + 1] as name, round(n / (select sum(n) from n), 3) as share from n where n / (select sum(n) from n) > 0.001")
def pixel_shares(s, d):
    return C.pixel_shares(labels(s, d))



@query(f"with n as (select classification as code, count(*) as n from ({POINTS}) p group by 1) select code, case code when 2 then 'ground' when 6 then 'building' else 'high vegetation' end as name, case code when 2 then 160 when 6 then 220 else 40 end as red, n, round(n / (select sum(n) from n), 6) as share from n")
def class_legend(s, d):
    return C.legend(cloud(s, d)).select("code", "name", F.col("colour")[0].alias("red"), "n", r6("share"))


_WORDS = " ".join(f"when lower(trim(label)) in ({', '.join(repr(x) for x in c[3])}) then {k}" for k, c in enumerate(C.CLASSES) if c[3])
_LABEL = "case event_type when 'click' then ' Tree' when 'view' then 'swimming pool' when 'error' then 'CAR ' when 'purchase' then 'nothing' else event_type end"


@query(f"select event_id, case {_WORDS} else 0 end as cls from (select event_id, {_LABEL} as label from events) e")
def label_classes(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select("event_id", F.expr(_LABEL).alias("label"))
    return e.select("event_id", C.class_of(F.col("label")).alias("cls"))


@query(f"select label, count(*) as n from (select {_LABEL} as label from events) e where label in ('CAR ', 'nothing') group by label")
def moving_objects(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select(F.expr(_LABEL).alias("label"))
    return C.detections(e, ["CAR ", "nothing"])


_MASKS = "select 'm' || cast(user_id as varchar) as name, avg(value) / 100.0 as share from events group by user_id"


@query(f"with m as ({_MASKS}) select count(*) as frames, count(*) filter (share <= 0.5) as written, round(coalesce(avg(share) filter (share <= 0.5), 0), 3) as mean_share, array_to_string(list_sort(list(name) filter (share > 0.5)), ',') as left_out from m")
def mask_summary(s, d):
    m = s.read.parquet(f"{d}/events.parquet").groupBy(F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("name")).agg((F.avg("value") / 100.0).alias("share"))
    return C.mask_summary(m, 0.5).withColumn("left_out", F.array_join("left_out", ","))


_LIGHT = "select user_id as name, avg(value) as mean, stddev_pop(value) as std from events group by user_id"


def _light(s, d):
    return s.read.parquet(f"{d}/events.parquet").groupBy(F.col("user_id").alias("name")).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


@query(f"with l as ({_LIGHT}), g as (select median(mean) as m, median(std) as s from l) select name, round(1 + 0.7 * (g.s / greatest(std, 0.001) - 1), 6) as gain, round(0.7 * (g.m - mean), 6) as shift from l, g")
def exposure_targets(s, d):
    return C.exposure(_light(s, d)).select("name", r6("gain"), r6("shift"))


@query(f"with l as ({_LIGHT}) select round(median(mean), 1) as target, round(min(mean), 1) as low, round(max(mean), 1) as high from l")
def exposure_summary(s, d):
    return C.exposure_summary(_light(s, d))


_CAMERAS = "select s_suppkey as camera, 900.0 + s_suppkey as fx, 910.0 + s_suppkey as fy, 480.0 as px, 270.0 as py, case when s_suppkey % 3 = 0 then null else 960 end as size_w, case when s_suppkey % 3 = 0 then null else 540 end as size_h, 1920 as frame_w, 1080 as frame_h, s_suppkey % 7 as x0, 60 as y0, 1920 - s_suppkey % 5 as x1, 1020 as y1 from supplier"


@query(f"with c as (select *, case when size_w is null then 1.0e0 else frame_w / size_w end as sx, case when size_h is null then 1.0e0 else frame_h / size_h end as sy from ({_CAMERAS}) x) select camera, round(cast(fx * sx as double), 6) as fx, round(cast(fy * sy as double), 6) as fy, round(cast(px * sx - x0 as double), 6) as px, round(cast(py * sy - y0 as double), 6) as py, x1 - x0 as width, y1 - y0 as height, round(36.0e0 * fx * sx / (x1 - x0), 6) as focal35 from c")
def camera_intrinsics(s, d):
    c = C.intrinsics(_bound(s, d, _CAMERAS, ("supplier",)))
    return c.select("camera", *(F.round(F.col(x).cast("double"), 6).alias(x) for x in ("fx", "fy", "px", "py")), "width", "height", F.round(F.col("focal35").cast("double"), 6).alias("focal35"))


_PROFILE = "select user_id, row_number() over (partition by user_id order by event_id) - 1 as i, value, count(*) over (partition by user_id) as k from events"
_PROFILE = f"select user_id, i, case when i < user_id % 9 or i >= k - user_id % 5 then 5.0 else value end as value from ({_PROFILE}) p0"


@query(f"with g as (select user_id, count(*) as n, min(i) filter (value > 20) as a, max(i) filter (value > 20) + 1 as b from ({_PROFILE}) p group by user_id), h as (select *, a is null or (a < 0.02 * n and n - b < 0.02 * n) as whole from g) select user_id, cast(case when whole then 0 else least(a + 2, n) end as bigint) as first, cast(case when whole then n else greatest(b - 2, 0) end as bigint) as end_ from h")
def letterbox_spans(s, d):
    return C.lit_span(_bound(s, d, _PROFILE, ("events",)), "user_id").withColumnRenamed("end", "end_")


# Gap candidates: nearest depths on a grid of 4 pixels, guesses that are nearly a line of 1 / depth.
_NEAR = f"select shot, cast(floor(u / 4) as bigint) as col, cast(floor(v / 4) as bigint) as row, min(depth) as depth from ({_IN.replace('depth > 0.5', 'depth > 0.3')}) d group by all"
_GUESS = f"select shot, col, row, 0.9e0 - 6.0e0 / (40 + (row * 7 + col * 3 + shot * 5) % 61) as guess from ({LABELS}) l"


def _near(s, d):
    seen = C.in_view(cloud(s, d), shots(s, d), 0.3)
    return seen.groupBy("shot", F.floor(F.col("u") / 4).alias("col"), F.floor(F.col("v") / 4).alias("row")).agg(F.min("depth").alias("depth"))


def _guesses(s, d):
    return labels(s, d).select("shot", "col", "row", (0.9 - 6.0 / (40 + (F.col("row") * 7 + F.col("col") * 3 + F.col("shot") * 5) % 61)).alias("guess"))


_GAPS = f"""with n as ({_NEAR}), h as (select shot, col, row from ({LABELS}) l where cls in (1, 2, 3, 4, 6) and col % 2 = 0 and row % 2 = 0)
select h.shot, h.col, h.row from h where not exists (select 1 from n where n.shot = h.shot and n.col between h.col - 2 and h.col + 2 and n.row between h.row - 2 and h.row + 2)"""


@query(_GAPS)
def gap_cells(s, d):
    return C.gap_cells(labels(s, d), _near(s, d), 2)


@query(f"""with g as ({_GAPS}), c as (select shot, col, row, cast(10 + (col * 7 + row) % 50 as double) as depth from g), s as ({_POSE}),
q as (select c.*, s.*, (((c.col + 0.5) * 4 + 0.5 - 200) / 400 - c_x) / focal_x * depth - tx as q0, (((c.row + 0.5) * 4 + 0.5 - 150) / 400 - c_y) / focal_y * depth - ty as q1, depth - tz as q2 from c join s on s.shot = c.shot)
select shot, col, row, round(q0 * r00 + q1 * r10 + q2 * r20, 5) as x, round(q0 * r01 + q1 * r11 + q2 * r21, 5) as y, round(q0 * r02 + q1 * r12 + q2 * r22, 5) as z from q""".replace("c.*, s.*", "c.shot, c.col, c.row, r00, r01, r02, r10, r11, r12, r20, r21, r22"))
def back_projection(s, d):
    cells = C.gap_cells(labels(s, d), _near(s, d), 2).withColumn("depth", (10 + (F.col("col") * 7 + F.col("row")) % 50).cast("double"))
    return C.back_projected(cells, shots(s, d), 4).select("shot", "col", "row", *(F.round(c, 5).alias(c) for c in "xyz"))


_BOTH = "select n.shot, g.guess as x, 1 / n.depth as y, n.depth from n join g on g.shot = n.shot and g.col = n.col and g.row = n.row join many on many.shot = n.shot"


@query(f"""with n as ({_NEAR}), g as ({_GUESS}), many as (select shot, quantile_cont(depth, 0.02) as low, quantile_cont(depth, 0.98) as high from n group by shot having count(*) >= 50), {_line_rounds(_BOTH, "shot")},
off as (select d.shot, median(abs(1 / (slope * x + intercept) - depth) / depth) as error from d join l5 on l5.shot = d.shot where 1 / (slope * x + intercept) > 0 group by d.shot)
select many.shot, round(slope, 6) as slope, round(intercept, 6) as intercept, round(coalesce(error, 1), 6) as error, round(low, 6) as low, round(high, 6) as high, coalesce(error, 1) <= 0.5 as used from many left join l5 on l5.shot = many.shot left join off on off.shot = many.shot""")
def depth_fits(s, d):
    return C.depth_fits(_near(s, d), _guesses(s, d), 50, 0.5).select("shot", *(r6(c) for c in ("slope", "intercept", "error", "low", "high")), "used")


