"""Queries on clouds, footprints and photos, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clouds
from ..streaming import live
from .catalog import ENU, POINTS, cloud, plane, query, r6

_PHOTOS = f"select p.*, cast(10 + (seq * 37) % 90 as double) as sharpness from ({ENU}) p"


@query(f"""with recursive p as ({_PHOTOS}), m as (select *, sharpness < 0.5 * median(sharpness) over (partition by flight_id) as blurry from p),
f as (select flight_id, seq, case when blurry then 'blurry' else 'kept' end as verdict, case when not blurry then e end as le, case when not blurry then n end as ln, case when not blurry then u end as lu from m where seq = 0
 union all select m.flight_id, m.seq, case when m.blurry then 'blurry' when sqrt(pow(e - le, 2) + pow(n - ln, 2) + pow(u - lu, 2)) < 8 then 'close' else 'kept' end,
 case when m.blurry or sqrt(pow(e - le, 2) + pow(n - ln, 2) + pow(u - lu, 2)) < 8 then le else e end, case when m.blurry or sqrt(pow(e - le, 2) + pow(n - ln, 2) + pow(u - lu, 2)) < 8 then ln else n end,
 case when m.blurry or sqrt(pow(e - le, 2) + pow(n - ln, 2) + pow(u - lu, 2)) < 8 then lu else u end from f join m on m.flight_id = f.flight_id and m.seq = f.seq + 1)
select flight_id, seq, verdict from f""")
def spaced_photos(s, d):
    return clouds.spaced_photos(plane(s, d).withColumn("sharpness", (10 + (F.col("seq") * 37) % 90).cast("double")), 8.0)


@query(f"""with p as ({ENU}), q as (select *, coalesce(lead(e) over w, first(e) over w) as e2, coalesce(lead(n) over w, first(n) over w) as n2, count(*) over (partition by flight_id) as k from p window w as (partition by flight_id order by seq))
select flight_id, case when any_value(k) >= 3 then round(abs(sum(e * n2 - e2 * n)) / 2, 4) end as area from q group by flight_id""")
def footprint_area(s, d):
    ring = F.transform(F.array_sort(F.collect_list(F.struct("seq", "e", "n"))), lambda p: F.struct(p["e"].alias("x"), p["n"].alias("y")))
    return plane(s, d).groupBy("flight_id").agg(ring.alias("ring")).select("flight_id", F.round(clouds.polygon_area(F.col("ring")), 4).alias("area"))


@query(f"""with q as (select *, row_number() over (partition by flight_id order by seq) - 1 as i, count(*) over (partition by flight_id) as k from ({ENU}) p)
select flight_id, seq from q where k <= 10 or exists (select 1 from range(0, 10) r(j) where cast(round_even(j * (k - 1) / 9e0, 0) as bigint) = i)""")
def even_samples(s, d):
    return clouds.evenly(plane(s, d), 10, "flight_id", "seq").select("flight_id", "seq")


@query(f"select point_id, x, round(y, 6) as y, z from ({POINTS}) p order by md5(concat(cast(point_id as varchar), ':7')), point_id limit 500")
def hash_sample(s, d):
    return clouds.hash_sample(cloud(s, d), "point_id", 500, 7).select("point_id", "x", r6("y"), "z")


@query(f"""select point_id, round(case when shot % 5 = 0 then 0.25 else 1 - least(cls, 6) / 6.0 end, 6) as r, round(case when shot % 5 = 0 then 0.55 else 0.25 + 0.75 * least(cls, 6) / 6.0 end, 6) as g, cast(case when shot % 5 = 0 then 1.0 else 0.2 end as double) as b from ({POINTS}) p""")
def confidence_colours(s, d):
    c = cloud(s, d).withColumn("c", clouds.confidence_colour(F.col("cls"), F.col("shot") % 5 == 0))
    return c.select("point_id", r6("c.r", "r"), r6("c.g", "g"), F.col("c.b").alias("b"))


_SQUARES = f"select point_id, floor(x) + 0.25e0 as x0, floor(y / 4) * 4 + 0.5e0 as y0, z + 1.5e0 as w, z from ({POINTS}) p"


@query(f"""with q as ({_SQUARES}), c as (select *, unnest(range(cast(floor(x0) as bigint), cast(floor(x0 + w) as bigint) + 1)) as ix from q), b as (select *, unnest(range(cast(floor(y0) as bigint), cast(floor(y0 + w) as bigint) + 1)) as iy from c)
select ix, iy, max(z) as top from b where ix + 0.5 >= x0 and ix + 0.5 < x0 + w and iy + 0.5 >= y0 and iy + 0.5 < y0 + w group by ix, iy""")
def filled_polygons(s, d):
    x, y, w = F.floor("x") + 0.25, F.floor(F.col("y") / 4) * 4 + 0.5, F.col("z") + 1.5
    corner = lambda a, b: F.struct((x + a * w).alias("x"), (y + b * w).alias("y"))
    ring = F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))
    return clouds.filled_polygons(cloud(s, d).select(ring.alias("ring"), "z"), 1.0)


@query()
def surface_normals(s, d):
    return clouds.normals(cloud(s, d), 8, 1.0).select("point_id", F.round("flatness", 6).alias("flatness"))


@query()
def footprint_matches(s, d):
    c = cloud(s, d).select(F.col("shot").alias("a"), F.floor("x").alias("b"))
    n = c.groupBy("a", "b").agg(F.count("*").alias("n"))
    sides = n.join(n.groupBy("a").agg(F.sum("n").alias("na")), "a").join(n.groupBy("b").agg(F.sum("n").alias("nb")), "b")
    return clouds.greedy_matches(sides.select("a", "b", (F.col("n") / (F.col("na") + F.col("nb") - F.col("n"))).alias("score")))


@query(f"""with p as ({POINTS}), m as (select x, y, z from p where classification = 6), o as (select min_by(point_id, point_id) as point_id, min_by(x, point_id) as x, min_by(y, point_id) as y, min_by(z, point_id) as z from p where classification = 2 group by floor(x / 0.15), floor(y / 0.15), floor(z / 0.15)),
n as (select o.point_id, min(sqrt(pow(o.x - m.x, 2) + pow(o.y - m.y, 2) + pow(o.z - m.z, 2))) as d from (select *, unnest([floor(x / 2) - 1, floor(x / 2), floor(x / 2) + 1]) as gx from o) o join (select distinct * from m) m on floor(m.x / 2) = gx and abs(o.y - m.y) < 1.5 group by o.point_id, o.x, o.y, o.z)
select point_id, round(d, 6) as d from n where d < 1.5 and d > 0.15 order by n.d, point_id limit (select cast(floor(0.15e0 * count(*)) as bigint) from m)""")
def gap_fill(s, d):
    c = cloud(s, d)
    return clouds.gap_filled(c.where("classification = 6"), c.where("classification = 2")).select("point_id", r6("d"))


def _events(s, d):
    return s.read.parquet(f"{d}/events.parquet").select(F.col("user_id").alias("flight_id"), F.col("ts").cast("timestamp").alias("ts"), "value")


@query("""with a as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval 30 minute then 0 else 1 end as n from events), b as (select *, sum(n) over (partition by user_id order by ts rows unbounded preceding) as g from a)
select user_id as flight_id, cast(round(epoch(min(ts))) as bigint) as start_s, cast(round(epoch(max(ts))) as bigint) as last_s, count(*) as fixes from b group by user_id, g""")
def live_flights(s, d):
    seconds = lambda c: F.round(F.unix_micros(c) / 1e6).cast("long").alias(f"{c}_s")
    return live.flights(_events(s, d), "30 minutes").select("flight_id", seconds("start"), seconds("last"), "fixes")


@query("""select user_id as flight_id, cast(floor(epoch(ts) / 3600) * 3600 as bigint) as start_s, count(*) as fixes, min(value) as low, max(value) as high, count(*) filter (value is null) as missing from events group by 1, 2""")
def live_health(s, d):
    h = live.health(_events(s, d), "value", "1 hour")
    return h.select("flight_id", F.unix_seconds("start").alias("start_s"), "fixes", "low", "high", "missing")
