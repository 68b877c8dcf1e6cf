"""Queries on text formats, map projections and lists of models and photos, with the SQL that gives the same rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..operators import cameras as C
from ..sources import outputs, telemetry
from .catalog import FIXES, POINTS, _bound, cloud, fixes, query, r6
from .scenes import LABELS, labels

_SRT = f"""select flight_id as file, seq, concat('{{n}}', cast(seq as varchar(20)), chr(10), lpad(cast(seq // 60 as varchar(20)), 2, '0'), ':', lpad(cast(seq % 60 as varchar(20)), 2, '0'), ':07,', cast(seq % 10 as varchar(20)), '50 --> x', chr(10), case seq % 3 when 0 then concat('[latitude: ', cast(seq + 1 as varchar(20)), '.5] [longitude: -81.25] [rel_alt: 3.5 abs_alt: 300.25]') when 1 then concat('GPS(-81.25,', cast(seq as varchar(20)), '.125,9) BAROMETER:12.5') else 'no place' end) as block from ({FIXES}) f"""


@query(f"select flight_id as file, seq, cast((seq // 60) * 3600 + (seq % 60) * 60 + 7 as double) + (seq % 10) / 10e0 + 0.05e0 as t, case seq % 3 when 0 then seq + 1.5e0 else seq + 0.125e0 end as lat, -81.25e0 as lon, case seq % 3 when 0 then 300.25e0 else 12.5e0 end as alt from ({FIXES}) f where seq % 3 < 2".replace("+ (seq % 10) / 10e0 + 0.05e0 as t", "+ (seq % 10) / 10e0 + 0.05e0 as t0").replace("cast((seq // 60)", "round(cast((seq // 60)").replace("0.05e0 as t0", "0.05e0, 3) as t"))
def subtitle_fixes(s, d):
    blocks = fixes(s, d).select(F.col("flight_id").alias("file"), "seq", F.expr(_SRT.split("seq, ", 1)[1].rsplit(" as block", 1)[0].replace("seq // 60", "seq div 60").replace("{n}", "")).alias("block"))
    return telemetry.subtitle_rows(blocks, gps_order="lon_lat").withColumn("t", F.round("t", 3))  # these numbers go past 90 in either place


_SRT = _SRT.replace("{n}", "")


@query(f"""with f as (select flight_id, seq, cast(round(t * 1000) as bigint) as ms, cast(round(coalesce(lead(t) over (partition by flight_id order by seq), t + 0.5) * 1000) as bigint) as ms2, lat, lon, alt from ({FIXES}) x)
select flight_id, seq, concat(cast(seq + 1 as varchar), chr(10), printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000), ' --> ', printf('%02d:%02d:%02d,%03d', ms2 // 3600000, ms2 // 60000 % 60, ms2 // 1000 % 60, ms2 % 1000), chr(10), printf('[latitude: %.7f] [longitude: %.7f] [rel_alt: 0.000 abs_alt: %.3f]', lat, lon, alt)) as block from f""")
def subtitle_blocks(s, d):
    return telemetry.subtitle_blocks(fixes(s, d))


_LOG = f"select cast(seq * 250 as varchar(20)) as \"Time ms\", case when seq % 11 = 3 then 'bad' else cast(40 + seq as varchar(20)) end as \"Latitude\", case when seq % 13 = 5 then '0' else '8.5' end as \"lng\", case when seq % 4 = 0 then '' else '410.5' end as \"height\" from ({FIXES}) f"


@query(f"""with r as ({_LOG}), k as (select try_cast("Time ms" as double) * 0.001 as t, try_cast("Latitude" as double) as lat, try_cast("lng" as double) as lon, coalesce(try_cast("height" as double), 0) as alt from r), v as (select * from k where lat is not null)
select round(t - (select min(t) from v), 6) as t, lat, lon, alt from v""")
def flight_log_rows(s, d):
    raw = _bound(s, d, _LOG.replace('"', "`"), ("events",))
    return telemetry.log_rows(raw).select(r6("t"), "lat", "lon", "alt")


@query(f"select flight_id, seq, printf('%s %.9f %.9f %.3f nan nan nan %.3f %.3f', concat('f', cast(seq as varchar), '.jpg'), lon, lat, alt, greatest(h_acc / 50, 0.05), greatest(h_acc / 20, 0.05)) as line, printf('%s %.8f %.8f %.3f', concat('f', cast(seq as varchar), '.jpg'), lat, lon, alt) as prior from ({FIXES}) f")
def position_lines(s, d):
    f = fixes(s, d).withColumns({"name": F.concat(F.lit("f"), F.col("seq").cast("string"), F.lit(".jpg")), "h_std": F.col("h_acc") / 50, "v_std": F.col("h_acc") / 20})
    key = F.col("seq") * 100000 + F.col("flight_id")
    g = telemetry.geo_lines(f.withColumn("name", F.concat(key.cast("string"), F.lit("|"), "name"))).select(F.substring_index("name", "|", 1).cast("long").alias("k"), F.expr("substr(line, instr(line, '|') + 1)").alias("line"))
    p = outputs.prior_lines(f.withColumn("seq", key)).select(F.col("n").alias("k"), "prior")
    return g.join(p, "k").select((F.col("k") % 100000).alias("flight_id"), F.expr("k div 100000").alias("seq"), "line", "prior")


_TABLE = f"select cast(seq * 10 as varchar(20)) as imgid, cast(alt as varchar(20)) as lat, cast(h_acc as varchar(20)) as lon, case when seq % 2 = 0 then '' else '7.5' end as alt from ({FIXES}) f where flight_id = (select min(user_id) from events)"


@query(f"with t as ({_TABLE}), p as (select n_nationkey * 15 as k from nation) select concat(cast(p.k as varchar), '.jpg') as name, cast(t.lat as double) as lat, cast(t.lon as double) as lon, case when t.lat is null then null when t.alt = '' then 0.0 else 7.5 end as alt from p left join t on cast(t.imgid as bigint) = p.k")
def photo_positions_by_id(s, d):
    photos = s.read.parquet(f"{d}/nation.parquet").select(F.concat((F.col("n_nationkey") * 15).cast("string"), F.lit(".jpg")).alias("name"))
    return telemetry.photo_positions(photos, _first_flight(s, d))


def _first_flight(s, d):
    f = fixes(s, d)
    first = f.agg(F.min("flight_id").alias("flight_id"))
    return f.join(F.broadcast(first), "flight_id").select((F.col("seq") * 10).cast("string").alias("imgid"), F.col("alt").cast("string").alias("lat"), F.col("h_acc").cast("string").alias("lon"), F.when(F.col("seq") % 2 == 0, "").otherwise("7.5").alias("alt"))


@query(f"""with t as (select cast(imgid as double) as k, cast(lat as double) as lat, cast(lon as double) as lon, case when alt = '' then 0.0e0 else 7.5e0 end as alt from ({_TABLE}) x), p as (select n_nationkey * 35 + 0.5e0 as k from nation),
b as (select p.k, max(t.k) filter (t.k <= p.k) as a, min(t.k) filter (t.k >= p.k) as b from p, t group by p.k)
select concat(cast(b.k as varchar), '.jpg') as name, round(x.lat + (y.lat - x.lat) * (b.k - a) / (b.b - a), 6) as lat, round(x.lon + (y.lon - x.lon) * (b.k - a) / (b.b - a), 6) as lon, round(x.alt + (y.alt - x.alt) * (b.k - a) / (b.b - a), 6) as alt from b left join t x on x.k = a left join t y on y.k = b.b""")
def photo_positions_by_time(s, d):
    photos = s.read.parquet(f"{d}/nation.parquet").select(F.concat((F.col("n_nationkey") * 35 + 0.5).cast("double").cast("string"), F.lit(".jpg")).alias("name"))
    return telemetry.photo_positions(photos, _first_flight(s, d).withColumnRenamed("imgid", "timestamp"), "time").select("name", r6("lat"), r6("lon"), r6("alt"))


_TAKEN = "select c_nationkey as folder, c_custkey as k, concat('p', cast(c_custkey % 97 as varchar(9)), '_', cast(c_custkey as varchar(9))) as name, case when c_nationkey % 2 = 0 and c_custkey % 10 = 3 then null else 1000000 - c_custkey % 53 end as taken from customer"


@query(f"with c as ({_TAKEN}), f as (select *, count(taken) over (partition by folder) = count(*) over (partition by folder) as timed from c) select folder, name, row_number() over (partition by folder order by case when timed then taken end, name) - 1 as seq from f")
def ordered_photos(s, d):
    return telemetry.ordered_photos(_bound(s, d, _TAKEN, ("customer",))).select("folder", "name", "seq")


@query("with e as (select event_id as imgid, epoch_us(ts) as c from events where event_id between 11 and 400) select imgid, round((c - (select c from e where imgid = 11)) / 1e6, 6) as t from e")
def frame_times(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("imgid"), F.unix_micros(F.col("ts").cast("timestamp")).alias("timpstemp"))
    return telemetry.frame_times(e, 11, 400).select("imgid", r6("t"))


@query("""with p as (select event_id * 30.0e0 as k, value as x from events), f as (select p_partkey as frame from part), q as (select frame, frame + 30.0e0 as k from f where frame + 30 between (select min(k) from p) and (select max(k) from p)),
b as (select frame, q.k, 30e0 * floor(q.k / 30e0) as lo from q) select frame, round(a.x + coalesce((c.x - a.x) * (b.k - b.lo) / 30e0, 0), 6) as rx from b join p a on a.k = b.lo left join p c on c.k = b.lo + 30e0""")
def reference_poses(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select((F.col("event_id") * 30.0).alias("imgid"), F.col("value").alias("x_gt"), F.lit(0.0).alias("y_gt"), F.lit(1.0).alias("z_gt"))
    k = s.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").cast("string").alias("name"), F.col("p_partkey").alias("frame"))
    return telemetry.reference_poses(e, k, 30).select("frame", r6("rx"))


# Places on the map: customers spread over the globe.
_GLOBE = "select c_custkey as k, (c_custkey * 37 % 1680) / 10.0 - 84.0 as lat, (c_custkey * 101 % 3600) / 10.0 - 180.0 + 0.0125 as lon from customer"
_GLOBE = f"select k, cast(lat as double) as lat, cast(lon as double) as lon from ({_GLOBE}) g"


def _utm_sql() -> str:
    radius, forward, _, _ = G._series()
    n = G.FLATTENING / (2 - G.FLATTENING)
    k = 2 * math.sqrt(n) / (1 + n)
    e = " + ".join(f"({a!r}) * cos({2 * j + 2} * xi) * (exp({2 * j + 2} * eta) - exp(-{2 * j + 2} * eta)) / 2" for j, a in enumerate(forward))
    no = " + ".join(f"({a!r}) * sin({2 * j + 2} * xi) * (exp({2 * j + 2} * eta) + exp(-{2 * j + 2} * eta)) / 2" for j, a in enumerate(forward))
    at = lambda x: f"(0.5e0 * ln((1 + {x}) / (1 - {x})))"
    return f"""with g as (select *, cast(floor((lon + 180) / 6) as bigint) % 60 + 1 as zone, sin(radians(lat)) as s from ({_GLOBE}) x), h as (select *, {at('s')} - {k!r} * {at(f'({k!r} * s)')} as q, radians(lon - (zone * 6 - 183)) as d from g),
i as (select *, (exp(q) - exp(-q)) / 2 as t from h), j as (select *, atan2(t, cos(d)) as xi, {at('(sin(d) / sqrt(1 + t * t))')} as eta from i)
select k, cast(zone as integer) as zone, round({G.UTM_EAST!r} + {G.UTM_SCALE * radius!r} * (eta + {e}), 3) as east, round(case when lat < 0 then {G.UTM_SOUTH!r} else 0 end + {G.UTM_SCALE * radius!r} * (xi + {no}), 3) as north from j"""


@query(_utm_sql())
def utm_coordinates(s, d):
    g = _bound(s, d, _GLOBE, ("customer",)).withColumn("zone", G.utm_zone(F.col("lon")))
    e, n = G.utm(F.col("lat"), F.col("lon"), F.col("zone"), F.col("lat") < 0)
    return g.select("k", "zone", F.round(e, 3).alias("east"), F.round(n, 3).alias("north"))


@query(f"select k, round(lat, 6) as lat, round(lon, 6) as lon from ({_GLOBE}) g")
def utm_round_trip(s, d):
    g = _bound(s, d, _GLOBE, ("customer",)).withColumn("zone", G.utm_zone(F.col("lon")))
    e, n = G.utm(F.col("lat"), F.col("lon"), F.col("zone"), F.col("lat") < 0)
    lat, lon = G.from_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("lat") < 0)
    return g.select("*", e.alias("e"), n.alias("n")).select("k", r6(lat, "lat"), r6(lon, "lon"))


_SWISS = "select c_custkey as k, cast(2500000 + c_custkey * 131 % 330000 as double) as east, cast(1080000 + c_custkey * 197 % 210000 as double) as north from customer"


@query(f"with y as (select k, (east - 2600000) / 1e6 as y, (north - 1200000) / 1e6 as x from ({_SWISS}) c) select k, round((16.9023892e0 + 3.238272e0 * x - 0.270978e0 * y * y - 0.002528e0 * x * x - 0.0447e0 * y * y * x - 0.0140e0 * x * x * x) * 100 / 36, 8) as lat, round((2.6779094e0 + 4.728982e0 * y + 0.791484e0 * y * x + 0.1306e0 * y * x * x - 0.0436e0 * y * y * y) * 100 / 36, 8) as lon from y")
def swiss_to_geodetic(s, d):
    lat, lon = G.from_swiss(F.col("east"), F.col("north"))
    return _bound(s, d, _SWISS, ("customer",)).select("k", F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"))


@query(f"select k, cast(floor(abs(lat + 0.0033e0)) as integer) as degrees, cast(floor((abs(lat + 0.0033e0) - floor(abs(lat + 0.0033e0))) * 60) as integer) as minutes, round(case when k % 3 = 0 then -1 else 1 end * (k % 90 + 1 + (k % 60) / 60e0 + (k % 59) / 3600e0), 9) as angle from ({_GLOBE}) g")
def angles_in_parts(s, d):
    g = _bound(s, d, _GLOBE, ("customer",)).withColumn("p", G.dms(F.col("lat") + 0.0033))
    angle = G.from_dms((F.col("k") % 90 + 1).cast("double"), *((F.col("k") % m).cast("double") for m in (60, 59)), F.when(F.col("k") % 3 == 0, "s").otherwise("E"))
    return g.select("k", "p.degrees", "p.minutes", F.round(angle, 9).alias("angle"))


@query("""with q as (select c_custkey as k, 1.0e0 as w, (c_custkey % 13 - 6) / 10e0 as x, (c_custkey % 17 - 8) / 10e0 as y, (c_custkey % 19 - 9) / 10e0 as z from customer)
select k, round(degrees(atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))), 6) as yaw, round(degrees(asin(greatest(-1, least(1, 2 * (w * y - z * x))))), 6) as pitch, round(degrees(atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y))), 6) as roll from q""")
def attitude_angles(s, d):
    k = F.col("c_custkey")
    part = lambda m, h: (k % m - h) / 10.0
    yaw, pitch, roll = G.quaternion_angles(F.lit(1.0), part(13, 6), part(17, 8), part(19, 9))
    return s.read.parquet(f"{d}/customer.parquet").select(k.alias("k"), r6(yaw, "yaw"), r6(pitch, "pitch"), r6(roll, "roll"))


@query("select s_suppkey as k, case when s_suppkey % 4 = 0 then null else case s_suppkey % 2 when 0 then 32700 else 32600 end + s_suppkey % 60 + 1 end as epsg from supplier")
def projection_codes(s, d):
    k = F.col("s_suppkey")
    line = F.when(k % 4 == 0, "local").otherwise(F.concat(F.lit("WGS84 UTM "), (k % 60 + 1).cast("string"), F.when(k % 2 == 0, "S").otherwise("N")))
    return s.read.parquet(f"{d}/supplier.parquet").select(k.alias("k"), G.utm_epsg(line).alias("epsg"))


@query("""select o_orderkey as k, case when b < 1024 then printf('%d B', b) when b < 1048576 then printf('%.1f KB', round_even(b / 1024e0, 1)) when b < 1073741824 then printf('%.1f MB', round_even(b / 1048576e0, 1)) else printf('%.2f GB', round_even(b / 1073741824e0, 2)) end as human
from (select o_orderkey, cast(floor(pow(o_orderkey % 200 / 3e0, 5.2e0)) * 5 as bigint) as b from orders) o""")
def human_sizes(s, d):
    b = (F.floor(F.pow((F.col("o_orderkey") % 200) / 3.0, F.lit(5.2))) * 5).cast("long")
    return s.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), G.human_size(b).alias("human"))


@query("select s_suppkey as k, s_suppkey % 256 * 257 as wide, s_suppkey * 977 % 65536 // 256 as narrow from supplier")
def colour_depths(s, d):
    k = F.col("s_suppkey")
    return s.read.parquet(f"{d}/supplier.parquet").select(k.alias("k"), G.widened(k % 256).alias("wide"), G.narrowed(k * 977 % 65536).alias("narrow"))


# Shots that have a label picture; models that are written again; two points' distance.
@query(f"select n_nationkey as shot from nation where exists (select 1 from ({LABELS}) l where l.shot = n_nationkey)")
def shots_with_labels(s, d):
    n = s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("shot"))
    return n.join(labels(s, d).select("shot").distinct(), "shot", "left_semi")


@query("with o as (select p_partkey as key, p_size as ord, p_retailprice as v from part), n as (select s_suppkey * 2 as key, s_acctbal as v from supplier) select key, ord, v from o where key not in (select key from n) union all select key, (select max(ord) from o) + 1 as ord, v from n")
def upserted_models(s, d):
    old = s.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("ord"), F.col("p_retailprice").alias("v"))
    new = s.read.parquet(f"{d}/supplier.parquet").select((F.col("s_suppkey") * 2).alias("key"), F.lit(0).alias("ord"), F.col("s_acctbal").alias("v"))
    return outputs.upserted(old, new)


@query("select r_name as key, 0 as place, r_regionkey as ord, r_name = 'ASIA' as shown from region union all select n_name, 1, n_nationkey, false from nation")
def model_list(s, d):
    own = s.read.parquet(f"{d}/region.parquet").select(F.col("r_name").alias("key"), F.col("r_regionkey").alias("ord"))
    more = s.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("ord"))
    return outputs.model_list(own, more, "ASIA").withColumnRenamed("group", "place")


@query(f"with p as (select shot, cls, min_by(struct_pack(x := x, y := y, z := z), point_id * 1000 + x) as a, max_by(struct_pack(x := x, y := y, z := z), point_id * 1000 + x) as b from ({POINTS}) q group by all) select shot, cls, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)), 2) as distance, round(abs(a.z - b.z), 2) as height from p")
def measured_lines(s, d):
    p, order = F.struct(*"xyz"), F.col("point_id") * 1000 + F.col("x")
    g = cloud(s, d).groupBy("shot", "cls").agg(F.min_by(p, order).alias("a"), F.max_by(p, order).alias("b"))
    return C.measured(g)
