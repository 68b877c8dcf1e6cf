"""Queries on verdicts, reports and storage, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import reports, rules, storage
from .catalog import _bound, fixes, query

# Tracks to combine: one customer's orders, the verdict by priority.
_STATUS = "case substr(o_orderpriority, 1, 1) when '1' then 'valid' when '2' then 'valid_with_warning' when '3' then 'suspicious' when '4' then 'invalid' else 'unknown' end"
TRACKS = f"select o_custkey as flight_id, o_orderkey as ord, {_STATUS} as status, concat('s', cast(o_orderkey % 9 as varchar(20))) as source, concat('r', cast(o_orderkey % 4 as varchar(20))) as reason, concat('w', cast(o_orderkey % 3 as varchar(20))) as warning from orders"


def _tracks(s, d):
    t = _bound(s, d, TRACKS, ("orders",))
    single = F.when(F.col("status").isin("valid", "valid_with_warning"), True).when(F.col("status").isin("suspicious", "invalid"), False)
    return t.select("flight_id", "ord", "status", "source", F.array("reason").alias("reasons"), F.array("warning").alias("warnings"), single.alias("single_pass"))


_RANK = "case status when 'valid' then 0 when 'valid_with_warning' then 1 when 'suspicious' then 3 when 'invalid' then 4 end"


@query(f"""with t as (select *, {_RANK} as s from ({TRACKS}) x), m as (select *, max(s) over (partition by flight_id) as top from t),
g as (select flight_id, max(top) as top, min_by(status, ord) filter (s = top) as status, min_by(source, ord) filter (s = top) as source from m group by flight_id),
r as (select flight_id, string_agg(reason, ',' order by ord) as reasons from (select flight_id, reason, min(ord) as ord from m where s = top or top is null group by all) z group by flight_id),
w as (select flight_id, string_agg(warning, ',' order by late, ord) as warnings from (select flight_id, warning, min(late) as late, min_by(ord, late * 1000000000 + ord) as ord from (select *, case when s is null then 1 else 0 end as late from m where s = top or s is null) y group by all) z group by flight_id),
u as (select flight_id, string_agg(source, ',' order by ord) as unjudged from m where s is null group by flight_id)
select g.flight_id, coalesce(g.status, 'unknown') as status, g.status in ('valid', 'valid_with_warning') as single_pass, g.source, r.reasons, coalesce(w.warnings, '') as warnings, coalesce(u.unjudged, '') as unjudged from g join r using (flight_id) left join w using (flight_id) left join u using (flight_id)""".replace("g.status in ('valid', 'valid_with_warning') as single_pass", "case when g.status is null then null else g.status in ('valid', 'valid_with_warning') end as single_pass"))
def combined_verdicts(s, d):
    c = reports.combined(_tracks(s, d))
    return c.select("flight_id", "status", "single_pass", "source", *(F.array_join(x, ",").alias(x) for x in ("reasons", "warnings", "unjudged")))


@query(f"select flight_id, ord, case when status in ('suspicious', 'invalid') then 'stop' else 'continue' end as enforced, 'continue' as warned, status in ('suspicious', 'invalid') as overridden from ({TRACKS}) t")
def run_actions(s, d):
    st = F.col("status")
    return _tracks(s, d).select("flight_id", "ord", reports.decided(st)["action"].alias("enforced"), reports.decided(st, "warn")["action"].alias("warned"), reports.decided(st, "enforce", True)["overridden"].alias("overridden"))


@query()
def run_validation(s, d):
    """Keyframes are the fixes themselves, a third of them late by a minute."""
    f = fixes(s, d)
    k = f.withColumn("t", F.col("t") + F.when(F.col("flight_id") % 3 == 0, 60.0).otherwise(0.0))
    v = reports.validated(k, f)
    return v.withColumns({"reasons": F.array_join("reasons", ","), "warnings": F.array_join("warnings", ","), "trajectory_start": F.to_json("trajectory_start"), "trajectory_end": F.to_json("trajectory_end")})


@query("select o_custkey as run, count(*) as stages, round(sum(floor(o_totalprice)), 1) as seconds, round(sum(floor(o_totalprice)) / 60, 1) as minutes from orders group by 1")
def stage_timings(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("stage"), F.floor("o_totalprice").cast("double").alias("seconds"))
    return reports.timings(o)


_REPORT = """select p_partkey as run, case p_partkey % 5 when 0 then '{}' when 1 then '{"reconstruction":{"ok":true,"attempts":2},"outputs":{"dsm":"a","report":"b"}}'
 when 2 then concat('{"reconstruction":{"ok":true},"classified_cloud":{"points":', cast(p_size as varchar(9)), ',"median_views":3},"gap_filling":{"inferred_points_added":7}}')
 when 3 then concat('{"reconstruction":{"ok":false,"attempted":true},"flight_validation":{"status":"invalid","path_efficiency":0.', cast(p_size as varchar(9)), '}}')
 else concat('{"reconstruction":{"ok":true},"gps_fusion":{"quality":"ok"},"accuracy_vs_lidar":{"n":', cast(p_size as varchar(9)), '}}') end as report from part"""


@query(f"""with r as (select run, run % 5 as k, report from ({_REPORT}) p), c as (select run, k, unnest(['reconstruction', 'single_pass', 'georeferencing', 'point_cloud', 'ai_classification', 'gap_filling']) as claim, report from r)
select run, claim, case claim when 'reconstruction' then case k when 0 then 'not_attempted' when 3 then 'failed' else 'success' end when 'single_pass' then case k when 3 then 'invalid' else 'unknown' end
 when 'georeferencing' then case k when 4 then 'measured_against_reference' when 0 then 'not_run' when 3 then 'not_run' else 'gps_anchored_no_independent_reference' end
 when 'point_cloud' then case k when 2 then 'measured' when 0 then 'not_run' when 3 then 'not_run' else 'measured_not_classified' end else case k when 2 then 'measured' else 'not_run' end end as status,
 case when claim = 'point_cloud' then regexp_extract(report, '"points":([0-9]+)', 1) when claim = 'single_pass' then regexp_extract(report, '"path_efficiency":([0-9.]+)', 1) when claim = 'reconstruction' then regexp_extract(report, '"attempts":([0-9]+)', 1) else '' end as fact from c""")
def quality_claims(s, d):
    q = reports.quality_summary(_bound(s, d, _REPORT, ("part",)))
    return q.select("run", "claim", "status", F.coalesce(F.col("facts")["points"], F.col("facts")["path_efficiency"], F.col("facts")["attempts"], F.lit("")).alias("fact"))


_FOLDERS = [*storage.RUN_FOLDERS, *storage.PROJECT_FOLDERS, "else"]
_AREA = "case when doc_id % 17 = 16 then 'viewer' when doc_id % 15 < 3 then 'run' else 'project' end"
_NAMES = "[" + ", ".join(f"'{f}'" for f in _FOLDERS) + "]"
LISTED = f"select lang as run, doc_id, {_AREA} as area, case when doc_id % 31 = 7 then 'classified.laz' when doc_id % 31 = 8 then 'notes.txt' else concat(@FOLDER, '/', cast(doc_id as varchar(20)), '.bin') end as path, md5(text) as ino, n_chars as size from documents"
_SQL_LISTED = LISTED.replace("@FOLDER", f"{_NAMES}[doc_id % 15 + 1]")
_TARGETS = [("run", f) for f in storage.RUN_FOLDERS] + [("project", f) for f in storage.PROJECT_FOLDERS] + [("project", c) for c in (*rules.SUPERSEDED, rules.FINAL)]
_ORD = " ".join(f"when '{a}/{n}' then {i}" for i, (a, n) in enumerate(_TARGETS))
_USED = f"""with f as ({_SQL_LISTED}), t as (select *, case when area = 'viewer' then 'viewer' when contains(path, '/') or path = 'classified.laz' then concat(area, '/', split_part(path, '/', 1)) end as target from f), o as (select *, case target {_ORD} when 'viewer' then {len(_TARGETS)} end as ord from t),
k as (select * from o where ord is not null), n as (select run, ino, min(ord) as ord, min(size) as size from k group by all), u as (select run, ord, sum(size) as b from n group by all), g as (select run, target, ord, sum(size) as size from k group by all)"""


def _listed(s, d):
    return _bound(s, d, LISTED.replace("@FOLDER", f"element_at(array({_NAMES[1:-1]}), cast(doc_id % 15 + 1 as int))"), ("documents",))


@query(f"{_USED} select g.run, target, cast(g.size as bigint) as size, cast(coalesce(u.b, 0) as bigint) as unique_bytes, row_number() over (partition by g.run order by g.size desc, g.ord) as place from g left join u on u.run = g.run and u.ord = g.ord")
def storage_targets(s, d):
    return storage.usage(storage.targets(_listed(s, d)), "run").drop("human")


def _human(x: str) -> str:
    return f"case when {x} < 1024 then printf('%d B', {x}) when {x} < 1048576 then printf('%.1f KB', round_even({x} / 1024e0, 1)) when {x} < 1073741824 then printf('%.1f MB', round_even({x} / 1048576e0, 1)) else printf('%.2f GB', round_even({x} / 1073741824e0, 2)) end"


@query(f"""{_USED}, v as (select g.run, target, cast(g.size as bigint) as size, cast(coalesce(u.b, 0) as bigint) as once, row_number() over (partition by g.run order by g.size desc, g.ord) as place from g left join u on u.run = g.run and u.ord = g.ord),
w as (select run, cast(sum(size) as bigint) as a, cast(sum(once) as bigint) as o, count(*) as k from v group by run)
select run, 0 as n, concat('Disk usage of ', run) as line from w union all select run, place, concat('  ', lpad({_human("size")}, 10, ' '), '  ', target) from v
union all select run, k + 1, concat('Logical total: ', {_human("a")}, ' (', cast(a as varchar), ' bytes) in ', cast(k as varchar), ' entries') from w union all select run, k + 2, concat('Unique total: ', {_human("o")}, ' (', cast(o as varchar), ' bytes)') from w""")
def storage_lines(s, d):
    return storage.usage_lines(storage.usage(storage.targets(_listed(s, d)), "run"))


_PROJECT = f"select run as project, path, ino, size from ({_SQL_LISTED}) l"
_GONE = ", ".join(f"'{f}'" for f in rules.DELETABLE_FOLDERS)


@query(f"""with f as ({_PROJECT}), x as (select *, case when contains(path, '/') then split_part(path, '/', 1) else path end as top from f), k as (select * from x where top in ({_GONE})),
n as (select project, ino, min(top) as top, min(size) as size from k group by all), u as (select project, top, sum(size) as b from n group by all)
select k.project, k.top as path, cast(sum(k.size) as bigint) as size, cast(coalesce(max(u.b), 0) as bigint) as unique_bytes from k left join u on u.project = k.project and u.top = k.top group by k.project, k.top""")
def cleanup_plan(s, d):
    f = _listed(s, d).select(F.col("run").alias("project"), "path", "ino", "size").withColumn("is_dir", F.lit(False))
    tops = f.where(F.instr("path", "/") > 0).select("project", F.substring_index("path", "/", 1).alias("path")).distinct().select("project", "path", F.lit(None).cast("string").alias("ino"), F.lit(0).cast("long").alias("size"), F.lit(True).alias("is_dir"))
    return storage.cleanup_plan(f.unionByName(tops))
