"""Rules on the files of finished runs: which runs succeeded, and what may be deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names that the reconstruction program gives its files and folders. Clouds made later carry a prefix of the caller's.
DELETABLE_FOLDERS = ["opensfm", "openmvs", "odm_filterpoints", "odm_meshing", "odm_texturing_25d", "odm_orthophoto", "odm_dem", "odm_report"]
SUPERSEDED = ["classified.laz", "filled.laz"]
FINAL = "final.laz"


def _markers(prefix: str) -> list[str]:
    return ["odm_georeferencing/odm_georeferenced_model.laz", *(prefix + c for c in (*SUPERSEDED, FINAL)), "odm_georeferencing/coords.txt"]


def succeeded(runs: DataFrame, files: DataFrame, prefix: str = "") -> DataFrame:
    """(project, successful, reason) of runs (project, report: JSON text or null) with files (project, path)."""
    doc, kind = F.try_parse_json("report"), lambda v: F.schema_of_variant(v)
    part = F.try_variant_get(doc, "$.reconstruction", "variant")
    ok = F.try_variant_get(doc, "$.reconstruction.ok", "variant")
    outputs = F.get_json_object("report", "$.outputs")
    order = F.create_map(*(F.lit(x) for i, m in enumerate(_markers(prefix)) for x in (m, i)))
    marks = files.where(F.col("path").isin(_markers(prefix))).groupBy("project").agg(F.min_by("path", order[F.col("path")]).alias("mark"))
    has = F.col("report").isNotNull()
    broken = has & (doc.isNull() | ~kind(doc).startswith("OBJECT") | F.coalesce(~kind(part).startswith("OBJECT"), F.lit(False)))
    good = F.coalesce((kind(ok) == "BOOLEAN") & ok.cast("boolean"), F.lit(False))
    filled = outputs.isNotNull() & ~outputs.isin("", "{}", "[]", "false", "0")
    found = F.col("mark").isNotNull()
    reason = F.when(broken, "report unreadable").when(good, "report marks reconstruction ok").when(filled, "report has outputs").when(found, F.concat(F.lit("found "), "mark")).when(has, "report does not mark successful completion").otherwise("no report and no final outputs found")
    return runs.select("project", "report").join(marks, "project", "left").select("project", (~broken & (good | filled | found)).alias("successful"), reason.alias("reason"))


def deletable(files: DataFrame, prefix: str = "") -> DataFrame:
    """(project, path) of files (project, path, is_dir) that nothing reads any more; superseded clouds only where the final one is."""
    final = files.where(F.col("path") == prefix + FINAL).select("project").distinct()
    folders = files.where(F.col("is_dir") & F.col("path").isin(DELETABLE_FOLDERS))
    clouds = files.where(~F.col("is_dir") & F.col("path").isin([prefix + c for c in SUPERSEDED])).join(final, "project", "left_semi")
    return folders.select("project", "path").unionByName(clouds.select("project", "path"))
