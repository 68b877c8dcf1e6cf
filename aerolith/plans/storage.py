"""Storage of runs: file listings, usage by target, reports, and what may be cleaned up."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geodesy import human_size
from . import rules

LISTING = "root string, path string, ino string, size long, is_dir boolean"

# fixed values: folders of a run and of its reconstruction that the report lists, in this order; then clouds, then the viewer's data
RUN_FOLDERS = ["frames", "labels", "masks"]
PROJECT_FOLDERS = ["images", "opensfm", "openmvs", "odm_filterpoints", "odm_meshing", "odm_georeferencing", "odm_texturing", "odm_texturing_25d", "odm_orthophoto", "odm_dem", "odm_report"]


def walk(root: str) -> Iterator[tuple[str, str, str | None, int, bool]]:
    """(root, path, device and inode, size, is folder) of all below a folder: links to files are followed, links to folders are not; what can't be read is left out."""
    if os.path.isfile(root):
        todo, rows = [], [("", os.stat(root))]
    else:
        todo, rows = [""], []
    while todo or rows:
        for path, st in rows:
            yield root, path, f"{st.st_dev}:{st.st_ino}", st.st_size, False
        rows = []
        if not todo:
            break
        at = todo.pop()
        try:
            with os.scandir(os.path.join(root, at)) as entries:
                for e in sorted(entries, key=lambda x: x.name):
                    path = os.path.join(at, e.name)
                    try:
                        if e.is_dir(follow_symlinks=False):
                            todo.append(path)
                            yield root, path, None, 0, True
                        elif e.is_file():
                            rows.append((path, e.stat()))
                    except OSError:
                        continue
        except OSError:
            continue


def listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """The files and folders below local folders, as rows (root, path, ino, size, is_dir). The driver reads the names, as the folders are its own."""
    rows = [r for root in roots if os.path.exists(root) for r in walk(root)]
    return spark.createDataFrame(rows, LISTING)


def targets(files: DataFrame, prefix: str = "") -> DataFrame:
    """Files (run, area, path, ino, size) with target and ord: area is run, project or viewer; files of no target are left out.

    A file belongs to the folder it lies in; of the project's own files only the three clouds count.
    """
    clouds = [prefix + c for c in (*rules.SUPERSEDED, rules.FINAL)]
    names = [("run", f) for f in RUN_FOLDERS] + [("project", f) for f in PROJECT_FOLDERS] + [("project", c) for c in clouds]
    order = F.create_map(*(F.lit(x) for i, (a, n) in enumerate(names) for x in (f"{a}/{n}", i)))
    top = F.concat_ws("/", "area", F.substring_index("path", "/", 1))
    inside = F.when(F.col("area") == "viewer", F.lit("viewer")).when((F.instr("path", "/") > 0) | F.col("path").isin(clouds), top)
    out = files.withColumn("target", inside).withColumn("ord", F.when(F.col("area") == "viewer", len(names)).otherwise(order[F.col("target")]))
    return out.where("ord is not null")


def usage(files: DataFrame, *keys: str) -> DataFrame:
    """(keys, target, size, unique_bytes, place, human): logical size of each target, largest first (place), earlier targets first on ties.

    A file that is linked twice counts once in unique_bytes, for its first target.
    """
    once = files.groupBy(*keys, "ino").agg(F.min("ord").alias("ord"), F.min("size").alias("size")).groupBy(*keys, "ord").agg(F.sum("size").alias("unique_bytes"))
    g = files.groupBy(*keys, "target", "ord").agg(F.sum("size").alias("size")).join(once, [*keys, "ord"], "left")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("size"), "ord"))
    return g.select(*keys, "target", "size", F.coalesce("unique_bytes", F.lit(0)).cast("long").alias("unique_bytes"), place.alias("place"), human_size(F.col("size")).alias("human"))


def usage_lines(used: DataFrame, key: str = "run") -> DataFrame:
    """(key, n, line): the report for people: a heading, a line for each target, both totals."""
    total = used.groupBy(key).agg(F.count("*").alias("n"), F.sum("size").alias("all"), F.sum("unique_bytes").alias("once"), F.array_sort(F.collect_list(F.struct("place", "human", "target"))).alias("t"))
    said = lambda name, c: F.concat(F.lit(f"{name} total: "), human_size(F.col(c)), F.lit(" ("), F.col(c).cast("string"), F.lit(" bytes)"))
    rows = F.concat(F.array(F.concat(F.lit("Disk usage of "), F.col(key).cast("string"))), F.transform("t", lambda x: F.concat(F.lit("  "), F.lpad(x["human"], 10, " "), F.lit("  "), x["target"])), F.array(F.concat(said("Logical", "all"), F.lit(" in "), F.col("n").cast("string"), F.lit(" entries")), said("Unique", "once")))
    return total.select(key, F.posexplode(rows).alias("n", "line"))


def cleanup_plan(files: DataFrame, prefix: str = "") -> DataFrame:
    """(project, path, size, unique_bytes) of what may be deleted from listings (project, path, ino, size, is_dir); paths stay inside their project.

    Of files that are linked from several such paths the first path has the bytes.
    """
    safe = files.where(~F.col("path").startswith("/") & ~F.array_contains(F.split("path", "/"), ".."))
    gone = rules.deletable(safe, prefix)
    tops = gone.select("project", F.col("path").alias("top"))
    inside = safe.where("not is_dir").withColumn("top", F.when(F.instr("path", "/") > 0, F.substring_index("path", "/", 1)).otherwise(F.col("path"))).join(tops, ["project", "top"])
    size = inside.groupBy("project", "top").agg(F.sum("size").alias("size"))
    once = inside.groupBy("project", "ino").agg(F.min("top").alias("top"), F.min("size").alias("size")).groupBy("project", "top").agg(F.sum("size").alias("unique_bytes"))
    out = tops.join(size, ["project", "top"], "left").join(once, ["project", "top"], "left")
    return out.select("project", F.col("top").alias("path"), F.coalesce("size", F.lit(0)).cast("long").alias("size"), F.coalesce("unique_bytes", F.lit(0)).cast("long").alias("unique_bytes"))


def clean(spark: SparkSession, project: str, *, prefix: str = "", confirm: bool = False, report: str | None = None) -> list[tuple[str, int, str]]:
    """(path, bytes, done) for each path that may go from a local project: only named unless confirmed, and never from a run that did not succeed.

    A path that can't be deleted is named with its error, and the others go on.
    """
    import shutil

    files = listing(spark, [project]).withColumn("project", F.lit(project))
    runs = spark.createDataFrame([(project, report)], "project string, report string")
    done = rules.succeeded(runs, files.select("project", "path"), prefix).first()
    if done is None or not done.successful:
        raise RuntimeError(f"not cleaned: {done.reason if done else 'no such project'}")
    out = []
    for row in cleanup_plan(files, prefix).orderBy("path").collect():
        where = os.path.join(project, row.path)
        said = "would go"
        if confirm:
            try:
                (shutil.rmtree if os.path.isdir(where) and not os.path.islink(where) else os.remove)(where)
                said = "gone"
            except OSError as e:
                said = f"failed: {e}"
        out.append((row.path, row.size, said))
    return out


# fixed values: outputs that a finished reconstruction may have
OUTPUTS = {"textured_mesh": "odm_texturing/odm_textured_model_geo.obj", "point_cloud": "odm_georeferencing/odm_georeferenced_model.laz", "orthophoto": "odm_orthophoto/odm_orthophoto.tif", "dsm": "odm_dem/dsm.tif", "report": "odm_report/report.pdf"}


def outputs(files: DataFrame) -> DataFrame:
    """(project, output, path) of the outputs that are there."""
    known = F.create_map(*(F.lit(x) for k, v in OUTPUTS.items() for x in (v, k)))
    return files.where(F.col("path").isin(list(OUTPUTS.values()))).select("project", known[F.col("path")].alias("output"), "path").distinct()
