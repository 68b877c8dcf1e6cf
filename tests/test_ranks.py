"""Exact quantiles over many rows, pairs of blocks, and rounding, against plain versions."""

import math

import numpy as np
from pyspark.sql import functions as F

from aerolith.operators import buildings, ranks


def test_quantiles(spark, monkeypatch):
    monkeypatch.setattr(ranks, "GUESS", 2_000)
    monkeypatch.setattr(ranks, "PARTS", 8)
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(1, 1e-9, 6000), rng.lognormal(0, 30, 3000), np.repeat(0.5, 1001)])
    b = [None if i % 3 else -math.inf if i % 4 else math.inf if i % 5 else float("nan") for i in range(len(a))]
    rows = spark.createDataFrame([(float(x), y) for x, y in zip(a, b)], "a double, b double").repartition(4)
    n, got = ranks.quantiles(rows, {"a": [0.0, 0.25, 0.5, 0.9, 1.0]})["a"]
    want = rows.agg(*(F.percentile("a", F.lit(q)) for q in (0.0, 0.25, 0.5, 0.9, 1.0))).first()
    assert n == len(a) and got == list(want)
    n, (median,) = ranks.quantiles(rows, {"b": [0.5]})["b"]
    assert n == sum(v is not None for v in b) and median == -math.inf
    assert ranks.quantiles(rows.where("a is null"), {"a": [0.5]}) == {"a": (0, [None])}


def test_no_task_holds_all_values_of_the_summary(spark):
    rows = spark.createDataFrame([(i, i * 7.0, i % 9 * 30.0, i * 7.1, i % 9 * 29.0) for i in range(60)], "i long, mx double, my double, rx double, ry double")
    pairs = buildings.pair_distances(rows, 100.0, block=7)
    got = pairs.collect()
    assert sorted((r.i, r.j) for r in got) == [(i, j) for i in range(60) for j in range(i + 1, 60)]
    r = next(r for r in got if (r.i, r.j) == (3, 50))
    assert math.isclose(r.model, math.hypot(47 * 7.0, 60.0)) and math.isclose(r.reference, math.hypot(47 * 7.1, 58.0))
    summary = buildings.scale_summary(pairs)
    ratios = [r.ratio for r in got if r.ratio is not None]
    s = summary.first()
    assert s.pairs == len(ratios) < len(got) and s.median_ratio == round(float(np.median(ratios)), 4)
    assert s.median_abs_distance_error == round(float(np.median([abs(r.model - r.reference) for r in got])), 2)
    assert "percentile" not in summary._jdf.queryExecution().toString() and "median(" not in summary._jdf.queryExecution().toString()


def test_pairs_meet_in_blocks(spark):
    rows = spark.range(900).select(F.col("id").alias("i"), *(F.rand(7).alias(c) for c in ("mx", "my", "rx", "ry")))
    pairs = buildings.pair_distances(rows, block=100)
    sizes = [n for n in pairs.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    assert sum(sizes) == 900 * 899 // 2 and len(sizes) > 20 and max(sizes) < 60_000


def test_rounded_as_round(spark):
    rng = np.random.default_rng(5)
    values = [0.0, -0.0, 0.00005, 2.00015, 2.00025, 1.00005, -2.00015, 12345678.00005, 1e300, -1e18, float("inf"), float("nan"), None, *(rng.integers(0, 10**9, 3000) / 1e5).tolist(), *rng.normal(0, 1e4, 3000).tolist()]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 4).alias("a"), buildings.rounded(F.col("v"), 4).alias("b"))
    assert rows.where("not a <=> b").count() == 0
