"""Queries on streams of fixes (flight_id, ts, ...); each also runs on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once(fixes: DataFrame, keys: list[str], late: str = "1 minute") -> DataFrame:
    """Fixes without those sent again within the watermark; state goes with it."""
    return fixes.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def flights(fixes: DataFrame, gap: str = "30 seconds", late: str = "1 minute", key: str = "flight_id") -> DataFrame:
    """(key, start, last, fixes): fixes of a key less than a gap apart are one flight."""
    g = fixes.withWatermark("ts", late).groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("fixes"), F.max("ts").alias("last"))
    return g.select(key, F.col("w.start").alias("start"), "last", "fixes")


def health(fixes: DataFrame, value: str, span: str = "1 minute", late: str = "1 minute", key: str = "flight_id") -> DataFrame:
    """(key, start, fixes, low, high, missing) of each window."""
    g = fixes.withWatermark("ts", late).groupBy(key, F.window("ts", span).alias("w"))
    g = g.agg(F.count("*").alias("fixes"), F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(F.col(value).isNull()).alias("missing"))
    return g.select(key, F.col("w.start").alias("start"), "fixes", "low", "high", "missing")
