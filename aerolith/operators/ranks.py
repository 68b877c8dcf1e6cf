"""Exact quantiles of columns that are too many rows for one task: passes that narrow the places where the wanted ranks lie."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import defaultdict
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that the first guess is taken from, and parts of a range that a pass counts.
GUESS, PARTS = 100_000, 16_384


def quantiles(rows: DataFrame, wanted: dict[str, list[float]]) -> dict[str, tuple[int, list[float | None]]]:
    """(values that aren't null, their quantiles) of columns, as percentile() gives them: between two ranks in proportion; null without values.

    A random part of the rows only says where to look first; the counts of a pass over all rows decide, so results are exact
    whatever part it was. No task holds more than the counts of PARTS parts of each range.
    """
    names = list(wanted)
    rows = rows.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)))
    inf = F.lit(math.inf)
    facts = []
    for i in range(len(names)):
        c = F.col(f"c{i}")
        plain = F.when(~F.isnan(c) & (c != inf) & (c != -inf), c)
        facts += [F.count(c), F.count_if(c == -inf), F.count(plain), F.count_if(c == inf), F.min(plain), F.max(plain)]
    got = list(rows.agg(*(f.alias(f"f{k}") for k, f in enumerate(facts))).first())
    ranks, sizes, found, ranges = {}, {}, {}, []
    for i, c in enumerate(names):
        n, low, plain, high, least, most = got[6 * i : 6 * i + 6]
        sizes[i] = n
        ranks[i] = sorted({r for q in wanted[c] for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))}) if n else []
        for r in ranks[i]:
            if low <= r < low + plain:
                ranges.append((i, least, most, low, [r]))
            else:
                found[i, r] = -math.inf if r < low else math.inf if r < low + plain + high else math.nan
    if max(sizes.values(), default=0) > GUESS and ranges:
        ranges = _guessed(rows, ranges, {i: (got[6 * i + 1], got[6 * i + 2]) for i in sizes}, max(sizes.values()))
    while ranges:
        merged: dict[tuple, list[int]] = defaultdict(list)
        for i, least, most, below, some in ranges:
            if least == most:
                found |= {(i, r): least for r in some}
            else:
                merged[i, least, most, below] += some
        ranges = [(*k, some) for k, some in merged.items()]
        if ranges:
            ranges = _narrowed(rows, ranges, found)
    out = {}
    for i, c in enumerate(names):
        at = [q * (sizes[i] - 1) for q in wanted[c]]
        values = [None if not sizes[i] else found[i, math.floor(p)] if p == math.floor(p) else (math.ceil(p) - p) * found[i, math.floor(p)] + (p - math.floor(p)) * found[i, math.ceil(p)] for p in at]
        out[c] = (sizes[i], values)
    return out


def _guessed(rows: DataFrame, ranges: list[tuple], plain: dict[int, tuple[int, int]], n: int) -> list[tuple]:
    """The ranges, cut to where a random part of the rows has the ranks, or to what lies below or above that."""
    part = np.array([tuple(math.nan if v is None else v for v in r) for r in rows.sample(fraction=min(1.0, GUESS / n), seed=7).collect()], dtype=float).reshape(-1, len(plain))
    tried, asked = [], []
    for i, least, most, below, some in ranges:
        v = np.sort(part[np.isfinite(part[:, i]), i])
        if len(v) < 1000:
            tried.append((i, least, most, below, some, None))
            continue
        at, slack = (some[0] - plain[i][0]) / plain[i][1] * len(v), 2.5 * math.sqrt(len(v)) + 2
        a = float(v[int(at - slack)]) if at >= slack else least
        b = float(v[int(at + slack)]) if at + slack < len(v) else most
        tried.append((i, least, most, below, some, (a, b, len(asked))))
        asked += [F.count_if(F.col(f"c{i}") < a), F.count_if((F.col(f"c{i}") <= b) & ~F.isnan(f"c{i}"))]
    counts = list(rows.agg(*(c.alias(f"n{k}") for k, c in enumerate(asked))).first()) if asked else []
    out = []
    for i, least, most, below, some, cut in tried:
        if cut is not None:
            a, b, k = cut
            if some[0] < counts[k]:
                most = math.nextafter(a, -math.inf)
            elif some[0] >= counts[k + 1]:
                least, below = math.nextafter(b, math.inf), counts[k + 1]
            else:
                least, most, below = a, b, counts[k]
        out.append((i, least, most, below, some))
    return out


def _narrowed(rows: DataFrame, ranges: list[tuple], found: dict) -> list[tuple]:
    """The parts of the ranges that hold the ranks; ranks that are the first or last of a part are found."""
    tries, any_of = [], F.lit(False)
    for k, (i, least, most, *_) in enumerate(ranges):
        c = F.col(f"c{i}")
        width = most / 2 - least / 2
        part = F.least(F.lit(PARTS - 1), F.floor((c / 2 - least / 2) / width * PARTS).cast("int")) if width > 0 else (c > least).cast("int")
        inside = c.between(least, most)
        any_of = any_of | F.coalesce(inside, F.lit(False))
        tries.append(F.when(inside, F.struct(F.lit(k).alias("k"), part.alias("part"), c.alias("v"))))
    told = rows.where(any_of).select(F.explode(F.array(*tries)).alias("t")).where("t is not null").select("t.*")
    parts = defaultdict(list)
    for r in told.groupBy("k", "part").agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")).collect():
        parts[r.k].append((r.part, r.n, r.least, r.most))
    out = []
    for k, (i, _, _, below, some) in enumerate(ranges):
        held = sorted(parts[k])
        ends = [below, *accumulate((p[1] for p in held), initial=below)][1:]
        for r in some:
            at = bisect_right(ends, r) - 1
            _, n, least, most = held[at]
            if r in (ends[at], ends[at] + n - 1):
                found[i, r] = least if r == ends[at] else most
            else:
                out.append((i, least, most, ends[at], [r]))
    return out
