"""Embedding near-dedup over an inverted multi-index.

Unit vectors are cut into halves with a codebook each; the two form a product grid of cells, and every vector is filed in
its nearest one. A vector walks the grid by multi-sequence traversal: its distances to the codewords of either half are
sorted, and the pair of codewords with the least sum that is not yet visited comes next, until the sum exceeds the nearest
cell's by more than a bound. The bound is fitted so that of two vectors just at the threshold one visits the other's cell with the
target recall. In a cell, visitors meet the vectors filed there, and every cosine is verified in double precision.

The grid grows with the table, so that a cell holds some CELL vectors. Vectors with equal components and label are one class, by 128 bits of hashes. A hot cell is cut into
blocks, each verified where its vectors are and packed into one row; these rows then meet pair by pair, so rows grow with
the visits alone. Only counts and a spanning forest leave a task.

Defined cases: null labels and vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of other lengths meet only their own length: the WIDTHS commonest lengths have a grid each, others one cell; a null id is returned without links; rows that repeat are
members of one class; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, local_roots, stored, stream_groups

THRESHOLD, RECALL = 0.93, 0.999
#: Rows that codebooks are fitted on, vectors of a cell on average, most codewords of a half, rows of a block, lengths with a grid.
SAMPLE, CELL, WORDS, BLOCK, WIDTHS = 8192, 200, 256, 4096, 4


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]).argmin(1)
        for j in range(len(c)):
            if (own := near == j).any():
                c[j] = x[own].mean(0)
    return c


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square is lost
    return x / np.sqrt((x * x).sum(1))[:, None]


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row and without matrix products, so that a sum does not depend on what it is computed with."""
    d = x - c
    return (d * d).sum(-1)


def words_for(rows: int, cell: int = CELL, most: int = WORDS) -> int:
    """Codewords of a half: a power of two whose square gives cells of about `cell` rows."""
    return int(min(most, max(2, 2 ** round(np.log2(max(1, rows / cell)) / 2))))


class MultiIndex:
    def __init__(self, sample: np.ndarray, words: int, threshold: float, recall: float, seed: int = 3):
        self.dim = sample.shape[1]
        self.half = max(1, self.dim // 2)
        unit = units(sample)
        self.books = [kmeans(unit[:, : self.half], words, seed), kmeans(unit[:, self.half :], words, seed + 1) if self.dim > 1 else np.zeros((1, 0))]
        self.excess = np.inf
        rng = np.random.default_rng(seed)
        gaps = []
        for _ in range(max(1, 4096 // len(unit))):
            side = rng.normal(size=unit.shape)
            side -= (side * unit).sum(1)[:, None] * unit
            side /= np.maximum(np.linalg.norm(side, axis=1), 1e-12)[:, None]
            other = units(threshold * unit + np.sqrt(1 - threshold**2) * side)
            (home, least), (home2, least2) = self.homes(unit), self.homes(other)
            gaps.append(np.minimum(self.distance(unit, home2) - least, self.distance(other, home) - least2))
        self.excess = float(np.quantile(np.concatenate(gaps), recall)) + 1e-9

    def halves(self, unit: np.ndarray) -> list[np.ndarray]:
        return [_squares(x[:, None, :], c[None]) for x, c in zip((unit[:, : self.half], unit[:, self.half :]), self.books)]

    def homes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest cell and its distance."""
        cells, least = np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for i in range(0, len(unit), 256):
            a, b = self.halves(unit[i : i + 256])
            cells[i : i + 256] = a.argmin(1) * b.shape[1] + b.argmin(1)
            least[i : i + 256] = a.min(1) + b.min(1)
        return cells, least

    def distance(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        wide = len(self.books[1])
        return _squares(unit[:, : self.half], self.books[0][cell // wide]) + _squares(unit[:, self.half :], self.books[1][cell % wide])

    def visits(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(nearest cell, farthest distance that is visited, visited cells in the order of the traversal) of each vector."""
        a, b = self.halves(unit)
        n, (high, wide) = len(unit), (a.shape[1], b.shape[1])
        by_a, by_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        a, b = np.take_along_axis(a, by_a, 1), np.take_along_axis(b, by_b, 1)
        reach = a[:, 0] + b[:, 0] + self.excess
        nxt = np.zeros((n, high), np.int64)  # of each codeword of the first half, how many of the second were visited with it
        cost = np.full((n, high), np.inf)
        cost[:, 0] = a[:, 0] + b[:, 0]
        live, out = np.arange(n), []
        while len(live):
            r = np.arange(len(live))
            i = cost.argmin(1)
            go = cost[r, i] <= reach[live]
            if not go.all():
                live, cost, nxt, i, r = live[go], cost[go], nxt[go], i[go], r[: int(go.sum())]
                if not len(live):
                    break
            j = nxt[r, i]
            out.append((live, by_a[live, i] * wide + by_b[live, j]))
            nxt[r, i] = j + 1
            above = np.where(i > 0, nxt[r, i - 1], wide + 1)
            ok = (j + 1 < wide) & (above > j + 1)
            cost[r, i] = np.where(ok, a[live, i] + b[live, np.minimum(j + 1, wide - 1)], np.inf)
            k = np.minimum(i + 1, high - 1)
            free = (i + 1 < high) & (nxt[r, k] == j)  # the next codeword waited for this very cell
            cost[r[free], k[free]] = a[live[free], k[free]] + b[live[free], j[free]]
        who, cell = np.concatenate([w for w, _ in out]), np.concatenate([c for _, c in out])
        order = np.argsort(who, kind="stable")
        cells = np.split(cell[order], np.cumsum(np.bincount(who, minlength=n))[:-1])
        return np.array([c[0] for c in cells]), reach, cells


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _visitor(shared, wide: bool):
    kind = np.float64 if wide else np.float32
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("size", pa.int64()), ("width", pa.int32()), ("home", pa.int32()), ("reach", pa.float64()), ("vec", pa.binary()), ("cells", pa.list_(pa.int32()))])

    def run(batches):
        indexes = shared.value
        for batch in batches:
            flat, width = _numbers(batch.column(3))
            at = np.cumsum(width) - width
            for w in np.unique(width).tolist():
                rows = np.flatnonzero(width == w)
                for a in range(0, len(rows), 256):
                    own = rows[a : a + 256]
                    x = flat[at[own][:, None] + np.arange(w)]
                    if w in indexes:
                        home, reach, cells = indexes[w].visits(units(x.astype(np.float64)))
                    else:
                        home, reach, cells = np.zeros(len(own), int), np.full(len(own), np.inf), [np.zeros(1, int)] * len(own)
                    take = pa.array(own)
                    vec = pa.array([v.tobytes() for v in x.astype(kind)], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(3)), pa.array(np.full(len(own), w, np.int32)), pa.array(home.astype(np.int32)), pa.array(reach), vec, pa.array([c.astype(np.int32) for c in cells], schema.types[7])], schema=schema)

    return run


class _Members:
    """Vectors that visit a cell, with those filed in it first."""

    def __init__(self, ids, size, home, reach, x, cell):
        filed = home == cell
        order = np.argsort(~filed, kind="stable")
        self.ids, self.size, self.home, self.reach, self.x = (v[order] for v in (ids, size, home, reach, x))
        self.filed, self.cell = int(filed.sum()), cell

    def pack(self) -> bytes:
        head = np.array([len(self.ids), self.x.shape[1], self.cell], np.int64)
        return b"".join(v.tobytes() for v in (head, self.ids, self.size, self.home.astype(np.int64), self.reach, self.x))

    @staticmethod
    def unpack(raw: bytes) -> _Members:
        n, w, cell = np.frombuffer(raw, np.int64, 3).tolist()
        ids, size, home = np.frombuffer(raw, np.int64, 3 * n, 24).reshape(3, n)
        reach = np.frombuffer(raw, np.float64, n, 24 * (n + 1))
        return _Members(ids, size, home, reach, np.frombuffer(raw, np.float64, n * w, 24 * (n + 1) + 8 * n).reshape(n, w), cell)


def _links(visitors: _Members, filed: _Members, index: MultiIndex | None, threshold: float) -> list[tuple[np.ndarray, ...]]:
    """(ids, links, roots): a pair counts for the visitor, and for the filed one too unless that visits the visitor's cell."""
    if not filed.filed:
        return []
    v_all, h_all = visitors.x, filed.x[: filed.filed]
    out = []
    for a in range(0, len(v_all), 1024):
        x = v_all[a : a + 1024]
        cos = x @ h_all.T
        v, h = np.nonzero(cos >= threshold - 1e-9)
        exact = (x[v] * h_all[h]).sum(-1)  # the same from both sides
        keep = (exact >= threshold) & (visitors.ids[a + v] != filed.ids[h])
        v, h = a + v[keep], h[keep]
        if not len(v):
            continue
        ids = np.concatenate([visitors.ids[v], filed.ids[h]])
        weight = np.concatenate([filed.size[h], visitors.size[v]])
        sees = np.ones(len(v), bool) if index is None else index.distance(h_all[h], visitors.home[v]) <= filed.reach[h]
        weight[len(v) :][sees] = 0
        node, rank = np.unique(ids, return_inverse=True)
        root = local_roots(len(node), rank[: len(v)], rank[len(v) :])
        out.append((node, np.bincount(rank, weight, len(node)).astype(np.int64), node[root]))
    return out


_FOUND = [("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]


def _inside(shared, threshold: float, wide: bool):
    kind = np.float64 if wide else np.float32
    schema = pa.schema([*_FOUND, ("label", pa.string()), ("width", pa.int32()), ("cell", pa.int32()), ("blk", pa.int32()), ("g", pa.int32()), ("pack", pa.binary())])

    def run(batches):
        indexes = shared.value
        for _, t in stream_groups(batches, ["label", "width", "cell", "blk"]):
            w, cell, g = (t.column(c)[0].as_py() for c in ("width", "cell", "g"))
            x = units(np.frombuffer(b"".join(t.column("vec").to_pylist()), kind).reshape(-1, w).astype(np.float64))
            own = _Members(*(t.column(c).to_numpy() for c in ("id", "size", "home", "reach")), x, cell)
            for ids, links, roots in _links(own, own, indexes.get(w), threshold):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(roots), *(pa.nulls(len(ids), k) for k in schema.types[3:])], schema=schema)
            if g > 1:
                row = [None, None, None, *(t.column(c)[0].as_py() for c in ("label", "width", "cell", "blk", "g")), own.pack()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, schema.types)], schema=schema)

    return run


def _between(shared, threshold: float):
    schema = pa.schema(_FOUND)

    def run(batches):
        indexes = shared.value
        for (_, w, _, _, _), t in stream_groups(batches, ["label", "width", "cell", "a", "b"]):
            if t.num_rows == 2:
                one, two = (_Members.unpack(p.as_py()) for p in t.column("pack"))
                for ids, links, roots in _links(one, two, indexes.get(int(w)), threshold) + _links(two, one, indexes.get(int(w)), threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(roots)], schema=schema)

    return run


def near_vectors(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, recall: float = RECALL, words: int | None = None, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row."""
    spark = rows.sparkSession
    wide = rows.schema[vector_col].dataType.simpleString() != "array<float>"
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>" if wide else "array<float>").alias("embedding"), F.col(label_col).cast("string").alias("label"))
    fit = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    base = base.withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64("embedding", F.lit(1)), "fit": F.coalesce(fit, F.lit(False)) & F.col("id").isNotNull() & F.col("label").isNotNull()})
    classes = stored(base.where("fit").groupBy("label", "k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("size"), F.first("embedding").alias("embedding")), "vectors")
    indexes = {}
    for w, n in classes.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").limit(WIDTHS).collect():
        if n > block or not indexes:
            got = classes.where(F.size("embedding") == w).orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").collect()
            indexes[w] = MultiIndex(np.array([r.embedding for r in got], np.float64), words or words_for(n), threshold, recall)
    shared = spark.sparkContext.broadcast(indexes)
    visits = classes.select("id", "label", "size", "embedding").mapInArrow(_visitor(shared, wide), "id long, label string, size long, width int, home int, reach double, vec binary, cells array<int>")
    visits = stored(visits, "visits")
    keys = ["label", "width", "cell"]
    grid = visits.select("label", "width", F.explode("cells").alias("cell")).groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("g"))
    hot = grid.where("g > 1")
    seen = visits.withColumn("cell", F.explode("cells")).drop("cells").join(hot, keys, "left").withColumn("g", F.coalesce("g", F.lit(1))).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("g")).cast("int"))
    met = seen.repartition(*keys, "blk").sortWithinPartitions(*keys, "blk", "id")
    inside = stored(met.mapInArrow(_inside(shared, threshold, wide), "id long, links long, root long, label string, width int, cell int, blk int, g int, pack binary"), "vector-links")
    packed = inside.where("pack is not null").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).where("o <> blk").select(*keys, F.least("blk", "o").alias("a"), F.greatest("blk", "o").alias("b"), "blk", "pack")
    between = packed.repartition(*keys, "a", "b").sortWithinPartitions(*keys, "a", "b", "blk").mapInArrow(_between(shared, threshold), "id long, links long, root long")
    found = stored(inside.where("pack is null").select("id", "links", "root").unionByName(between), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    per = classes.select("label", "k1", "k2", F.col("id").alias("class_id"), "size").join(links.withColumnRenamed("id", "class_id"), "class_id", "left").join(comp.withColumnRenamed("node", "class_id"), "class_id", "left")
    out = base.drop("embedding").join(per, ["label", "k1", "k2"], "left")
    linked = F.col("fit") & F.col("class_id").isNotNull()
    return out.select(
        F.col("id").alias("vec_id"),
        F.when(linked, F.coalesce("links", F.lit(0)) + F.col("size") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(linked, F.coalesce("component", "class_id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
