"""N-gram Jaccard join: MinHash banding, a shuffle on band hashes, and exact verification on full n-gram sets.

Bands and rows follow from the target recall at the threshold (1 - (1 - s^r)^b). Documents with the same words in the
same order are one class, a node of its own with the text of one of its rows, named by its smallest id. Buckets with the same members in several bands are verified
once; a pair is counted in the first band on which it agrees. A large bucket is cut into blocks, each verified where its
texts are and packed into one row of n-gram sets; these rows then meet pair by pair, so no task holds a whole hot group and
no text is shipped more than once for a bucket. Only counts per document and a spanning forest leave a task, never all pairs.
Exact link counts make the comparisons, not the rows of texts, grow with the square of a group of different near copies.

Defined cases: a document of fewer words than a shingle has one shingle, of all its words; a document without words
(null, empty) has none, links with nothing and is a class of its own; a null id is returned with no links and null ids;
an id that repeats is returned as often as it comes; further columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, gram_hashes, local_roots, mixed, passes, scan_words, stored, stream_groups, text_buffer

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Documents, and words of documents, in one block of a bucket.
BLOCK_DOCS, BLOCK_WORDS = 256, 300_000


def banding(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands for the recall stay within `most` hash values."""
    best = (1, 1)
    for rows in range(1, 33):
        bands = 1 if threshold >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    return gram_hashes(words, min(n, len(words))) if len(words) else words


def _order_hashes(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's shingles in their order."""
    place = np.arange(len(flat), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64)
    return np.add.reduceat(mixed(flat + place * np.uint64(0x9E3779B97F4A7C15)), first), np.add.reduceat(mixed(flat ^ (place * np.uint64(0xC2B2AE3D27D4EB4F))), first)


def _keyer(n: int):
    """Texts with the class that they are in."""
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("text", pa.string())])

    def key(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in passes(offsets):
                _, _, h, at = scan_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                count = np.diff(at)
                full = np.flatnonzero(count)
                grams = [shingles(h[at[d] : at[d + 1]], n) for d in full]
                d1, d2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                if grams:
                    size = np.array([len(g) for g in grams])
                    d1[full], d2[full] = _order_hashes(np.concatenate(grams), np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(count), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), batch.column(1).slice(i, j - i).cast(pa.string())], schema=schema)

    return key


def _signer(bands: int, rows: int, n: int, seed: int, numbered: bool = False):
    rng = np.random.default_rng(seed)
    xor, mul = rng.integers(0, 2**32, bands * rows, dtype=np.uint32), rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    fold = rng.integers(0, 2**63, (bands, rows), dtype=np.uint64) | np.uint64(1)
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64()))] + [("row", pa.int64())] * numbered)

    def sign(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in passes(offsets):
                _, _, h, at = scan_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                count = np.diff(at)
                full = np.flatnonzero(count)
                grams = [shingles(h[at[d] : at[d + 1]], n) for d in full]
                d1, d2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                keys = np.zeros((j - i, bands), np.uint64)
                if grams:
                    size = np.array([len(g) for g in grams])
                    first = np.concatenate([[0], np.cumsum(size)[:-1]])
                    flat = np.concatenate(grams)
                    low = (flat >> np.uint64(32)).astype(np.uint32)
                    mins = np.empty((len(full), bands * rows), np.uint64)
                    for k in range(bands * rows):
                        mins[:, k] = np.minimum.reduceat((low ^ xor[k]) * mul[k], first)
                    for b in range(bands):
                        keys[full, b] = mixed((mixed(mins[:, b * rows : (b + 1) * rows] + np.uint64(b << 32)) * fold[b]).sum(axis=1, dtype=np.uint64))
                    d1[full], d2[full] = _order_hashes(flat, first, size)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * bands, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(count), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), lists, *(c.slice(i, j - i) for c in batch.columns[2:])], schema=schema)

    return sign


def overlaps(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of sorted sets, from blocked products over the elements that two sets share."""
    n = len(sets)
    if n == 2:
        k = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), k], [k, len(sets[1])]], np.int64)
    who = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    first = np.concatenate([[True], flat[1:] != flat[:-1]])
    col = np.cumsum(first) - 1
    shared = np.bincount(col)[col] > 1
    who, col = who[shared], col[shared]
    out = np.zeros((n, n), np.float64)
    if len(col):
        col = np.concatenate([[0], np.cumsum(col[1:] != col[:-1])])
        for c in range(0, int(col[-1]) + 1, width):
            a, b = np.searchsorted(col, [c, c + width])
            m = np.zeros((n, min(width, int(col[-1]) + 1 - c)), np.float32)
            m[who[a:b], col[a:b] - c] = 1
            out += m @ m.T
    return out.astype(np.int64)


def _linked(left: np.ndarray, right: np.ndarray, bands: np.ndarray, band: int, node: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """(node, links, root) of the rows that have any of these pairs, of those that first agree on this band."""
    step = max(1, 4_000_000 // bands.shape[1])
    own = np.concatenate([np.argmax(bands[left[i : i + step]] == bands[right[i : i + step]], axis=1) == band for i in range(0, len(left), step)]) if len(left) else np.zeros(0, bool)
    left, right = left[own], right[own]
    order = np.argsort(node, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    got = np.zeros(len(node), np.int64)
    np.add.at(got, left, weight[right])
    np.add.at(got, right, weight[left])
    root = node[order][local_roots(len(node), rank[left], rank[right])[rank]]
    some = got > 0
    return node[some], got[some], root[some]


def _near(sets: list[np.ndarray], p: int, q: int) -> np.ndarray:
    size = np.array([len(s) for s in sets])
    both = overlaps(sets) if len(sets) > 1 else np.zeros((1, 1), np.int64)
    return np.triu(both * q >= p * (size[:, None] + size[None, :] - both), 1)


_LINKS = [("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]


def _inside(n: int, threshold: float):
    """Links inside each block; blocks of a bucket of several leave as one packed row each, too."""
    p, q = Fraction(str(threshold)).as_integer_ratio()
    schema = pa.schema([*_LINKS, ("key", pa.int64()), ("blk", pa.int32()), ("g", pa.int32()), ("pack", pa.binary())])

    def verify(batches):
        held: list[tuple] = []

        def out():
            rows = [np.concatenate(x) for x in zip(*held)]
            held.clear()
            return pa.RecordBatch.from_arrays([*map(pa.array, rows), *(pa.nulls(len(rows[0]), t) for t in schema.types[3:])], schema=schema)

        for _, t in stream_groups(batches, ["key", "blk"]):
            data, offsets = text_buffer(t.column("text"))
            _, _, h, at = scan_words(data, offsets)
            sets = [np.unique(shingles(h[at[d] : at[d + 1]], n)) for d in range(len(at) - 1)]
            bands = np.array(t.column("bands").combine_chunks().flatten()).reshape(len(sets), -1)
            node, weight, band = t.column("node").to_numpy(), t.column("size").to_numpy(), t.column("band")[0].as_py()
            left, right = np.nonzero(_near(sets, p, q))
            held.append(_linked(left, right, bands, band, node, weight))
            if sum(len(x[0]) for x in held) > 50_000:
                yield out()
            if (g := t.column("g")[0].as_py()) > 1:
                sizes = np.array([len(s) for s in sets], np.int64)
                pack = b"".join(x.astype(np.int64).tobytes() for x in (np.array([len(sets), bands.shape[1], band]), node, weight, bands.ravel(), sizes)) + np.concatenate(sets).tobytes()
                row = [None, None, None, t.column("key")[0].as_py(), t.column("blk")[0].as_py(), g, pack]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, schema.types)], schema=schema)
        if held:
            yield out()

    return verify


def _unpacked(pack: bytes) -> tuple:
    x = np.frombuffer(pack, np.int64)
    n, wide, band = x[:3].tolist()
    cuts = np.cumsum([3, n, n, n * wide, n])
    node, weight, bands, sizes = (x[a:b] for a, b in zip(cuts, cuts[1:]))
    return node, weight, bands.reshape(n, wide), band, np.split(x[cuts[-1] :].view(np.uint64), np.cumsum(sizes)[:-1])


def _between(threshold: float):
    """Links between two blocks of a bucket."""
    p, q = Fraction(str(threshold)).as_integer_ratio()
    schema = pa.schema(_LINKS)

    def verify(batches):
        for _, t in stream_groups(batches, ["key", "a", "b"]):
            if t.num_rows < 2:  # no text fell into the other block
                continue
            one, two = (_unpacked(x.as_py()) for x in t.column("pack"))
            node, weight, bands = (np.concatenate([one[k], two[k]]) for k in range(3))
            near = _near(one[4] + two[4], p, q)
            left, right = np.nonzero(near[: len(one[4]), len(one[4]) :])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _linked(left, right + len(one[4]), bands, one[3], node, weight)], schema=schema)

    return verify


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = 5, block_docs: int = BLOCK_DOCS, block_words: int = BLOCK_WORDS, row_col: str | None = None) -> DataFrame:
    """(doc_id, class_id, class_size, n_links, component_id, kept[, row, component]) for each row.

    class_id: smallest id with the same words; n_links: other rows with similarity of the threshold or more, copies
    included; component_id: smallest id that links reach; kept: the row is its component's smallest id. With a column of
    row numbers these are returned, with the number of each row's component, null for a row without id or words.
    """
    bands, rows = banding(threshold, recall)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *([F.col(row_col).cast("long").alias("row")] if row_col else []))
    signed = stored(base.mapInArrow(_signer(bands, rows, shingle, seed, row_col is not None), "id long, n_words long, d1 long, d2 long, bands array<long>" + ", row long" * bool(row_col)), "signatures")
    live = signed.where("id is not null and n_words > 0")
    reps = stored(live.groupBy("n_words", "d1", "d2").agg(F.min_by("bands", "id").alias("bands"), F.min("id").alias("id"), F.count("*").alias("size")).withColumn("node", F.monotonically_increasing_id()), "representatives")
    spread = reps.select("node", "n_words", F.posexplode("bands").alias("band", "key"))
    buckets = (
        spread.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"), F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x2"), F.min("band").alias("band"))
        .where("n > 1")
        .groupBy("n", "words", "x1", "x2").agg(F.min_by("key", "band").alias("key"), F.min("band").alias("band"))
        .select("key", "band", F.greatest(F.ceil(F.col("n") / block_docs), F.ceil(F.col("words") / block_words), F.lit(1)).cast("int").alias("g"))
    )
    members = spread.drop("n_words", "band").join(buckets, "key").withColumn("blk", F.pmod(F.xxhash64("node", "key"), F.col("g")).cast("int"))
    needed = reps.select("id", "n_words", "d1", "d2", "node").join(members.select("node").distinct(), "node")
    keyed = base.where("id is not null").select("id", "text").mapInArrow(_keyer(shingle), "id long, n_words long, d1 long, d2 long, text string")
    texts = keyed.join(needed, ["id", "n_words", "d1", "d2"]).select("node", "text").dropDuplicates(["node"])
    rows_in = members.join(reps.select("node", "size", "bands"), "node").join(texts, "node")
    parts = rows_in.select("key", "blk", "g", "band", "node", "size", "bands", "text").repartition("key", "blk").sortWithinPartitions("key", "blk", "node")
    inside = stored(parts.mapInArrow(_inside(shingle, threshold), "node long, links long, root long, key long, blk int, g int, pack binary"), "links")
    packed = inside.where("pack is not null").select("key", "blk", "g", "pack")
    met = packed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).where("o <> blk").select("key", F.least("blk", "o").alias("a"), F.greatest("blk", "o").alias("b"), "blk", "pack")
    between = met.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "blk").mapInArrow(_between(threshold), "node long, links long, root long")
    found = stored(inside.where("pack is null").select("node", "links", "root").unionByName(between), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    comp = stored(comp.withColumnRenamed("component", "top").join(reps.select("node", "id"), "node"), "components")
    names = comp.groupBy("top").agg(F.min("id").alias("component"))
    classes = reps.select("n_words", "d1", "d2", "node", F.col("id").alias("class_id"), F.col("size").alias("class_size"))
    per = classes.join(linked, "node", "left").join(comp.drop("id").join(names, "top"), "node", "left")
    out = signed.drop("bands").alias("s").join(per, ["n_words", "d1", "d2"], "left")
    alone = F.col("n_words") == 0
    own = lambda c, other: F.when(F.col("id").isNull() | alone, other).otherwise(c)
    return out.select(
        F.col("id").alias("doc_id"),
        own(F.col("class_id"), F.col("id")).alias("class_id"),
        own(F.col("class_size"), F.lit(1)).cast("long").alias("class_size"),
        own(F.coalesce("links", F.lit(0)) + F.col("class_size") - 1, F.lit(0)).cast("long").alias("n_links"),
        own(F.coalesce("component", "class_id"), F.col("id")).alias("component_id"),
        *(["row", F.when(~alone & F.col("id").isNotNull(), F.coalesce("top", "node")).alias("component")] if row_col else []),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_rows(docs: DataFrame, row_col: str, **options) -> DataFrame:
    """(row) to keep: one of each component, of its smallest id, and all rows without id or words."""
    rows = stored(near_duplicates(docs, row_col=row_col, **options).where("kept").select("row", "component"), "kept")
    first = rows.where("component is not null").groupBy("component").agg(F.min("row").alias("row"))
    return first.select("row").unionByName(rows.where("component is null").select("row"))
