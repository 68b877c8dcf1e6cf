"""Shared pieces of the corpus operators: scratch tables, byte-level word scanning, grouped streams, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that one vectorised pass takes, so that its arrays stay in the processor's cache.
PASS_BYTES = 1 << 19


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names; a temporary folder only in a single process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="aerolith-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/aerolith/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored() table that nothing will read again."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/aerolith/" in folder:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def with_row_number(df: DataFrame, name: str) -> DataFrame:
    """Adds a number of each row that is the same in each scan: of its place in its file, or stored for other rows."""
    try:
        return df.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name))
    except AnalysisException:
        return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- bytes and words

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = True
_WORD[128:] = True
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=U64) | U64(1)
_P = U64(0x9E3779B97F4A7C15)
_PINV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = U64(0xD6E8FEB86659FD93)
_pow: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n."""
    if not _pow or len(_pow[0]) < n:
        size = max(n, PASS_BYTES + 1)
        up, down = np.full(size, _P), np.full(size, _PINV)
        up[0] = down[0] = 1
        _pow[:] = [np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)]
    return _pow[0], _pow[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x *= _Q
    x ^= x >> U64(29)
    x *= _P
    return x ^ (x >> U64(32))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n, bufs = len(column), column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(bufs[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def passes(offsets: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes each; a longer row has a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def scan_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts that lie one after another in data: (start, end, 64-bit hash, words before each text).

    A word is a longest run of 0-9, A-Z taken as a-z, and bytes from 128 on (all of UTF-8 beyond ASCII).
    """
    starts, ends, hashes = [], [], []
    n, at = len(data), 0
    cuts = offsets[1:-1]
    while at < n:
        to = min(n, at + PASS_BYTES)
        if to < n:  # not inside a word
            gap = np.flatnonzero(~_WORD[_LOWER[data[at:to]]])
            if len(gap):
                to = at + int(gap[-1]) + 1
            else:
                while to < n and _WORD[_LOWER[data[to]]]:
                    to += 1
        low = _LOWER[data[at:to]]
        word = _WORD[low]
        before, after = np.empty_like(word), np.empty_like(word)
        before[0], before[1:] = False, word[:-1]
        after[-1], after[:-1] = False, word[1:]
        inner = cuts[np.searchsorted(cuts, at, "right") : np.searchsorted(cuts, to, "left")] - at
        before[inner] = False
        after[inner - 1] = False
        s, e = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        up, down = powers(to - at + 1)
        total = np.zeros(to - at + 1, U64)
        np.cumsum(_BYTE[low] * up[: to - at], out=total[1:])
        hashes.append(mixed((total[e] - total[s]) * down[s]))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    s = np.concatenate(starts)
    return s, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(s, offsets, "left")


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = words[:m].copy()
    for j in range(1, n):
        out *= _P
        out += words[j : j + m]
    return mixed(out)


def lowered(data: np.ndarray) -> bytes:
    return _LOWER[data].tobytes()


# ---------------------------------------------------------------- grouped streams


def stream_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of consecutive rows with equal keys, from batches sorted by these keys; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            own = tuple(c[i] for c in columns)
            if key is not None and own != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(i, j - i))
    if held:
        yield key, pa.Table.from_batches(held)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For n items, the smallest item that links reach from each."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    return root


# ---------------------------------------------------------------- connected components


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u long, v long) to (node, component = smallest node reached), for each node of an edge.

    Alternating large-star and small-star rounds; minima are pre-aggregated, joins may be split by skew handling, and
    each round is a table in the shared folder, whose predecessor then goes. It ends when a round changes nothing, as it must: parents only
    become smaller. Loops and repeats are harmless.
    """
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        j = both.join(low, "u")
        if large:
            return j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        keep = j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return keep.unionByName(low.select("u", F.col("m").alias("v"))).distinct()

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))).first())

    was = digest(e)
    while was[0]:
        before, e = e, stored(star(star(e, True), False), "edges")
        now = digest(e)
        discard(before)
        if now == was:
            break
        was = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
