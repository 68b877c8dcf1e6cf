"""Benchmark decontamination: windows of benchmark words against every window of the training texts.

Windows of the benchmark form hash tables that are broadcast in blocks of bounded size; each block scans the texts once,
and every hit is verified word by word. Words: A-Z in lower case, then longest runs of letters, digits and characters
beyond ASCII.

Defined cases: a null or empty text has no words (no hits, not contaminated); an item without words has no window; an
item of fewer words than a window is one window; repeated rows are judged one by one; an empty benchmark finds nothing;
other columns of the inputs are not looked at, whatever their names; a null item id is not used.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, lowered, passes, scan_words, stored, text_buffer

WINDOW = 13
#: Words of the benchmark that one broadcast table holds at most; further items go to further tables and scans.
BLOCK_WORDS = 2_000_000
_NONE = hashlib.sha256(b"").hexdigest()


def window_table(items: list[tuple[str, str]], window: int) -> dict[int, dict]:
    """{words in the window: sorted hashes, a bitmap of their top bits, the windows' words and the items of each}."""
    by: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        s, e, _, _ = scan_words(raw, np.array([0, len(raw)]))
        low = lowered(raw)
        words = [low[a:b] for a, b in zip(s, e)]
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            by.setdefault(n, {}).setdefault(tuple(words[i : i + n]), set()).add(item)
    out = {}
    for n, found in by.items():
        grams = list(found)
        flat = b" ".join(w for g in grams for w in g)
        raw = np.frombuffer(flat, np.uint8)
        h = gram_hashes(scan_words(raw, np.array([0, len(raw)]))[2], n)[::n]
        order = np.argsort(h, kind="stable")
        bitmap = np.zeros(1 << 20, bool)
        bitmap[h >> np.uint64(44)] = True
        out[n] = {"hash": h[order], "bitmap": bitmap, "words": [grams[i] for i in order], "items": [sorted(found[grams[i]]) for i in order]}
    return out


def find_hits(data: np.ndarray, offsets: np.ndarray, tables: dict[int, dict]) -> list[tuple[int, list, list]]:
    """For each text: (words, hit runs [first, end) of words, items)."""
    s, e, h, at = scan_words(data, offsets)
    runs: dict[int, list] = {}
    items: dict[int, set] = {}
    for n, t in tables.items():
        g = gram_hashes(h, n)
        for i in np.flatnonzero(t["bitmap"][g >> np.uint64(44)]).tolist():
            k = int(np.searchsorted(t["hash"], g[i], "left"))
            if k == len(t["hash"]) or t["hash"][k] != g[i]:
                continue
            d = int(np.searchsorted(at, i, "right")) - 1
            if i + n > at[d + 1]:
                continue
            own = tuple(lowered(data[s[j] : e[j]]) for j in range(i, i + n))
            while k < len(t["hash"]) and t["hash"][k] == g[i]:
                if t["words"][k] == own:
                    runs.setdefault(d, []).append((i - int(at[d]), i - int(at[d]) + n))
                    items.setdefault(d, set()).update(t["items"][k])
                    break
                k += 1
    counts = np.diff(at)
    return [(int(counts[d]), _joined(runs.get(d, ())), sorted(items.get(d, ()))) for d in range(len(offsets) - 1)]


def _joined(runs) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _scanner(shared, id_type: pa.DataType, numbered: bool):
    schema = pa.schema([("doc_id", id_type), ("n_words", pa.int64()), ("runs", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))] + [("row", pa.int64())] * numbered)

    def scan(batches):
        tables = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in passes(offsets):
                found = find_hits(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tables)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array([f[k] for f in found], schema.field(k + 1).type) for k in range(3)), *(c.slice(i, j - i) for c in batch.columns[2:])], schema=schema)

    return scan


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> list[list[tuple[str, str]]]:
    """Items in blocks whose size is checked before they are taken to the driver, one block after another."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (6 * block_words)))
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        yield [(r.item, r.text) for r in part.toLocalIterator()]


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, items) for each row of docs; runs are the maximal hit runs [first, end) of word numbers.

    With one block (a benchmark of up to some 12 MB) this is a map over the texts. With more, the rows are stored with
    a number, by which their runs are united; blocks are broadcast, scanned for and released one after another.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    id_type = pa.int64() if kind.typeName() in ("long", "integer", "short") else pa.string()
    base = docs.select(F.col(id_col).cast("long" if id_type == pa.int64() else "string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {'long' if id_type == pa.int64() else 'string'}, n_words long, runs array<array<long>>, items array<string>"
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_words)
    first, second = next(blocks), next(blocks, None)
    shared = spark.sparkContext.broadcast(window_table(first, window))
    if second is None:
        return base.mapInArrow(_scanner(shared, id_type, False), schema)
    base = stored(base.withColumn("row", F.monotonically_increasing_id()), "numbered")  # the same rows must meet again
    united = None
    for items in chain([first, second], blocks):  # one block's items and table are held at a time
        shared = spark.sparkContext.broadcast(window_table(items, window))
        found = stored(base.mapInArrow(_scanner(shared, id_type, True), schema + ", row long"), "block-hits")
        shared.destroy()
        united = found if united is None else united.unionByName(found)
    merged = united.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("row")
    step = "aggregate(runs, cast(array() as array<array<long>>), (a, r) -> if(size(a) > 0 and r[0] <= element_at(a, -1)[1], concat(slice(a, 1, size(a) - 1), array(array(element_at(a, -1)[0], greatest(element_at(a, -1)[1], r[1])))), concat(a, array(r))))"
    return merged.withColumn("runs", F.expr(step))


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """Adds n_hit, n_items, items_sha256 and contaminated (a hit, and hits are at least 1/share of the words)."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r[1] - r[0])
    sha = F.when(F.size("items") == 0, F.lit(_NONE)).otherwise(F.sha2(F.concat_ws(",", F.array_sort("items")), 256))
    return found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long"), "items_sha256": sha}).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Docs without the contaminated ones, in their own columns; null ids are kept as they can't be told apart."""
    bad = judged(contamination(docs, benchmark, **options)).where("contaminated").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, docs[options.get("id_col", "doc_id")] == bad["__bad"], "left_anti")


def without_spans(text: str, runs: list[list[int]]) -> str:
    """The text with the hit words, and what lies between them, cut out."""
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _, _ = scan_words(raw, np.array([0, len(raw)]))
    keep, at, whole = [], 0, raw.tobytes()
    for a, b in runs:
        keep.append(whole[at : s[a]])
        at = int(e[b - 1])
    return b"".join([*keep, whole[at:]]).decode()
