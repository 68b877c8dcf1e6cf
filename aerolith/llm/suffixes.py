"""Suffix-array dedup: long repeated byte strings through run-length indexes of positional Burrows-Wheeler transforms.

1. Anchors. In every window of WINDOW bytes the smallest hash of GRAM bytes marks an anchor, so equal windows share one.
   Anchors that occur once are dropped by a distributed count; only the contexts of the others, once for each distinct
   context, go to an index.
2. Index. Contexts that share an anchor are aligned at it, as equal windows share one. Their positional Burrows-Wheeler
   transform is run-compressed: each column is kept as runs with divergences sampled at the runs' ends. The contexts are then
   streamed through the runs, which gives for every context and end the longest match with any other context (its
   matching statistic); matches of WINDOW bytes or more are marked. A context that occurs twice, as told by its hash, matches itself.
3. Marks return to all occurrences and unite per document.

Hot anchors, with more than HOT places, are split by the hash of the part that all windows of a narrow range
of starts have in common, so that groups shrink and nothing is lost.

Defined cases: null is empty; a text below WINDOW bytes keeps all; rows that repeat an id share one document's marks, each
counts as an occurrence; matches never cross documents; a null id takes part in nothing and keeps its text; further
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, U64, mixed, passes, powers, stream_groups, text_buffer

WINDOW, GRAM = 200, 64
#: Places of one anchor from which it is split, the narrow ranges, and contexts indexed at a time.
HOT, RANGES, AT_ONCE = 20_000, 8, 12_000


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best over x[i : i + width] for each i that has it."""
    done = 1
    while done * 2 <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def anchors(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, place, hash, context hash) of the anchors of texts that lie one after another."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64))
    n, reach = len(data), window - gram + 1
    long = np.flatnonzero(np.diff(offsets) >= window)
    if not len(long):
        return empty
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    g = mixed((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    low = _sliding(g, reach, np.minimum)
    start, end = offsets[long], offsets[long + 1]
    flag = np.zeros(n + 1, np.int8)
    flag[start] += 1
    np.add.at(flag, end - window + 1, -1)
    valid = np.cumsum(flag[: len(low)], dtype=np.int8) > 0
    low[~valid] = 0
    pad = np.zeros(reach - 1, U64)
    high = _sliding(np.concatenate([pad, low, pad]), reach, np.maximum)
    at = np.flatnonzero(high[: len(g)] >= g)
    row = long[np.searchsorted(start, at, "right") - 1]
    first = np.maximum(offsets[row], at - (window - gram))
    last = np.minimum(offsets[row + 1], at + window)
    content = (total[last] - total[first]) * down[first]
    around = mixed(content ^ mixed((at - first).astype(U64) * U64(1000003) + (last - first).astype(U64)))
    return row, at - offsets[row], g[at], around


def _anchor_pass(window: int, gram: int):
    schema = pa.schema([("h", pa.int64()), ("ch", pa.int64()), ("doc", pa.int64()), ("pos", pa.int64())])

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in passes(offsets):
                row, pos, h, ch = anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, gram)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ch.view(np.int64)), pa.array(ids[i:j][row].astype(np.int64)), pa.array(pos.astype(np.int64))], schema=schema)

    return run


def _context_pass(window: int, gram: int, ranges: int):
    reach = window - gram + 1
    schema = pa.schema([("g", pa.int64()), ("h", pa.int64()), ("ch", pa.int64()), ("twice", pa.bool_()), ("pad", pa.int32()), ("c0", pa.int32()), ("c1", pa.int32()), ("bytes", pa.binary())])
    spans = [(a * reach // ranges, (a + 1) * reach // ranges) for a in range(ranges)]

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            raw, marks = data.tobytes(), batch.column(1)
            out: list[list] = [[] for _ in schema]
            for r in range(batch.num_rows):
                ds, de = int(offsets[r]), int(offsets[r + 1])
                for m in marks[r].as_py():
                    at = ds + m["pos"]
                    first, last = max(ds, at - reach + 1), min(de, at + window)
                    pad = reach - 1 - (at - first)
                    ctx = raw[first:last]
                    rows = [(m["h"], 0, reach, pad, ctx)]
                    if m["hot"]:
                        rows = []
                        for a, b in spans:  # windows that start in [a, b) all hold [b - 1, a + window)
                            if b - 1 >= pad and a + window <= pad + len(ctx):
                                key = hashlib.blake2b(ctx[b - 1 - pad : a + window - pad], digest_size=8, key=a.to_bytes(2, "big")).digest()
                                low = max(a, pad)  # rows of two ranges share less than a window, so a context never meets itself
                                rows.append((m["h"] ^ int.from_bytes(key, "big", signed=True), a, b, low, ctx[low - pad : b - 1 + window - pad]))
                    for g, a, b, low, part in rows:
                        for k, v in zip(out, (g, m["h"], m["ch"], m["cnt"] > 1, low, a, b, part)):
                            k.append(v)
                if len(out[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, schema.types)], schema=schema)
                    out = [[] for _ in schema]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, schema.types)], schema=schema)

    return run


def _between(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Largest of x[left : right] for each pair; -1 for empty ones."""
    out = np.full(len(left), -1, x.dtype)
    size = right - left
    level, table = 0, x
    while (todo := size > 0).any():
        here = np.flatnonzero(todo & (size < (2 << level)) & (size >= (1 << level)))
        if len(here):
            out[here] = np.maximum(table[left[here]], table[right[here] - (1 << level)])
        if not (size >= (2 << level)).any():
            break
        table = np.maximum(table[: -(1 << level)], table[1 << level :])
        level += 1
    return out


class RunLengthIndex:
    """The positional Burrows-Wheeler transform of aligned rows, kept as runs with samples at their ends.

    Of each column are kept, for each run: its first row, where that row goes in the next column, and two divergences there, of the run's first row
    from the row above and of the row below the run's last one. A divergence is the column from which two neighbours are equal.
    Inside of a run both neighbours go along, so their divergences stay; no order and no divergence of other rows is kept.
    """

    def __init__(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pads: np.ndarray, width: int):
        self.n, self.width, self.columns, self.runs = len(starts), width, [], 0
        order, since = np.arange(self.n, dtype=np.int32), np.zeros(self.n, np.int32)
        since[:1] = 1
        for k in range(width if self.n else 0):
            at = k - pads
            inside = (at >= 0) & (at < lengths)
            symbol = np.full(self.n, 256, np.uint16)  # 256 stands for places outside of a row
            symbol[inside] = raw[starts[inside] + at[inside]]
            symbol = symbol[order]
            head = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
            size = np.diff(np.append(head, self.n))
            most = np.maximum.reduceat(since, head)
            by = np.argsort(symbol[head], kind="stable")
            kind = symbol[head][by]
            same = np.flatnonzero(kind[1:] == kind[:-1])
            first, last = np.full(len(head), k + 1, np.int32), np.full(len(head), k + 1, np.int32)  # without another run of the symbol nothing matches
            run, before = by[same + 1], by[same]
            first[run] = np.maximum(_between(most, before + 1, run), since[head[run]])
            last[before] = first[run]
            to = np.empty(len(head), np.int64)
            to[by] = np.cumsum(size[by]) - size[by]
            self.columns.append((head.astype(np.int32), to.astype(np.int32), first, last))
            self.runs += len(head)
            since[head] = first
            place = np.repeat(to - head, size) + np.arange(self.n)
            moved, kept = np.empty_like(order), np.empty_like(since)
            moved[place], kept[place] = order, since
            order, since = moved, kept

    def matches(self, least: int) -> np.ndarray:
        """[row, c]: the row's `least` symbols from column c on also stand there in another row.

        The rows are streamed through the runs; a row's state is its place and the divergences from the rows above and below, so at each
        column the larger match is its matching statistic.
        """
        n = self.n
        found = np.zeros((n, max(0, self.width - least + 1)), bool)
        place, above, below = np.arange(n), np.zeros(n, np.int32), np.zeros(n, np.int32)
        above[:1] = below[-1:] = 1
        for k, (head, to, first, last) in enumerate(self.columns):
            end = np.append(head[1:], n) - 1
            run = np.repeat(np.arange(len(head)), end - head + 1)[place]
            above = np.where(place == head[run], first[run], above)
            below = np.where(place == end[run], last[run], below)
            place = to[run] + place - head[run]
            c = k + 1 - least
            if c >= 0:
                found[:, c] = np.minimum(above, below) <= c
        return found


def _index_pass(window: int, gram: int, at_once: int):
    reach = window - gram + 1
    width = reach - 1 + window
    schema = pa.schema([("h", pa.int64()), ("ch", pa.int64()), ("starts", pa.list_(pa.int32()))])

    def indexed(t: pa.Table) -> pa.RecordBatch | None:
        raw, offsets = text_buffer(t.column("bytes"))
        pad, length = t.column("pad").to_numpy(), np.diff(offsets)
        found = RunLengthIndex(raw, offsets[:-1], length, pad.astype(np.int64), width).matches(window)
        found |= t.column("twice").to_numpy()[:, None]
        c = np.arange(reach)
        low = np.maximum(pad, t.column("c0").to_numpy())
        high = np.minimum(pad + length - window, t.column("c1").to_numpy() - 1)
        found &= (c >= low[:, None]) & (c <= high[:, None])
        step = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, a = np.nonzero(step == 1)
        _, b = np.nonzero(step == -1)
        if not len(row):
            return None
        flat = np.stack([a - (reach - 1), b - 1 - (reach - 1)], 1).astype(np.int32).ravel()
        some, first = np.unique(row, return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first * 2, len(flat)).astype(np.int32)), pa.array(flat))
        return pa.RecordBatch.from_arrays([t.column("h").combine_chunks().take(pa.array(some)), t.column("ch").combine_chunks().take(pa.array(some)), lists], schema=schema)

    def run(batches):
        held, n = [], 0
        for _, t in stream_groups(batches, ["g"]):
            if held and n + t.num_rows > at_once:
                if (out := indexed(pa.concat_tables(held))) is not None:
                    yield out
                held, n = [], 0
            held.append(t)
            n += t.num_rows
        if held and (out := indexed(pa.concat_tables(held))) is not None:
            yield out

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Both joins with texts take these very columns and rows, so that one exchange serves both."""
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body")).where("doc is not null")


def repeated_starts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT, ranges: int = RANGES, at_once: int = AT_ONCE) -> DataFrame:
    """(doc, marks): for each document with repeats, pairs of first and last start of repeated windows, flattened."""
    texts = _texts(docs, id_col, text_col)
    found = texts.where(F.octet_length("body") >= window).mapInArrow(_anchor_pass(window, gram), "h long, ch long, doc long, pos long").where("h is not null and ch is not null and doc is not null")  # stated, so that all uses have one plan
    often = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    kept = found.join(often, "h")
    distinct = kept.groupBy("h", "ch").agg(F.count("*").alias("cnt"), F.min(F.struct("doc", "pos")).alias("at"), F.first("n").alias("n"))
    places = distinct.select(F.col("at.doc").alias("doc"), F.struct("h", "ch", F.col("at.pos").alias("pos"), "cnt", (F.col("n") > hot).alias("hot")).alias("m"))
    contexts = places.groupBy("doc").agg(F.collect_list("m").alias("marks")).join(texts, "doc").select("body", "marks").mapInArrow(_context_pass(window, gram, ranges), "g long, h long, ch long, twice boolean, pad int, c0 int, c1 int, bytes binary")
    index = contexts.repartition("g").sortWithinPartitions("g").mapInArrow(_index_pass(window, gram, at_once), "h long, ch long, starts array<int>")
    index = index.groupBy("h", "ch").agg(F.flatten(F.collect_list("starts")).alias("starts"))  # at most one row for each range of a hot anchor's context
    marks = kept.drop("n").join(index, ["h", "ch"]).select("doc", F.transform("starts", lambda x: x + F.col("pos").cast("int")).alias("starts"))
    return marks.groupBy("doc").agg(F.flatten(F.collect_list("starts")).alias("marks"))


def covered(marks: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal runs [first, end) of covered bytes."""
    pairs = np.array(marks, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    end = np.maximum.accumulate(pairs[:, 1] + window)
    new = np.concatenate([[True], pairs[1:, 0] > end[:-1]])
    first = np.flatnonzero(new)
    return list(zip(pairs[first, 0].tolist(), end[np.append(first[1:] - 1, len(end) - 1)].tolist()))


def cut(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, keep = 0, []
    for a, b in runs:
        keep.append(raw[at:a])
        at = b
    return b"".join([*keep, raw[at:]])


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the bytes of characters that they cut through."""
    out = []
    for a, b in runs:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _finish(window: int, digest: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] if digest else [("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, marks in zip(*(batch.column(k) for k in range(3))):
                raw = (text.as_py() or "").encode()
                runs = covered(marks.as_py(), window) if marks.is_valid else []
                if digest:
                    rows.append((doc.as_py(), len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(cut(raw, runs)).hexdigest()))
                else:
                    rows.append((doc.as_py(), cut(raw, whole_characters(raw, runs)).decode() if text.is_valid else None))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * len(schema), schema.types)], schema=schema)

    return run


def _with_marks(docs: DataFrame, id_col: str, text_col: str, options: dict) -> DataFrame:
    named = _texts(docs, id_col, text_col).join(repeated_starts(docs, id_col=id_col, text_col=text_col, **options), "doc", "left").select("doc", "body", "marks")
    unnamed = docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"), F.lit(None).cast("array<int>").alias("marks"))
    return named.unionByName(unnamed)


def dedup_digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""
    return _with_marks(docs, id_col, text_col, options).mapInArrow(_finish(options.get("window", WINDOW), True), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduped(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text) without the repeated bytes; characters that a run cuts through stay whole."""
    return _with_marks(docs, id_col, text_col, options).mapInArrow(_finish(options.get("window", WINDOW), False), "doc_id long, text string")
