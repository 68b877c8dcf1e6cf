"""Token ids in directly addressable codes: chunk levels, continuation bitmaps and rank directories.

An id is split into chunks of `bits` bits, lowest first. Level k holds the k-th chunks of the ids that reach it; its
bitmap says which of them go on, and a directory of set bits before each block of 512 gives the place in the next level.
Token i is found in one step per level, without decoding what lies around it.

Files are plain bytes in the shared folder: segments one after another, each ended by a line break, in ascending order of
documents over the files' names. A segment holds its place, its documents' ids and ends, and the codes, all at places that
its head gives, so a token is read from a file by its place: its chunk, its bitmap block and its rank on each level.

Defined cases: a null or empty text has only the end id; documents with equal ids follow one another by a hash of their
texts, then by text; null ids come first; an empty table gives no segments; a text that holds a special token's string
has that token's id, as the library gives by default.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _BYTE, U64, mixed, passes, powers, scratch_path, stored, text_buffer

MAGIC, BLOCK = b"ADAC2\n", 512
END_ID = 2
#: Ids that a segment holds before it is closed at a document's end, and segments of a file.
SEGMENT_IDS, FILE_SEGMENTS = 1 << 18, 16
_HEAD = struct.Struct("<QIIIBBI")  # bytes, part, number, documents, bits, levels, ids


def encode_ids(ids: np.ndarray, bits: int = 8, docs: list = (), ends: Iterable[int] = (), part: int = 0, number: int = 0) -> bytes:
    """A segment of ids (unsigned, below 2^32): head, documents, then for each level chunks, bitmap, directory."""
    rest = np.ascontiguousarray(ids, np.uint32)
    levels = []
    kind, mask = (np.uint8, 255) if bits == 8 else (np.uint16, 65535)
    while True:
        more = rest >> np.uint32(bits) if bits < 32 else np.zeros_like(rest)
        go = more > 0
        bitmap = np.packbits(go, bitorder="little")
        blocks = -(-len(rest) // BLOCK)
        sums = np.add.reduceat(go, np.arange(0, len(go), BLOCK), dtype=np.uint32) if len(go) else np.zeros(0, np.uint32)
        rank = np.concatenate([[0], np.cumsum(sums)[:-1]]).astype("<u4") if blocks else np.zeros(0, "<u4")
        levels.append(((rest & np.uint32(mask)).astype(kind).tobytes(), bitmap.tobytes(), rank.tobytes(), len(rest)))
        rest = more[go]
        if not len(rest):
            break
    named = np.array([d is not None for d in docs], np.uint8).tobytes()
    own = np.array([d or 0 for d in docs], "<i8").tobytes() + np.array(ends, "<u4").tobytes() + named
    body = b"".join(struct.pack("<I", n) for *_, n in levels) + own + b"".join(c + b + r for c, b, r, _ in levels)
    return MAGIC + _HEAD.pack(len(MAGIC) + _HEAD.size + len(body), part, number, len(docs), bits, len(levels), len(rest := ids)) + body


class Segment:
    """A view of a segment through read(place, bytes); nothing but what is asked for is read."""

    def __init__(self, source: bytes | Callable[[int, int], bytes]):
        self.read = read = source if callable(source) else lambda at, n: source[at : at + n]
        fixed = len(MAGIC) + _HEAD.size
        head = read(0, fixed)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a segment of token ids")
        self.size, self.part, self.number, self.n_docs, self.bits, count, self.n = _HEAD.unpack(head[len(MAGIC) :])
        self.kind, self.wide = ("u1", 1) if self.bits == 8 else ("<u2", 2)
        self.docs_at = at = fixed + 4 * count
        at += 13 * self.n_docs
        self.levels = []
        for n in struct.unpack(f"<{count}I", read(fixed, 4 * count)):
            bitmap = at + n * self.wide
            rank = bitmap + -(-n // 8)
            self.levels.append((n, at, bitmap, rank))
            at = rank + 4 * -(-n // BLOCK)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Token i, by one rank per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (_, chunks, bitmap, rank) in enumerate(self.levels):
            value |= int.from_bytes(self.read(chunks + i * self.wide, self.wide), "little") << (k * self.bits)
            block, inside = divmod(i, BLOCK)
            bits = int.from_bytes(self.read(bitmap + block * BLOCK // 8, inside // 8 + 1), "little")
            if not bits >> inside & 1:
                break
            i = int.from_bytes(self.read(rank + 4 * block, 4), "little") + (bits & (1 << inside) - 1).bit_count()
        return value

    def document(self, k: int) -> tuple[int | None, int, int]:
        """(id, first token, end) of the segment's document number k."""
        n, at = self.n_docs, self.docs_at
        ends = struct.unpack("<2I", b"\0" * 4 + self.read(at + 8 * n, 4) if k == 0 else self.read(at + 8 * n + 4 * (k - 1), 8))
        doc = struct.unpack("<q", self.read(at + 8 * k, 8))[0] if self.read(at + 12 * n + k, 1) == b"\1" else None
        return doc, *ends

    def find(self, doc: int) -> list[int]:
        """Numbers of the documents with this id, by bisection; those without an id stand first."""
        rank = lambda k: -(2**63) - 1 if (d := self.document(k)[0]) is None else d
        low, high = 0, self.n_docs
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if rank(middle) < doc else (low, middle)
        out = []
        while low < self.n_docs and self.document(low)[0] == doc:
            out.append(low)
            low += 1
        return out

    def documents(self) -> tuple[list, np.ndarray]:
        n, at = self.n_docs, self.docs_at
        ids = pa.array(np.frombuffer(self.read(at, 8 * n), "<i8"), mask=np.frombuffer(self.read(at + 12 * n, n), np.uint8) == 0)
        return ids, np.frombuffer(self.read(at + 8 * n, 4 * n), "<u4").astype(np.int64)

    def all(self) -> np.ndarray:
        """All ids in order, level by level from the last."""
        out = np.zeros(0, np.uint32)
        for n, chunks, bitmap, _ in reversed(self.levels):
            here = np.frombuffer(self.read(chunks, n * self.wide), self.kind).astype(np.uint32)
            go = np.unpackbits(np.frombuffer(self.read(bitmap, -(-n // 8)), np.uint8), bitorder="little", count=n).view(bool)
            here[go] |= out << np.uint32(self.bits)
            out = here
        return out


_BYTE2 = np.random.default_rng(20240608).integers(1, 2**63, 256, dtype=U64) | U64(1)


class CachedEncoder:
    """Ids of whole texts by the tokenizers library.

    Where single spaces and line breaks are the only white space, pre-tokens never reach over a space or a line break, so the
    library encodes each distinct piece once, many in one call, and texts are put together from these: pieces are found by
    128 bits of hashes in an open table. Other texts, and those with a special token's string or a piece above LONGEST bytes, go to the
    library whole. The table is emptied when it is full.
    """

    LONGEST = 1000

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [str(t.content).encode() for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id: a letter of the vocabulary is a byte
        for piece, i in vocab.items():
            self.width[i] = len(piece)
        self.most = most
        self.other = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
        #: Bytes that are, or that begin, white space other than space and line break.
        self.suspect = np.zeros(256, bool)
        self.suspect[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True
        self.clear(1 << 16)

    def clear(self, size: int) -> None:
        self.n, self.used = 0, 0
        self.slots = np.full(size, -1, np.int32)
        self.one, self.two, self.at, self.count = np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int32), np.zeros(0, np.int16)
        self.ids = np.zeros(1 << 16, "<u4")

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, together: int = 4000) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, number of ids) of pieces: many in one call, each behind another where it begins with its space, else on lines of their own.

        The ids' lengths in bytes tell where each piece ends; where they do not, the library has the pieces one by one.
        """
        count, size = np.zeros(len(starts), np.int64), ends - starts
        led = data[starts] == 32
        lone = (size == 1) & (led | (data[starts] == 10))
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def singly(own: np.ndarray) -> None:
            got = self.whole([data[s:e].tobytes().decode() for s, e in zip(starts[own].tolist(), ends[own].tolist())])
            count[own] = [len(g) for g in got]
            held.append((own, np.concatenate(got) if got else np.zeros(0, "<u4")))

        for group, gap in ((np.flatnonzero(led & ~lone), 0), (np.flatnonzero(~led & ~lone), 1)):
            for a in range(0, len(group), together):
                own = group[a : a + together]
                wide = size[own] + gap
                goal = np.cumsum(wide)
                at = np.repeat(starts[own] - goal + wide, wide) + np.arange(int(goal[-1]))
                text = data[np.minimum(at, len(data) - 1)]
                if gap:
                    text[goal - 1] = 10
                    text, goal = text[:-1], goal - 1
                ids = np.array(self.tok.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, "<u4")
                ends_at = np.cumsum(self.width[ids])
                last = np.searchsorted(ends_at, goal)
                if last[-1] != len(ids) - 1 or (ends_at[last] != goal).any():
                    singly(own)
                    continue
                first = np.concatenate([[0], last[:-1] + 1 + gap])
                count[own] = last + 1 - first
                if gap:
                    keep = np.ones(len(ids), bool)
                    keep[last[:-1] + 1] = False
                    ids = ids[keep]
                held.append((own, ids))
        singly(np.flatnonzero(lone))
        order = np.concatenate([o for o, _ in held])
        flat = np.concatenate([i for _, i in held])
        come = np.zeros(len(starts), np.int64)
        come[order] = np.cumsum(count[order]) - count[order]
        total = np.cumsum(count)
        return flat[np.repeat(come - total + count, count) + np.arange(int(total[-1]) if len(total) else 0)], count

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Numbers of known pieces; -1 for others."""
        mask = len(self.slots) - 1
        at = (one & U64(mask)).astype(np.int64)
        got = self.slots[at]
        out = np.full(len(one), -1, np.int64)
        todo = np.flatnonzero(got >= 0)
        while len(todo):
            g = got[todo]
            same = (self.one[g] == one[todo]) & (self.two[g] == two[todo])
            out[todo[same]] = g[same]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & mask
            got[todo] = self.slots[at[todo]]
            todo = todo[got[todo] >= 0]
        return out

    def _insert(self, first: int) -> None:
        mask = len(self.slots) - 1
        new = np.arange(first, self.n, dtype=np.int32)
        at = (self.one[first : self.n] & U64(mask)).astype(np.int64)
        while len(new):
            free = self.slots[at] < 0
            self.slots[at[free]] = new[free]
            left = self.slots[at] != new
            new, at = new[left], at[left] + 1 & mask

    def keep(self, one: np.ndarray, two: np.ndarray, flat: np.ndarray, count: np.ndarray) -> None:
        first = self.n
        self.n += len(one)
        if self.n > len(self.one):
            room = max(self.n, len(self.one) + (1 << 17)) - len(self.one)
            self.one, self.two, self.at, self.count = (np.concatenate([x, np.zeros(room, x.dtype)]) for x in (self.one, self.two, self.at, self.count))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(flat), 1 << 19), "<u4")])
        self.ids[self.used : self.used + len(flat)] = flat
        self.one[first : self.n], self.two[first : self.n] = one, two
        self.at[first : self.n], self.count[first : self.n] = self.used + np.cumsum(count) - count, count
        self.used += len(flat)
        while 2 * self.n > len(self.slots):
            self.slots, first = np.full(4 * len(self.slots), -1, np.int32), 0
        self._insert(first)

    def _odd(self, data: np.ndarray, offsets: np.ndarray, white: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Texts where white spaces meet or are others than spaces and line breaks, with special tokens or very long pieces."""
        n, raw = len(offsets) - 1, data.tobytes()
        odd = np.zeros(n, bool)
        row = lambda at: np.searchsorted(offsets, at, "right") - 1
        meet = np.flatnonzero(white[1:] & white[:-1])
        own = row(meet)
        odd[own[row(meet + 1) == own]] = True
        odd[row(starts[np.diff(np.append(starts, len(data))) > self.LONGEST])] = True
        unsure = np.zeros(n, bool)
        unsure[row(np.flatnonzero(self.suspect[data]))] = True
        tokens = [t for t in self.special if t in raw]
        for i in range(n) if tokens else np.flatnonzero(unsure & ~odd).tolist():
            text = raw[offsets[i] : offsets[i + 1]]
            odd[i] |= any(t in text for t in tokens) or bool(unsure[i]) and self.other.search(text.decode()) is not None
        return odd

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of the texts that lie one after another as UTF-8 in data."""
        if self.n > self.most:
            self.clear(1 << 16)
        n = len(offsets) - 1
        line = data == 10
        white = line | (data == 32)
        new = white.copy()
        new[1:] |= line[:-1]
        new[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(new)
        odd = self._odd(data, offsets, white, starts)
        own = np.searchsorted(offsets, starts, "right") - 1
        ends = np.append(starts[1:], len(data))
        plain = ~odd[own]
        starts, ends, own = starts[plain], ends[plain], own[plain]
        one, two = np.empty(len(starts), U64), np.empty(len(starts), U64)
        for a, b in passes(np.append(starts, ends[-1:]) if len(starts) else np.zeros(1, np.int64)):
            x, y = int(starts[a]), int(ends[b - 1])
            up, down = powers(y - x + 1)
            s, e = starts[a:b] - x, ends[a:b] - x
            for table, out in ((_BYTE, one), (_BYTE2, two)):
                total = np.zeros(y - x + 1, U64)
                np.cumsum(table[data[x:y]] * up[: y - x], out=total[1:])
                out[a:b] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        number = self.find(one, two)
        while len(missing := np.flatnonzero(number < 0)):
            _, first = np.unique(one[missing], return_index=True)
            first = np.sort(missing[first])
            self.keep(one[first], two[first], *self.learn(data, starts[first], ends[first]))
            number[missing] = self.find(one[missing], two[missing])
        count = self.count[number].astype(np.int64)
        to = np.cumsum(count)
        total = int(to[-1]) if len(to) else 0
        flat = self.ids[np.repeat(self.at[number] - to + count, count) + np.arange(total)]
        cuts = np.concatenate([[0], to])[np.searchsorted(own, np.arange(n + 1), "left")].tolist()
        out = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        some = np.flatnonzero(odd).tolist()
        if some:
            raw = data.tobytes()
            for i, ids in zip(some, self.whole([raw[offsets[i] : offsets[i + 1]].decode() for i in some])):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        data, offsets = text_buffer(pa.array(texts, pa.string()))
        return self.encode_all(data, offsets)


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str) -> CachedEncoder:
    """One for each worker process, so that later tasks find the pieces of earlier ones."""
    return CachedEncoder(path)


def _writer(path: str, end_id: int, bits: int, most: int):
    schema = pa.schema([("code", pa.binary())])

    def write(batches):
        from pyspark import TaskContext

        encoder, part, number = shared_encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4")
        docs, ends, held, n = [], [], [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([encode_ids(np.concatenate(held), bits, docs, ends, part, number)], pa.binary())], schema=schema)

        for batch in batches:
            names, (data, offsets) = batch.column(0), text_buffer(batch.column(1))
            for i, j in passes(offsets, 1 << 20):
                for doc, ids in zip(names.slice(i, j - i).to_pylist(), encoder.encode_all(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])):
                    held += (ids, end)
                    n += len(ids) + 1
                    docs.append(doc), ends.append(n)
                    if n >= most:
                        yield close()
                        number += 1
                        docs, ends, held, n = [], [], [], 0
        if docs:
            yield close()

    return write


def write_token_files(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, bits: int = 8, segment_ids: int = SEGMENT_IDS, file_segments: int = FILE_SEGMENTS, path: str | None = None) -> str:
    """Writes all texts' ids in ascending document order as plain files and returns their folder.

    Range partitioning keeps the order across tasks, also where many rows share an id or have none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    path = path or scratch_path(docs.sparkSession, "tokens")
    codes = ordered.mapInArrow(_writer(tokenizer_path, end_id, bits, segment_ids), "code binary")
    codes.select(F.col("code").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", file_segments).text(path)
    return path


def _segments(batches: Iterable[pa.RecordBatch]):
    """(path, place, part, number, documents, ids, first and last id) of each segment, from heads alone."""
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("part", pa.int64()), ("number", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64())])
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            raw, at, rows = content.as_buffer(), 0, []
            while at < raw.size:
                seg = Segment(lambda a, n, at=at: raw.slice(at + a, n).to_pybytes())
                rows.append((path.as_py(), at, seg.part, seg.number, seg.n_docs, seg.n, seg.document(0)[0], seg.document(seg.n_docs - 1)[0]))
                at += seg.size + 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * len(schema), schema.types)], schema=schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


class TokenFiles:
    """Tokens by document, or by place over all, read from the files by their places.

    The index has one row for each segment; a look-up takes the few that may hold the document.
    """

    def __init__(self, spark: SparkSession, path: str, index: DataFrame | None = None):
        self.spark, self.open = spark, {}
        self.index = token_index(spark, path) if index is None else index

    def _segment(self, row) -> Segment:
        if row.path not in self.open:
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(row.path)
            self.open[row.path] = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(where)
        stream = self.open[row.path]

        def read(at: int, n: int) -> bytes:
            stream.seek(row.place + at)
            return bytes(stream.readNBytes(n))

        return Segment(read)

    def token(self, doc: int, i: int) -> int:
        """Token i of the document; of the first one where ids repeat."""
        for row in self.index.where((F.col("last_doc") >= doc) & (F.coalesce("first_doc", F.lit(-(2**63))) <= doc)).orderBy("start").take(2):
            seg = self._segment(row)
            for k in seg.find(doc)[:1]:
                _, first, end = seg.document(k)
                if not 0 <= i < end - first:
                    raise IndexError(i)
                return seg[first + i]
        raise KeyError(doc)

    def at(self, place: int) -> int:
        """The token at a place over all files."""
        row = self.index.where((F.col("start") <= place) & (F.col("start") + F.col("n_ids") > place)).first()
        if row is None:
            raise IndexError(place)
        return self._segment(row)[place - row.start]

    def close(self) -> None:
        for stream in self.open.values():
            stream.close()
        self.open = {}


def _starts(segments: DataFrame) -> DataFrame:
    """Adds each segment's first place over all: sums within parts, and one window over one row per part."""
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("ids")).withColumn("part_start", F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).drop("ids")
    inner = F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")
    return segments.withColumn("inner", inner).join(parts, "part").withColumn("start", F.col("part_start") + F.col("inner")).drop("inner", "part_start")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(path, place, part, number, n_docs, n_ids, first_doc, last_doc, start) of each segment."""
    schema = "path string, place long, part long, number long, n_docs long, n_ids long, first_doc long, last_doc long"
    return _starts(_files(spark, path).mapInArrow(_segments, schema))


def _reader(batches: Iterable[pa.RecordBatch]):
    schema = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("n_ids", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for content in batch.column(1):
            raw, at = content.as_buffer(), 0
            while at < raw.size:
                seg = Segment(lambda a, n, at=at: raw.slice(at + a, n))
                docs, ends = seg.documents()
                ids, starts = seg.all().astype("<u4"), np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                one = lambda x: pa.array(np.full(len(docs), x))
                yield pa.RecordBatch.from_arrays([one(seg.part), one(seg.number), one(seg.n), docs, pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())], schema=schema)
                at += seg.size + 1


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files, which are read once."""
    read = stored(_files(spark, path).mapInArrow(_reader, "part long, number long, n_ids long, doc_id long, before long, n_tokens long, ids_crc32 long"), "token-rows")
    starts = _starts(read.where("before = 0").select("part", "number", "n_ids")).select("part", "number", "start")
    return read.drop("n_ids").join(starts, ["part", "number"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
