"""SentencePiece encoding and decoding with seeded merge dropout.

The agenda of candidate merges is worked off by score, then place; a candidate whose hash, keyed by seed, document, place
of the word and places of its two parts, falls below the dropout rate is skipped. Pieces never reach past the white space
before a word, so words have agendas of their own. Many words are worked off at once: words of like length are columns
of arrays, and a step takes the best candidate of each column, merges it and draws for the two new candidates. Every
occurrence of a word draws for itself; nothing is kept from one text to the next. Runs of more than SHORT characters
without white space have a heap each.

All segmentations decode to the text, byte for byte: spaces become the model's mark, characters without a piece become
bytes, and a mark that stands in the text itself is written as bytes.

Defined cases: null and empty texts have no ids; rate 0 gives the model's own segmentation, rate 1 single characters;
rows that repeat an id have equal ids; a null id counts as 0 for the draw; further columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mixed, passes, text_buffer

MARK = "▁"
#: Longest word that is a column, words worked off at once, and a rank above all others.
SHORT, AT_ONCE, NONE = 48, 1 << 17, np.int32(2**31 - 1)
#: Symbols: ids of pieces, then, from the number of pieces on, characters that are no piece. The text's own mark has a number beyond Unicode.
_OWN_MARK, _WIDE = 0x110000, 21
_M64 = (1 << 64) - 1


def utf8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of bytes, [n, 4] bytes) of code points in UTF-8."""
    c = points.astype(np.uint32)
    size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
    out = np.zeros((len(c), 4), np.uint8)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)
    for j in range(4):
        shift = 6 * np.maximum(size - 1 - j, 0).astype(np.uint32)
        part = c >> shift
        out[:, j] = np.where(j == 0, part | lead[size], 0x80 | part & 0x3F)
    return size, out


class PieceCodec:
    def __init__(self, model: str, rate: float = 0.1, seed: int = 1):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.n, self.bytes, self.byte_id = sp.get_piece_size(), [], np.zeros(256, np.int32)
        pieces: dict[str, int] = {}
        for i in range(self.n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes.append(b"")
            else:
                if MARK in piece.lstrip(MARK) or len(piece) > 1 and "\n" in piece:
                    raise ValueError("the model has pieces across words")
                pieces[piece] = i
                self.bytes.append(piece.replace(MARK, " ").encode())
        self.letter = np.arange(self.n, self.n + _OWN_MARK + 1, dtype=np.int32)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.letter[ord(piece)] = i
        self.letter[32] = self.letter[ord(MARK)]
        self.pad = int(self.letter[-1]) + 1
        self.letter[ord(MARK)] = self.letter[_OWN_MARK]
        score = np.array([-sp.get_score(i) for i in range(self.n)])
        self.rank = np.unique(score, return_inverse=True)[1].astype(np.int32)
        symbol = lambda s: self.letter[32 if s == MARK else ord(s)] if len(s) == 1 else pieces.get(s, -1)
        pairs = {}
        for piece, i in pieces.items():
            for k in range(1, len(piece)):
                a, b = int(symbol(piece[:k])), int(symbol(piece[k:]))
                if a >= 0 and b >= 0:
                    pairs[a << _WIDE | b] = i
        self._place(pairs)
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.first = np.cumsum(self.width) - self.width
        self.limit, self.seed = int(rate * (1 << 64)), seed

    def _place(self, pairs: dict[int, int]) -> None:
        """An open hash table of pairs of symbols, at most an eighth full."""
        self.shift = 64 - max(10, (8 * len(pairs)).bit_length())
        size = 1 << (64 - self.shift)
        self.keys, self.values = np.full(size + 64, -1, np.int64), np.full(size + 64, -1, np.int32)
        keys, values = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            left = self.keys[at] != keys
            keys, values, at = keys[left], values[left], at[left] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(U64) * U64(0x9E3779B97F4A7C15) >> U64(self.shift)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols gives; -1 for none."""
        keys = left.astype(np.int64) << _WIDE | right
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], np.int32(-1))
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            at[todo] += 1
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out

    def skips(self, key: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merge of [left, middle) and [middle, right) is skipped, in the word whose key it is."""
        if self.limit > _M64:
            return np.ones(len(key), bool)
        place = left.astype(U64) << U64(42) | middle.astype(U64) << U64(21) | right.astype(U64)
        x = (key ^ place) * U64(0x9E3779B97F4A7C15)
        x = (x ^ x >> U64(32)) * U64(0xD6E8FEB86659FD93)
        return x ^ x >> U64(32) < U64(self.limit)

    def keys_of(self, doc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Keys of words by their document's number and their place in it."""
        return mixed(word.astype(U64) * U64(0x9E3779B97F4A7C15) + doc.astype(np.int64).view(U64) * U64(0xC2B2AE3D27D4EB4F) + U64(self.seed & _M64))

    def _candidates(self, key, left, right, i, j, k) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of pairs of neighbours that stand at i, j and end at k; skipped ones have no rank."""
        to = self.merged(left, right)
        rank = np.full(len(to), NONE, np.int32)
        hit = np.flatnonzero(to >= 0)
        if self.limit and len(hit):
            hit = hit[~self.skips(key[hit], i[hit], j[hit], k[hit])]
        rank[hit] = self.rank[to[hit]]
        return rank, to

    def _columns(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray, keys: np.ndarray, rows: int) -> None:
        """Works off the agendas of words of up to `rows` characters; symbols that were merged away become -1."""
        n = len(start)
        place = np.arange(1, rows + 1)[:, None]
        inside = place <= length
        sym = np.full((rows + 2, n), self.pad, np.int32)
        sym[1:-1][inside] = symbols[(start + place - 1)[inside]]
        column = np.arange(n)
        rank, to = np.full((rows + 2, n), NONE, np.int32), np.zeros((rows + 2, n), np.int32)
        row, col = np.nonzero(place < length)
        row += 1
        rank[row, col], to[row, col] = self._candidates(keys[col], sym[row, col], sym[row + 1, col], row - 1, row, row + 1)
        after = np.repeat(np.arange(1, rows + 3, dtype=np.int32)[:, None], n, 1)
        before = after - 2
        flat_sym, flat_to, flat_after, flat_before = (x.reshape(-1) for x in (sym, to, after, before))
        own = column
        while True:
            best, at = rank[1].copy(), np.ones(rank.shape[1], np.int64)
            for r in range(2, rows):
                less = rank[r] < best
                np.copyto(best, rank[r], where=less)
                at[less] = r
            live = best < NONE
            m = int(live.sum())
            if not m:
                break
            if m < len(live):
                rank, at, own = np.ascontiguousarray(rank[:, live]), at[live], own[live]
            here = np.arange(m)
            i = at * n + own
            j = flat_after[i]
            fj = j * n + own
            k = flat_after[fj]
            fk = k * n + own
            p = flat_before[i]
            fp = p * n + own
            got = flat_to[i]
            flat_sym[i] = got
            flat_sym[fj] = -1
            flat_after[i] = k
            flat_before[fk] = at
            rank[j, here] = NONE
            end = flat_after[np.minimum(fk, (rows + 1) * n + own)]
            key = keys[own]
            r, t = self._candidates(
                np.concatenate([key, key]), np.concatenate([flat_sym[fp], got]), np.concatenate([got, flat_sym[fk]]),
                np.concatenate([p - 1, at - 1]), np.concatenate([at - 1, k - 1]), np.concatenate([k - 1, end - 1]),
            )
            rank[p, here], rank[at, here] = r[:m], r[m:]
            flat_to[fp], flat_to[i] = t[:m], t[m:]
        symbols[(start + place - 1)[inside]] = sym[1:-1][inside]

    @functools.cached_property
    def table(self) -> dict[int, int]:
        there = self.keys >= 0
        return dict(zip(self.keys[there].tolist(), self.values[there].tolist()))

    def _heap(self, symbols: np.ndarray, key: np.uint64) -> None:
        """One word's agenda as a heap, for long runs without white space."""
        n = len(symbols)
        sym, end, prev = [*symbols.tolist(), self.pad], list(range(1, n + 1)), list(range(-1, n - 1))
        places = np.arange(n - 1)
        rank, to = self._candidates(np.full(n - 1, key, U64), symbols[:-1], symbols[1:], places, places + 1, places + 2)
        agenda = [(int(rank[x]), x, x + 1, x + 2, int(to[x])) for x in np.flatnonzero(rank < NONE).tolist()]
        heapq.heapify(agenda)
        limit, own, table = self.limit, int(key), self.table
        while agenda:
            _, i, j, k, to = heapq.heappop(agenda)
            if sym[i] < 0 or end[i] != j or sym[j] < 0 or end[j] != k:
                continue
            sym[i], sym[j], end[i] = to, -1, k
            new = []
            if k < n:
                prev[k] = i
                new.append((i, k, end[k]))
            if prev[i] >= 0:
                new.append((prev[i], i, k))
            for a, b, c in new:
                if (piece := table.get(sym[a] << _WIDE | sym[b])) is not None:
                    x = (own ^ (a << 42 | b << 21 | c)) * 0x9E3779B97F4A7C15 & _M64
                    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _M64
                    if not x ^ x >> 32 < limit:
                        heapq.heappush(agenda, (int(self.rank[piece]), a, b, c, piece))
        symbols[:] = sym[:n]

    def encode_all(self, data: np.ndarray, offsets: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts that lie one after another as UTF-8 in data."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        if not data.max() < 128:
            offsets = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        full = np.diff(offsets) > 0
        points = np.insert(points, offsets[:-1][full], 32)  # the mark before each text
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        points = np.where(points == 0x2581, np.uint32(_OWN_MARK), points)
        mark, line = points == 32, points == 10
        new = line | mark
        new[1:] &= ~(mark[1:] & mark[:-1])
        new[1:] |= line[:-1]
        first = offsets[:-1][full]
        new[first] = True
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(points)))
        doc = np.searchsorted(offsets[1:], start, "right")
        word = np.arange(len(start)) - np.searchsorted(start, offsets[:-1], "left")[doc]
        keys = self.keys_of(docs[doc], word)
        symbols = self.letter[points]
        order = np.argsort(length, kind="stable")
        size, at = length[order], int(np.searchsorted(length[order], 1, "right"))
        while at < len(order) and size[at] <= SHORT:
            rows = int(size[at])
            rows = rows if rows <= 16 else 24 if rows <= 24 else SHORT
            to = min(int(np.searchsorted(size, rows, "right")), at + AT_ONCE)
            own = order[at:to]
            self._columns(symbols, start[own], length[own], keys[own], rows)
            at = to
        for w in order[at:].tolist():
            self._heap(symbols[start[w] : start[w] + length[w]], keys[w])
        left = symbols >= 0
        counts = np.concatenate([[0], np.cumsum(left)])
        symbols, points = symbols[left], points[left]
        ends = counts[offsets]
        raw = np.flatnonzero(symbols >= self.n)
        if len(raw):
            wide, letters = utf8(np.where(points[raw] == _OWN_MARK, 0x2581, points[raw]))
            more = np.ones(len(symbols), np.int64)
            more[raw] = wide
            to = np.cumsum(more) - more
            out = np.empty(int(more.sum()), np.int32)
            out[to] = symbols
            for j in range(4):
                some = wide > j
                out[to[raw[some]] + j] = self.byte_id[letters[some, j]]
            return out, np.append(to, len(out))[ends]
        return symbols.astype(np.int32), ends

    def encode(self, doc: int, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.encode_all(raw, np.array([0, len(raw)]), np.array([doc]))[0]

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids of texts one after another, each with the space that its mark stands for."""
        width = self.width[ids]
        end = np.cumsum(width)
        return self.flat[np.repeat(self.first[ids] - end + width, width) + np.arange(int(end[-1]) if len(end) else 0)]

    def decode(self, ids: np.ndarray) -> str:
        return self.decoded(np.asarray(ids, np.int64)).tobytes()[1:].decode()


@functools.lru_cache(maxsize=2)
def _codec(model: str, rate: float, seed: int) -> PieceCodec:
    """One for each worker process, as reading a model takes longer than many a batch."""
    return PieceCodec(model, rate, seed)


def _coder(model: str, rate: float, seed: int, keep_ids: bool):
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("lossless", pa.bool_())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def run(batches):
        codec = _codec(model, rate, seed)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            docs = batch.column(0).fill_null(0).to_numpy()
            for i, j in passes(offsets, 1 << 20):
                raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                ids, ends = codec.encode_all(raw, at, docs[i:j])
                back, wide = codec.decoded(ids), np.concatenate([[0], np.cumsum(codec.width[ids])])[ends]
                whole, words = raw.tobytes(), ids.astype("<u4")
                same = [b == a or back[a:b].tobytes() == b" " + whole[c:d] for a, b, c, d in zip(wide[:-1].tolist(), wide[1:].tolist(), at[:-1].tolist(), at[1:].tolist())]
                same = np.array(same) & ((np.diff(ends) > 0) == (np.diff(at) > 0))
                crc = [zlib.crc32(words[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))] * keep_ids
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(ends)), pa.array(crc, pa.int64()), pa.array(same), *lists], schema=schema)

    return run


def encoded(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.1, seed: int = 1, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, lossless[, ids]) of each row; lossless: the ids decode to the text exactly."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_coder(model, rate, seed, keep_ids), "doc_id long, n_tokens long, ids_crc32 long, lossless boolean" + ", ids array<int>" * keep_ids)
