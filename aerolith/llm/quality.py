"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are trigrams of character shapes and a few graded word and line statistics, hashed into a fixed space.
Labelled texts give term weights and, by a randomised singular value decomposition, latent axes. Their vectors are
broadcast (at most SAMPLE rows of AXES numbers); every document's cosine with each of them is computed in blocks, and the
nearest vote with their similarity as weight.

The classifier is fitted on at most SAMPLE labelled rows, chosen by a hash of the id; all documents are scored.

Defined cases: null is the empty text, which has a term of its own; labels that are null, or of ids without a document,
are not used; an id that is labelled twice counts with its smallest label; without labels every score is 0.5; rows that
repeat are scored alike; further columns are ignored; a null id is never held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, mixed, passes, scan_words, text_buffer

SAMPLE, AXES, TERMS, NEIGHBOURS, CUT = 4000, 48, 4096, 25, 0.3
_SHAPE = np.zeros(256, np.uint16)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 1, 2, 3, 4
for _i, _c in enumerate([32, 10, 9, 13, *range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]):
    _SHAPE[_c] = 5 + _i
_GRADES = 16


def _grade(x: float) -> int:
    return min(_GRADES - 1, max(0, int(x * _GRADES)))


def term_counts(data: np.ndarray, offsets: np.ndarray, terms: int = TERMS) -> np.ndarray:
    """Counts of hashed terms, one row for each text."""
    n = len(offsets) - 1
    out = np.zeros((n, terms), np.float32)
    low = terms - 8 * _GRADES  # the last columns hold the graded statistics
    s = _SHAPE[data].astype(np.uint32)
    gram = s[:-2] * np.uint32(2025) + s[1:-1] * np.uint32(45) + s[2:] if len(s) > 2 else np.zeros(0, np.uint32)
    col = (mixed(gram.astype(U64)) % U64(low)).astype(np.int64) if len(gram) < 91125 else (mixed(np.arange(91125, dtype=U64)) % U64(low)).astype(np.int64)[gram]
    start, end, h, at = scan_words(data, offsets)
    for d in range(n):
        a, b = int(offsets[d]), int(offsets[d + 1])
        if b - a > 2:
            out[d, :low] = np.bincount(col[a : b - 2], minlength=low)
        words = h[at[d] : at[d + 1]]
        size = b - a
        k = len(words)
        stats = np.zeros(8, np.int64)
        stats[0] = _grade(np.log1p(size) / 14)
        if k:
            same = len(np.unique(words)) / k
            stats[1] = _grade(same)
            stats[2] = _grade(len(np.unique(words[1:] * U64(31) + words[:-1])) / max(1, k - 1))
            stats[3] = _grade(k * 4 / max(1, size))
            stats[4] = _grade(float((end[at[d] : at[d + 1]] - start[at[d] : at[d + 1]]).mean()) / 24)
        shape = s[a:b]
        if size:
            stats[5] = _grade(np.count_nonzero(shape == 2) / size)
            stats[6] = _grade(np.count_nonzero(shape > 6) / size * 2)
            stats[7] = _grade(np.count_nonzero(shape == 6) / size * 20)
        out[d, low + np.arange(8) * _GRADES + stats] = 1 + np.sqrt(k) / 4
    return out


@dataclass
class Neighbours:
    """A fitted classifier; its size depends on the bounds alone."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, labels: np.ndarray, axes: int = AXES, seed: int = 11) -> Neighbours:
        weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 0.1
        x = Neighbours._weighed(counts, weight)
        rng = np.random.default_rng(seed)
        k = min(axes, *x.shape)
        q = x @ rng.normal(size=(x.shape[1], k + 16)).astype(np.float32)
        for _ in range(4):
            q, _ = np.linalg.qr(x @ (x.T @ q))
        _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
        found = Neighbours(weight, vt[:k].T.astype(np.float32), np.zeros((0, k), np.float32), labels.astype(np.float32))
        v = x @ found.axes
        found.vectors = v / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
        return found

    @staticmethod
    def _weighed(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
        x = np.log1p(counts)
        x *= weight
        x /= np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None]
        return x

    def latent(self, counts: np.ndarray) -> np.ndarray:
        v = self._weighed(counts, self.weight) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 in the similarity-weighted vote of the nearest; ties go to the earlier row of the sample."""
        if not len(self.vectors):
            return np.full(len(counts), 0.5)
        cos = self.latent(counts) @ self.vectors.T
        k = min(neighbours, len(self.vectors))
        best = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        least = np.take_along_axis(cos, best, 1).min(1)
        for i in np.flatnonzero((cos >= least[:, None]).sum(1) > k):  # ties at the end
            best[i] = np.argsort(-cos[i], kind="stable")[:k]
        w = np.maximum(np.take_along_axis(cos, best, 1), 0).astype(np.float64) ** 8 + 1e-9
        return (w * self.labels[best]).sum(1) / w.sum(1)


def held_out(id_col: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _sparse_rows(batches):
    schema = pa.schema([("label", pa.int32()), ("doc_id", pa.int64()), ("cols", pa.binary()), ("counts", pa.binary())])
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        for i, j in passes(offsets):
            c = term_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            cols = [np.flatnonzero(r).astype(np.int16) for r in c]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array([k.tobytes() for k in cols], pa.binary()), pa.array([r[k].tobytes() for r, k in zip(c, cols)], pa.binary())], schema=schema)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Neighbours:
    """Learns from labelled rows that are not held out; only a bounded number of sparse term rows reaches the driver."""
    known = labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(label_id)))
    picked = known.groupBy(F.col(label_id).cast("long").alias("label_id")).agg((F.min(label_col) > 0).cast("int").alias("label")).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked), texts["doc_id"] == picked["label_id"]).select("label", "doc_id", "text")
    got = rows.mapInArrow(_sparse_rows, "label int, doc_id long, cols binary, counts binary").orderBy(F.xxhash64("doc_id", "cols", "counts"), "doc_id", "cols", "counts").limit(sample).collect()
    counts = np.zeros((len(got), TERMS), np.float32)
    for row, r in zip(counts, got):
        row[np.frombuffer(r["cols"], np.int16)] = np.frombuffer(r["counts"], np.float32)
    if not len(got):
        return Neighbours(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    return Neighbours.fit(counts, np.array([r["label"] for r in got]))


def _scorer(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        model = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in passes(offsets):
                for a in range(i, j, 256):
                    b = min(a + 256, j)
                    s = model.score(term_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s)], schema=schema)

    return run


def scored(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col=id_col, text_col=text_col, **options))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scorer(shared), "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
