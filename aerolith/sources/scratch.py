"""Tables in the shared folder of the cluster, which cut long lineages, and groups of sorted batches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once under spark.checkpoint.dir and read back; a temporary folder only in a single process (tests)."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="aerolith-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/aerolith/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys, from batches sorted by these keys; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.ones(batch.num_rows, bool)
        for c in columns[:1]:
            change[1:] = c[1:] != c[:-1]
        for c in columns[1:]:
            change[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(change).tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            own = tuple(c[i] for c in columns)
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            last = own
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)
