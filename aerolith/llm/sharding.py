"""Sharding by fixed virtual slots.

Records hash into thousands of slots by id; bytes are summed per slot, and a versioned map from slots to shards balances
them. Records never change slot: rebalancing edits the map alone. The map has one entry per slot, so its size is fixed; it
is a table, each edit adds a version, and placing reads the version that it is told or the latest.

The law is `bytes`: slots go to shards so that bytes are near equal. Rows are placed by id and not by text, so a group of equal
texts is spread like any other rows, however large, and grown_shard is null.

Defined cases: a null text has size 1; rows without an id hash by their text's checksum and size; rows that repeat an id share its slot and get places
of their own, by checksum and size; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path

SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """shard_of[slot]; each edit makes the next version and says which slots moved."""

    shard_of: tuple[int, ...]
    shards: int
    version: int = 1
    moved: tuple[int, ...] = field(default=())

    @staticmethod
    def balanced(sizes: list[int], shards: int) -> SlotMap:
        """Largest slot first, to the shard with the fewest bytes; ties go to the lower slot and shard."""
        heap, out = [(0, s) for s in range(shards)], [0] * len(sizes)
        for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            held, shard = heapq.heappop(heap)
            out[slot] = shard
            heapq.heappush(heap, (held + sizes[slot], shard))
        return SlotMap(tuple(out), shards)

    def grown(self, sizes: list[int]) -> SlotMap:
        """One more shard, filled to the mean with slots of the fullest shards; no slot moves between old shards."""
        held = [0] * self.shards
        own: list[list[int]] = [[] for _ in held]
        for slot, shard in enumerate(self.shard_of):
            held[shard] += sizes[slot]
            own[shard].append(slot)
        goal, new, moved, out = sum(held) / (self.shards + 1), 0, [], list(self.shard_of)
        for slots in own:
            slots.sort(key=lambda s: (sizes[s], s))
        while new < goal:
            shard = max(range(self.shards), key=lambda s: (held[s], -s))
            if not own[shard] or new + sizes[own[shard][-1]] > goal + max(sizes) / 2:
                break
            slot = own[shard].pop()
            out[slot], new = self.shards, new + sizes[slot]
            held[shard] -= sizes[slot]
            moved.append(slot)
        return SlotMap(tuple(out), self.shards + 1, self.version + 1, tuple(sorted(moved)))

    def frame(self, spark) -> DataFrame:
        moved = set(self.moved)
        rows = [(self.version, self.shards, slot, shard, slot in moved) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, shards int, virtual_slot int, shard int, moved boolean")

    def save(self, spark, path: str) -> str:
        """Adds this version to the map's table; a version that is there already stays as it is."""
        there = saved_versions(spark, path)
        if self.version in there:
            raise ValueError(f"version {self.version} is there already")
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)
        return path

    @staticmethod
    def load(spark, path: str, version: int | None = None) -> SlotMap:
        """The version that is asked for, or the latest."""
        there = saved_versions(spark, path)
        version = max(there) if version is None else version
        if version not in there:
            raise KeyError(version)
        rows = spark.read.schema(_MAP).parquet(path).where(F.col("version") == version).orderBy("virtual_slot").collect()
        return SlotMap(tuple(r.shard for r in rows), rows[0].shards, version, tuple(r.virtual_slot for r in rows if r.moved))


_MAP = "version int, shards int, virtual_slot int, shard int, moved boolean"


def saved_versions(spark, path: str) -> list[int]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return []
    return [r.version for r in spark.read.schema(_MAP).parquet(path).select("version").distinct().collect()]


def slotted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot); texts don't travel further."""
    raw = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)))
    return rows.withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot: one number each, so the driver's share is fixed by the number of slots."""
    size, count = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r.virtual_slot], count[r.virtual_slot] = r.b, r.n
    return size, count


def rebalanced(docs: DataFrame, map_path: str, *, slots: int = SLOTS, **options) -> SlotMap:
    """One more shard: the latest map edited by the present bytes of its slots and stored as the next version."""
    spark = docs.sparkSession
    grown = SlotMap.load(spark, map_path).grown(slot_sizes(slotted(docs, slots=slots, **options), slots)[0])
    grown.save(spark, map_path)
    return grown


def sharded(docs: DataFrame, shards: int = 16, *, slots: int = SLOTS, map_path: str | None = None, version: int | None = None, **options) -> DataFrame:
    """Rows with shard and slot (place in the shard, from 0 without gaps), under the law of near equal bytes.

    The map at map_path is used; where there is none yet, a balanced one is made and stored there as version 1.

    A row's place is the number of rows in the shard's earlier virtual slots plus its place in its own, so ordering is
    done slot by slot.
    """
    spark = docs.sparkSession
    rows = slotted(docs, slots=slots, **options)
    sizes, counts = slot_sizes(rows, slots)
    map_path = map_path or scratch_path(spark, "slot-map")
    if not saved_versions(spark, map_path):
        SlotMap.balanced(sizes, shards).save(spark, map_path)
    slot_map = SlotMap.load(spark, map_path, version)
    seen, first = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.shard_of):
        first.append((slot, shard, seen[shard]))
        seen[shard] += counts[slot]
    places = spark.createDataFrame(first, "virtual_slot int, shard int, first long")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("place", place).join(F.broadcast(places), "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(slot_map.version).alias("map_version")
    )
