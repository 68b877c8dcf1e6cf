"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import decontaminate, jaccard, pieces, quality, suffixes
from aerolith.llm.common import stored, table, with_row_number
from aerolith.llm.queries import PIECE_BPE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    bad = quality.scored(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates, one row of it; those without id or words."""
    rows = with_row_number(docs, "__row")
    first = jaccard.first_rows(rows, "__row").withColumnRenamed("row", "__row")
    return rows.join(first, "__row", "left_semi").select(COLUMNS)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 200 bytes or more that stand elsewhere too; characters stay whole, as do texts without an id."""
    rows = with_row_number(docs, "__row")
    named = rows.where("doc_id is not null")
    texts = suffixes.deduped(named, id_col="__row").withColumnRenamed("doc_id", "__row")
    cut = named.drop("text", "n_chars").join(texts, "__row")
    both = cut.select("doc_id", "text", "lang", "source").unionByName(rows.where("doc_id is null").select("doc_id", "text", "lang", "source"))
    return both.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    return pieces.encoded(docs, PIECE_BPE, keep_ids=True)


STAGES = [("quality", good), ("near_duplicates", distinct), ("suffix_dedup", unrepeated), ("decontamination", uncontaminated), ("pieces", encoded)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
