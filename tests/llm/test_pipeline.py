"""The pipeline over a small table with planted documents."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from aerolith.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    bench = table(spark, SF, "benchmark").where("length(text) > 150").first().text
    rng = random.Random(3)
    seen = docs.where("length(text) > 2500 and lang = 'en'").limit(3).collect()
    fresh = " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd"]) for _ in range(rng.randint(1, 4))) for _ in range(150)).capitalize() + "."
    planted = [(10**6, seen[0].text, "en", "s", 1), (10**6 + 1, bench, "en", "s", 1), (10**6 + 2, fresh, "en", "s", 1)]
    now = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, SF), "t-" + name)
        assert now.columns == docs.columns and [t for _, t in now.dtypes] == [t for _, t in docs.dtypes]
        counts.append(now.count())
    ids = {r.doc_id for r in now.select("doc_id").collect()}
    assert counts == sorted(counts, reverse=True) and 10**6 not in ids and 10**6 + 1 not in ids and 10**6 + 2 in ids
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert last.count() == counts[-1] and last.where(~F.col("lossless")).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "suffix_dedup", "decontamination", "pieces"]


def test_null_and_repeated_ids(spark):
    rng = random.Random(4)
    a, b, c, d = (" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)) for _ in range(4))
    rows = [(None, a), (None, b), (5, c), (5, c), (5, d), (9, c + " more"), (7, ""), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for now in (docs, stored(docs.repartition(3), "t-docs")):
        now = stored(corpus_pipeline.distinct(spark, now, SF), "t-distinct")
        want = sorted([(None, a), (None, b), (5, c), (5, d), (7, ""), (7, None)], key=str)
        assert sorted(((r.doc_id, r.text) for r in now.collect()), key=str) == want
        got = corpus_pipeline.unrepeated(spark, now, SF).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == want and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
