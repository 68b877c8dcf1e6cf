"""Queries over the whole tables, one for each operator, and the SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import dac, decontaminate, htmltext, jaccard, multiindex, pieces, quality, sharding, suffixes, urlrules
from .common import table

BYTE_BPE, PIECE_BPE = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), PIECE_BPE)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.read_token_files(spark, dac.write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_digest(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judged_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_jaccard_join, op3_piece_dropout, op4_token_files, op5_embedding_dedup, op6_suffix_dedup, op7_html_extraction, op8_quality, op9_sharding, op10_url_filters)}

_ABC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE_SQL = {
    "op1_decontamination": rf"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_ABC}', '{_ABC.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_ABC}', '{_ABC.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bg as (select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
       from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from bw where len(w) > 0) a),
ns as (select distinct n from bg),
dg as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, ns where len(w) >= n) a),
hits as (select dg.doc_id, dg.i, dg.n, bg.item_id from dg join bg on dg.n = bg.n and dg.g = bg.g),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) a group by doc_id),
its as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as sha
        from (select distinct doc_id, cast(item_id as varchar) as item from hits) a group by doc_id)
select dw.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       coalesce(sha, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join pos using (doc_id) left join its using (doc_id)""",
    "op5_embedding_dedup": """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
ok as (select vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as n from v
       where label is not null and e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (select a.vec_id as u, b.vec_id as w from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (a.n * b.n) >= 0.93),
r(u, w) as (select vec_id, vec_id from v union select r.u, l.w from r join l on r.w = l.u),
c as (select u, min(w) as component_id from r group by u), k as (select u, count(*) as n from l group by u)
select vec_id, cast(coalesce(k.n, 0) as bigint) as n_links, c.component_id, vec_id = c.component_id as kept
from v join c on c.u = v.vec_id left join k on k.u = v.vec_id""",
}
