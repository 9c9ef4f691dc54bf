"""The operators as queries over the standard tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.llm import (
    exactdedup, hardnegatives, html, language, lattice, licences, linededup, mixing, packing, quality, simhash, spelling, urlrules,
)
from flowtables.llm.common import held_out, table, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), vocabulary())


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, folder, "documents"))


ORACLE["op9_exact_dedup"] = r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as content from documents)
select doc_id, min(doc_id) over (partition by content) as keep_id, count(*) over (partition by content) as group_size,
  doc_id = min(doc_id) over (partition by content) as kept, sha256(content) as text_sha256
from texts
"""


@query
def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


@query
def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(table(spark, folder, "embeddings"))


ORACLE["op2_embedding_near_dedup"] = """
with recursive usable as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
  on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where case when len(a.v) = len(b.v) then list_cosine_similarity(a.v, b.v) >= 0.9 end),
reached(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reached r join links l on r.b = l.a)
select vec_id, (select count(*) from links where a = vec_id) as n_links,
  (select min(b) from reached where a = vec_id) as component_id,
  vec_id = (select min(b) from reached where a = vec_id) as kept
from embeddings
"""


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.trained(docs.where(~held_out(3, 1)))
    return language.with_language(docs, model, keep=["doc_id", held_out(3, 1).alias("held_out")])


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fitted(docs, table(spark, folder, "labels").where(~held_out(5, 0)))
    return quality.scored(docs, model, ("doc_id", held_out(5, 0).alias("held_out")))


@query
def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(table(spark, folder, "pages"), keep=("page_id", "url"))


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.license_scan(table(spark, folder, "documents"), keep=["doc_id"])


ORACLE["op1_license_scan"] = licences.oracle()


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.without_repeats(table(spark, folder, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hardnegatives.relabelled(table(spark, folder, "embeddings"))
    return hardnegatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


ORACLE["op11_hard_negatives"] = hardnegatives.oracle()


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


ORACLE["op12_spelling_variants"] = spelling.oracle()


@query
def op13_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = [*urlrules.SITES, *urlrules.DEFAULTS]
    return urlrules.judged(table(spark, folder, "pages"), rules).drop("n_tried")


ORACLE["op13_url_filters"] = urlrules.oracle()
