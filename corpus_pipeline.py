"""From raw documents to packed training sequences, in five stages; every stage works on all that the one before kept.

1. language: documents without any letter go;
2. lines: of similar lines across all documents one stays, the rest is cut out of the texts;
3. near_duplicates: of documents whose fingerprints are linked (`op5`) the one with the smallest id stays;
4. mix: the sources are mixed to their target weights; a document that the mix takes twice becomes two rows;
5. pack: the documents are tokenised and packed into sequences.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, all but the last with the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.llm import language, linededup, mixing, packing, simhash
from flowtables.llm.common import prepared, vocabulary, written


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels that the documents bring, and drop the documents without any letter, nothing else.

    The model gives every text with a letter one of its languages; how well it fits doesn't decide, as a clean text in a
    language without labels fits no better than noise. Without any label no model is needed to see the letters.
    """
    prepared(spark)
    model = language.trained(docs)
    if not model.languages:
        return docs.where(language.has_letters("text"))
    found = language.with_language(docs, model)
    return found.where(F.col("lang_pred") != language.NONE).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, vocabulary())


STAGES = [
    ("language", detect_language),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: SQL can't express trained models, fingerprints, draws and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written to the shared folder and read by the next."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
