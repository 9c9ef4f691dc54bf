"""Ids that no float holds, beside NULL and repeated ones, come through every operator and stage on documents as they are."""

from collections import Counter

import pytest

import corpus_pipeline
from flowtables.llm import exactdedup, language, linededup, mixing, nearcopies, packing, quality, simhash
from flowtables.llm.common import vocabulary

IDS = [(1 << 53) + 1, (1 << 53) + 3, 1 << 62, (1 << 62) + 1, -(1 << 63), -(1 << 63) + 1, (1 << 63) - 1, None, None, 7, 7]


@pytest.fixture
def docs(spark):
    rows = [(i, f"document number {k} says something of its own, {'abcdefghijk'[k] * 5} {k * 7919} words and {k * 104729} more", "en",
             None if k % 4 == 0 else "s", None if k % 3 else (1 << 60) + k) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


@pytest.mark.parametrize("operator", [
    exactdedup.exact_duplicates, simhash.near_duplicates, simhash.one_of_each, nearcopies.one_of_each, linededup.without_repeats,
    mixing.mixture, lambda d: packing.packed_documents(d, vocabulary()),
    lambda d: language.with_language(d, language.trained(d), keep=["doc_id"]),
    lambda d: quality.scored(d, quality.fitted(d, d.selectExpr("doc_id", "1 as quality")), ("doc_id",))])
def test_operator(docs, operator):
    assert Counter(r.doc_id for r in operator(docs).collect()) == Counter(IDS)


def test_smallest_id_names_a_group(spark):
    rows = [(i, "the same text for all of them") for i in IDS] + [((1 << 60) + k, "x y z") for k in (5, 3, 9)] + [(None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for operator, name in ((exactdedup.exact_duplicates, "keep_id"), (simhash.near_duplicates, "component_id")):
        assert Counter(r[name] for r in operator(docs).collect()) == Counter({-(1 << 63): len(IDS), (1 << 60) + 3: 4})


def test_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "").collect()
        assert {r.doc_id for r in out} == set(IDS), name
        if "n_chars" in out[0] and name in ("language", "near_duplicates"):
            assert {r.n_chars for r in out} == {r.n_chars for r in docs.collect()}, name
