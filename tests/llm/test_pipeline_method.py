"""The pipeline's near duplicates are those of the fingerprints' operator."""

import corpus_pipeline
from flowtables.llm import simhash

WORDS = [f"word{i}" for i in range(400)]


def test_near_duplicates_are_linked_by_fingerprints(spark):
    # Text 3 is 0.9 alike to text 0 by its shingles, but not by its fingerprint.
    texts = [" ".join(WORDS), " ".join(WORDS).upper(), " ".join([*WORDS[:399], "other"]), " ".join(WORDS[:360]), "", None, "other text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = simhash.near_duplicates(docs).where("doc_id = component_id")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in linked.collect())
    prints = [simhash.fingerprint(texts[i]) for i in (0, 3)]
    assert bin((prints[0] ^ prints[1]) % (1 << 64)).count("1") > 2
    assert kept.where("doc_id = 3").count() == 1
