"""Near copies of documents by similarity, against brute force."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from llm_data import documents, no_documents, prose
from test_duplicates import roots

from flowtables.llm import nearcopies


def test_copies_down_to_the_similarity_go(spark):
    r = random.Random(8)
    rows = []
    for i in range(40):  # each with some words changed: similarities of about 0.6 to 1
        words = prose(300, 500 + i).split()
        for n in (0, 1, 3, 5, 6, 8, 12):
            copy = list(words)
            for at in r.sample(range(300), n):
                copy[at] = f"w{r.random()}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(1_000 + i, " ".join([prose(200, 900), *[f"c{j}" for j in range(i)]])) for i in range(0, 120, 2)]  # a chain of links
    sets = {i: set(nearcopies.shingles(nearcopies._tokens(t)).tolist()) for i, t in rows}
    share = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    assert sum(0.8 <= s < 0.97 for s in share.values()) > 100
    root = roots(list(sets), [p for p, s in share.items() if s >= 0.8])
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert {x.doc_id for x in got.collect()} == {i for i in root if root[i] == i}


def test_signatures_find_the_similarity():
    r = np.random.default_rng(3)
    found = 0
    for _ in range(200):
        pool = r.integers(0, 1 << 63, 330, dtype=np.uint64)  # 270 of 330 shared: 0.818
        found += bool(set(nearcopies.bands_of(pool[:300])) & set(nearcopies.bands_of(pool[30:])))
    assert found >= 199


def test_near_copies_of_awkward_rows(spark):
    kept = nearcopies.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 4: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 1, 12: 2, 13: 1, None: 2})
    assert nearcopies.one_of_each(no_documents(spark)).count() == 0
