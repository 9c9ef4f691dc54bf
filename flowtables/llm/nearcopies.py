"""Near-duplicate documents by the similarity of their word shingles.

A text's shingles are all its runs of `words` words (a shorter text is one shingle). MinHash signatures over them, cut into
bands, give the candidates: texts that share a band form a bucket. Candidates are compared by exact Jaccard similarity of the
shingle sets, bucket by bucket as in `linededup.linked`, so that no bucket is listed pair by pair.

A 64-bit fingerprint can't do this: at similarity 0.8 two of them differ in about ten bits, and no equal segments are left
to join on. Texts with the same words in the same order are one text here, whatever their case and white space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import discarded, mapped, prepared, text_of, written
from flowtables.llm.linededup import bucketed, linked
from flowtables.llm.simhash import BLOCK, first_of_components

CELLS = 1 << 16  # hashes times permutations in memory at a time


@dataclass(frozen=True)
class Near:
    """With 20 bands of 5 rows, two texts of similarity 0.8 share a bucket with probability 0.9996, of 0.9 with 1 - 1e-7."""

    words: int = 5
    bands: int = 20
    rows: int = 5
    least: float = 0.8
    heads: int = 8  # texts of a bucket that are each compared with all that the first round left apart


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(42)
    a, b = draw.integers(0, 1 << 63, (2, n, 1), dtype=np.uint64)
    return a << np.uint64(1) | np.uint64(1), b


def _tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at ASCII white space


def shingles(tokens: list[bytes], words: int = 5) -> np.ndarray:
    """Distinct 64-bit hashes of all shingles, none without words."""
    if not tokens:
        return np.zeros(0, np.uint64)
    width = min(words, len(tokens))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    parts = []
    for start in range(0, len(tokens) - width + 1, BLOCK):
        part = tokens[start:start + BLOCK + width - 1]
        parts.append(np.array([digest(join(s), 42) for s in zip(*[part[i:] for i in range(width)], strict=False)], np.uint64))
    return np.unique(np.concatenate(parts))


def bands_of(hashes: np.ndarray, near: Near = Near()) -> list[int]:
    """One 64-bit number per band; none for a text without shingles."""
    if not len(hashes):
        return []
    a, b = _permutations(near.bands * near.rows)
    step = max(1, CELLS // len(a))
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), step):
        np.minimum(least, (hashes[start:start + step] * a + b).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(least.reshape(near.bands, near.rows))]


def _key(tokens: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(tokens)) - (1 << 63)


def _prints(rows: DataFrame, near: Near, doc_id: str, text: str) -> DataFrame:
    """(doc_id, __copy, bits, bands) of every row; `bits` tells texts apart."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tokens = [_tokens(t) for t in frame["__text"]]
            yield frame[[doc_id, "__copy"]].assign(
                bits=np.array([_key(t) for t in tokens], dtype=np.int64),
                bands=[bands_of(shingles(t, near.words), near) for t in tokens])

    prepared(rows.sparkSession)
    kind = rows.schema[doc_id].dataType.simpleString()
    return mapped(rows.select(doc_id, "__copy", text_of(text).alias("__text")), run,
                  f"`{doc_id}` {kind}, __copy long, bits long, bands array<long>", [doc_id])


def _sets(rows: DataFrame, near: Near, text: str) -> DataFrame:
    """(key, size, hashes) of every row's text."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(_tokens(t), near.words).view(np.int64) for t in frame["__text"]]
            yield pd.DataFrame({"key": frame["key"], "size": [len(s) for s in sets], "hashes": sets})

    return rows.select("key", text_of(text).alias("__text")).mapInPandas(run, "key long, size int, hashes array<long>")


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those rows of `pairs` (a, b and more) whose sets have at least the Jaccard similarity."""
    left = sets.select(F.col("key").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("key").alias("b"), F.col("hashes").alias("hb"))
    shared, all_ = F.size(F.array_intersect("ha", "hb")), F.size("ha") + F.size("hb")
    return pairs.join(left, "a").join(right, "b").where(shared * (1 + least) >= least * all_ - 1e-9).select(*pairs.columns)


def one_of_each(docs: DataFrame, near: Near = Near(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, with all their columns.

    Texts link at a Jaccard similarity of `least` or more; texts without words are copies of each other. Rows that repeat a
    kept id in the same component stay with it. A component in which no row has an id stays as it is.
    """
    rows = docs.withColumn("__copy", F.xxhash64(text_of(text)))  # with the id it tells rows of a repeated id apart
    prints = written(_prints(rows, near, doc_id, text), "prints")

    def roots(_: DataFrame) -> DataFrame:
        banded = written(prints.select(F.col("bits").alias("key"), F.explode("bands").alias("band")).distinct(), "bands")
        members = bucketed(banded)
        needed = written(members.select("key").distinct(), "needed")
        # One row of each text, by its copy and id: copies of a text are counted down to one before anything is joined.
        first = prints.groupBy("bits").agg(F.min(F.struct("__copy", F.col(doc_id).alias("id"))).alias("first"))
        ones = written(first.join(needed.withColumnRenamed("key", "bits"), "bits", "left_semi").select(
            F.col("bits").alias("key"), F.col("first.__copy").alias("__of"), F.col("first.id").alias("__id")), "ones")
        same = (F.col("__copy") == F.col("__of")) & F.col(doc_id).eqNullSafe(F.col("__id"))
        texts = rows.select("__copy", doc_id, text).join(ones.hint("shuffle_hash"), same)
        sets = written(_sets(texts.select("key", text).dropDuplicates(["key"]), near, text), "sets")
        discarded(banded, needed, ones)
        found = linked(members, sets.select("key", "size"), lambda pairs: _similar(pairs, sets, near.least), near.least, near.heads)
        discarded(sets)
        return found

    return first_of_components(rows, prints, roots, doc_id).select(*docs.columns)
