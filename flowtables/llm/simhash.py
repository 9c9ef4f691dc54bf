"""SimHash near-duplicates: fingerprints of word shingles, linked within a few bits by pigeonring filtering.

A fingerprint's bits lie on a ring of `segments` segments. If two fingerprints differ in at most t bits, then some chain
of segments exists whose first l segments together differ in at most l * t / segments bits, for every l. The budgets are
0 as long as l * t < segments, so such a chain starts with segments that are equal: these are the join key, one per start.
The pairs that share a key must then keep the budget of every longer prefix of the chain before all bits are compared. A
pair is kept at the first start whose whole chain holds, so it comes out once.

Only distinct fingerprints are joined. Copies share theirs and meet again through it at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import discarded, mapped, prepared, text_of, written
from flowtables.llm.components import components

BLOCK = 50_000  # shingles hashed at a time, so a very long text needs no more memory


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in more than half of the hashes of all shingles, repeats included; 0 without words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not tokens:
        return 0
    width = min(words, len(tokens))
    total = len(tokens) - width + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        part = tokens[start:start + BLOCK + width - 1]
        hashes = np.array([digest(join(s), seed) for s in zip(*[part[i:] for i in range(width)], strict=False)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """(doc_id, bits) and the columns in `keep` for every row; NULL text is empty text, whose bits are 0."""
    names = [doc_id, *keep]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[names].assign(bits=np.array([fingerprint(t, words) for t in frame["__text"]], dtype=np.int64))

    prepared(docs.sparkSession)
    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return mapped(docs.select(*names, text_of(text).alias("__text")), run, f"{kinds}, bits long", names)


def _masks(segments: int) -> list[int]:
    ends = [round(64 * i / segments) for i in range(segments + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(ends, ends[1:], strict=False)]


def _lit(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def close_pairs(bits: DataFrame, distance: int = 2, segments: int = 7) -> DataFrame:
    """Pairs (a, b), a < b, of distinct values of the long column `bits` that differ in at most `distance` bits."""
    if not 0 < distance < segments:
        raise ValueError("the distance must be positive and below the number of segments")
    masks = _masks(segments)
    same = max(n for n in range(1, segments) if n * distance < segments)  # segments that have to be equal
    keys = [sum(masks[(start + i) % segments] for i in range(same)) for start in range(segments)]
    side = bits.select("bits", F.posexplode(F.array(*[F.col("bits").bitwiseAND(_lit(k)) for k in keys])).alias("start", "key"))
    pairs = side.select("start", "key", F.col("bits").alias("a")).join(
        side.select("start", "key", F.col("bits").alias("b")).hint("merge"), ["start", "key"])
    differ = F.col("a").bitwiseXOR(F.col("b"))
    parts = [F.bit_count(differ.bitwiseAND(_lit(m))) for m in masks]
    first = F.lit(-1)
    for start in reversed(range(segments)):
        holds, sum_ = F.lit(True), F.lit(0)
        for n in range(1, segments + 1):
            sum_ = sum_ + parts[(start + n - 1) % segments]
            holds = holds & (sum_ <= n * distance // segments)
        first = F.when(holds, F.lit(start)).otherwise(first)
    return pairs.where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance) & (first == F.col("start"))).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, segments: int = 7, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; component_id is the smallest id reachable over links.

    Fingerprints link at `distance` or fewer differing bits. Empty texts share the fingerprint 0 and link like others. Rows
    with a NULL id belong to their component and never name it, unless it has no other rows: then its id is NULL. An empty
    table gives no rows.
    """
    return _components(written(fingerprints(docs, words, doc_id, text), "prints"), _close(distance, segments), doc_id).select(
        doc_id, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, distance: int = 2, segments: int = 7, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The rows of `docs` whose id names their component (see `near_duplicates`), with all their columns.

    Rows that repeat a kept id in the same component stay with it. A component in which no row has an id stays as it is.
    """
    rows = docs.withColumn("__copy", F.xxhash64(text_of(text)))  # with the id it tells rows of a repeated id apart
    prints = written(fingerprints(rows, words, doc_id, text, "__copy"), "prints")
    return first_of_components(rows, prints, _close(distance, segments), doc_id).select(*docs.columns)


def _close(distance: int, segments: int) -> Callable[[DataFrame], DataFrame]:
    return lambda bits: components(close_pairs(bits, distance, segments))


def first_of_components(rows: DataFrame, prints: DataFrame, roots: Callable[[DataFrame], DataFrame], doc_id: str) -> DataFrame:
    """The `rows` (doc_id, __copy and more) whose id names their component; `prints` (doc_id, __copy, bits) is removed.

    `roots` gets the distinct bits and returns (node, root) of those that are linked.
    """
    linked = _components(prints, roots, doc_id)
    kept = written(linked.where(F.col(doc_id).eqNullSafe(F.col("component_id"))).select(
        F.col(doc_id).alias("__id"), F.col("__copy").alias("__of")).distinct(), "kept")
    discarded(prints)
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__copy") == F.col("__of"))
    return rows.join(kept.hint("shuffle_hash"), same, "left_semi")


def _components(prints: DataFrame, find: Callable[[DataFrame], DataFrame], doc_id: str) -> DataFrame:
    """`prints` (doc_id, bits and more) with component_id."""
    distinct = written(prints.groupBy("bits").agg(F.min(doc_id).alias("first_id")), "distinct")
    roots = find(distinct.select("bits"))
    rooted = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root"))
    names = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "names")
    named = written(rooted.select("bits", "root").join(names, "root").select("bits", "component_id"), "named")
    discarded(distinct, names)
    return prints.join(named, "bits").select(*prints.columns, "component_id")
