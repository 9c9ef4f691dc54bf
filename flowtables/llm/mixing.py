"""Mixing sources to target weights, in fixed-length blocks of words.

The documents of a source, laid end to end, are its stream, cut into blocks of `block` words (the last may be shorter).
The mix is a list of slots in shards of equal size. Every shard draws its number of slots per source from a multinomial
distribution. A source's slots are numbered through all shards, and a pseudorandom permutation of its block numbers, a new
one for each pass over the source, says which block a slot holds. Slots a source drew beyond its target go to the sources
that drew too few, and the last slot of a source is cut, so that each source gives exactly its target's words. Blocks are
joined to documents by (source, block number): a large source is as many keys as it has blocks.

Only one row per source comes to the driver: its number of words and of slots.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.common import mapped, prepared, text_of, written

WORD = "[^\\x20\\x09-\\x0D]+"
ROUNDS = 4


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # of the sources by code point, NULL last, repeating
    share: float = 1.5     # words of the mix, as a share of all words
    passes: int = 2        # most times a source, and so a document, is used
    block: int = 64        # words in a block
    shard: int = 1_024     # slots in a shard
    seed: int = 20_240


@dataclass(frozen=True)
class Source:
    name: str | None
    words: int
    target: float
    blocks: int
    slots: int
    cut: int  # words that the last slot takes, of its block


def targets(words: Sequence[int], weights: Sequence[float], share: float, passes: int) -> list[float]:
    """Shares by weight; what is above `passes` times a source's words is shared again among the others by weight."""
    out, open_ = [0.0] * len(words), [i for i, w in enumerate(words) if w]
    rest = share * sum(words)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if rest * weights[i] / weight >= passes * words[i]]
        if not full:
            for i in open_:
                out[i] = rest * weights[i] / weight
            break
        for i in full:
            out[i] = float(passes * words[i])
        rest -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    x = values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 64) - 1)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(index: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(size): a balanced Feistel network, walked until it is back in range."""
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = np.asarray(index, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                left, right = right ^ (_mixed(left, key * ROUNDS + r) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, key * ROUNDS + r) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _key(seed: int, source: int, turn: int) -> int:
    return (seed * 1_000_003 + source) * 64 + turn


def _source(i: int, name: str | None, words: int, target: float, mix: Mix) -> Source:
    blocks = -(-words // mix.block)
    take = min(round(target), mix.passes * words)
    if not take:
        return Source(name, words, target, blocks, 0, 0)
    turns, rest = divmod(take, words)
    if not rest:
        return Source(name, words, target, blocks, turns * blocks, mix.block)
    # Where in the last pass the short block comes decides how many slots give `rest` words.
    short = words - (blocks - 1) * mix.block
    at = int(permuted(np.array([blocks - 1]), blocks, _key(mix.seed, i, turns), inverse=True)[0])
    before = lambda n: n * mix.block - (mix.block - short) * (at < n)  # noqa: E731  words of the first n slots
    slots = -(-rest // mix.block)
    slots += before(slots) < rest
    return Source(name, words, target, blocks, turns * blocks + slots, rest - before(slots - 1))


def sized(docs: DataFrame, keep: Sequence[str] = (), doc_id: str = "doc_id", text: str = "text", source: str = "source"
          ) -> DataFrame:
    """The documents' sizes in words as a table with a number per row; `keep` names columns to take along."""
    return written(docs.select(
        F.monotonically_increasing_id().alias("__row"), F.col(doc_id).alias("__doc"), F.col(source).alias("__source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("__size"), *keep), "sizes")


def sources_of(rows: DataFrame, mix: Mix) -> list[Source]:
    totals = rows.groupBy("__source").agg(F.sum("__size").alias("words")).collect()  # one row per source
    named = sorted(((r[0], r[1]) for r in totals), key=lambda x: (x[0] is None, x[0] or ""))
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(named))]
    goals = targets([w for _, w in named], weights, mix.share, mix.passes)
    return [_source(i, n, w, t, mix) for i, ((n, w), t) in enumerate(zip(named, goals, strict=True))]


def slots(rows: DataFrame, sources: Sequence[Source], mix: Mix) -> DataFrame:
    """(shard, source, block, turn, low, high): the mix, each slot with the words of its source's stream that it takes."""
    spark = rows.sparkSession
    wanted = np.array([s.slots for s in sources], dtype=np.int64)
    total = int(wanted.sum())
    shards = -(-total // mix.shard)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                size = min(mix.shard, total - shard * mix.shard)
                counts = np.random.default_rng([mix.seed, shard]).multinomial(size, wanted / total)
                used = np.flatnonzero(counts)
                yield pd.DataFrame({"shard": shard, "source": used, "n": counts[used]})

    draws = written(spark.range(shards).mapInPandas(draw, "shard long, source int, n long"), "draws") if total else \
        spark.createDataFrame([], "shard long, source int, n long")
    drawn = np.zeros(len(sources), np.int64)
    for source, n in draws.groupBy("source").agg(F.sum("n")).collect():  # one row per source
        drawn[source] = n
    surplus, deficit = np.maximum(drawn - wanted, 0), np.maximum(wanted - drawn, 0)
    spare, holes = np.cumsum(surplus) - surplus, np.cumsum(deficit) - deficit
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 64):
                part = frame.iloc[at:at + 64]
                n = part["n"].to_numpy()
                source = np.repeat(part["source"].to_numpy(), n)
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                slot = np.repeat(part["first"].to_numpy(), n) + inside
                over = np.flatnonzero(slot >= wanted[source])
                if len(over):
                    hole = spare[source[over]] + slot[over] - wanted[source[over]]
                    given = np.searchsorted(holes + deficit, hole, side="right")
                    slot[over] = drawn[given] + hole - holes[given]
                    source[over] = given
                out = pd.DataFrame({"shard": np.repeat(part["shard"].to_numpy(), n), "source": source})
                block, turn, length = np.zeros_like(slot), np.zeros_like(slot), np.full_like(slot, mix.block)
                for k in np.unique(source):
                    s, mine = sources[k], np.flatnonzero(source == k)
                    turn[mine] = slot[mine] // s.blocks
                    for t in np.unique(turn[mine]):
                        these = mine[turn[mine] == t]
                        block[these] = permuted(slot[these] % s.blocks, s.blocks, _key(mix.seed, int(k), int(t)))
                    length[mine[slot[mine] == s.slots - 1]] = s.cut
                low = block * mix.block
                high = np.minimum(low + length, np.array([s.words for s in sources])[source])
                yield out.assign(block=block, turn=turn, low=low, high=high)

    return draws.select("shard", "source", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")).mapInPandas(
        fill, "shard long, source int, block long, turn long, low long, high long")


def placed(rows: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Add the source's number and __start, the words of the source's stream before the document.

    The order in a source is that of (bucket of the id's hash, id). There are about as many buckets as a bucket has rows, so
    neither the offsets of the buckets nor the rows of one grow beyond the square root of the table.
    """
    spark = rows.sparkSession
    buckets = isqrt(rows.count()) + 1
    names = spark.createDataFrame([(i, s.name) for i, s in enumerate(sources)], "source int, __name string")
    numbered = rows.join(names, F.col("__source").eqNullSafe(F.col("__name"))).drop("__name").withColumn(
        "__bucket", F.pmod(F.xxhash64("__doc"), F.lit(buckets)))
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("source", "__bucket").agg(F.sum("__size").alias("__words")).select(
        "source", "__bucket", F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("__offset"))
    within = Window.partitionBy("source", "__bucket").orderBy("__doc", "__size", "__row").rowsBetween(
        Window.unboundedPreceding, -1)
    local = numbered.withColumn("__before", F.coalesce(F.sum("__size").over(within), F.lit(0)))
    return local.join(offsets, ["source", "__bucket"]).withColumn(
        "__start", F.col("__offset") + F.col("__before")).drop("__bucket", "__offset", "__before")


def _overlaps(rows: DataFrame, mix: Mix) -> tuple[DataFrame, list[Source]]:
    """One row per document and slot of its blocks, at least one per document: __from and __to in its words, NULL if none."""
    sources = sources_of(rows, mix)
    at = placed(rows.select("__row", "__doc", "__source", "__size"), sources)
    last = F.floor((F.col("__start") + F.col("__size") - 1) / mix.block)
    parts = at.withColumn("block", F.explode_outer(F.when(
        F.col("__size") > 0, F.sequence(F.floor(F.col("__start") / mix.block), last))))
    # Spark can't foresee how many rows slots and blocks become, so it is told not to broadcast them.
    met = parts.join(slots(rows, sources, mix).drop("shard").hint("merge"), ["source", "block"], "left")
    start, end, used = F.col("__start"), F.col("__start") + F.col("__size"), F.col("low").isNotNull()
    return met.select(
        "__row", "__doc", "source", "__size", "turn", F.when(used, F.greatest(start, "low") - start).alias("__from"),
        F.when(used, F.least(end, "high") - start).alias("__to")), sources


def mixture(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source"
            ) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row: how many words of it the mix holds, repeats counted.

    NULL text has no words, NULL is a source of its own, and rows that repeat an id are documents of their own. The same table
    gives the same mix. An empty table, or one without words, gives nothing to take.
    """
    prepared(docs.sparkSession)
    parts, sources = _overlaps(sized(docs, (), doc_id, text, source), mix)
    words = F.when(F.col("__to") > F.col("__from"), F.col("__to") - F.col("__from")).otherwise(0)
    taken = parts.groupBy("__row", "__doc", "source", "__size").agg(F.sum(words).alias("taken"))
    facts = docs.sparkSession.createDataFrame(
        [(i, s.words, float(s.target)) for i, s in enumerate(sources)], "source int, source_size long, target double")
    return taken.join(facts, "source").select(
        F.col("__doc").alias(doc_id), F.col("__size").alias("size"), "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    n_chars: str | None = "n_chars") -> DataFrame:
    """The mix as documents with the columns of `docs`: a row for each pass that takes something of a document.

    Its text is what the mix takes, words and the white space between them; a document that is taken whole keeps its text as
    it is. `n_chars`, if present, becomes the number of characters.
    """
    prepared(docs.sparkSession)
    rows = sized(docs, docs.columns, doc_id, text, source)
    parts, _ = _overlaps(rows, mix)
    spans = parts.where("__to > __from").groupBy("__row", "turn").agg(
        F.array_sort(F.collect_list(F.struct("__from", "__to"))).alias("__spans")).drop("turn")  # at most one per block of the document
    word, columns = re.compile(WORD), list(docs.columns)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for t, size, spans in zip(frame[text], frame["__size"], frame["__spans"], strict=True):
                runs: list[list[int]] = []
                for s in spans:
                    if runs and runs[-1][1] == s["__from"]:
                        runs[-1][1] = s["__to"]
                    else:
                        runs.append([s["__from"], s["__to"]])
                if runs != [[0, size]]:
                    ends = np.array([m.span() for m in word.finditer(t)])
                    t = "\n".join(t[ends[a, 0]:ends[b - 1, 1]] for a, b in runs)
                texts.append(t)
            frame[text] = texts
            if n_chars in frame:
                frame[n_chars] = [len(t) for t in texts]
            yield frame[columns]

    return mapped(rows.join(spans, "__row").select("__size", "__spans", *columns), cut, docs.schema,
                  [c for c in columns if c not in (text, n_chars)])
