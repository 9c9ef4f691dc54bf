"""Near-duplicate vectors by lattice hashing: random projections, decoded to points of the E8 lattice, in several tables.

Each table projects a unit vector to two blocks of eight coordinates and decodes each to the nearest point of E8; the pair
of points is its cell. A vector lies in one cell per table and probes those `probes` cells of the table that are nearest
to its projection, its own among them: neighbouring lattice points differ by one of the 240 shortest vectors of E8. Vectors
of which one probes the other's cell are candidates; their cosine is then computed in double precision.

Vectors with equal components are one class, joined once for all of them, so copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import prepared, written
from flowtables.llm.components import components


@dataclass(frozen=True)
class Lattice:
    """For two vectors of cosine 0.9 in 64 dimensions a table with these numbers finds about 44 %, eight find 99 %."""

    tables: int = 8
    probes: int = 32
    scale: float = 0.6  # of the projection; larger: smaller cells
    seed: int = 8


def _shortest() -> np.ndarray:
    """0 and the 240 shortest vectors of E8."""
    out = [np.zeros(8)]
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


SHORTEST = _shortest()
LENGTHS = (SHORTEST ** 2).sum(axis=1)
NEAREST = 24  # neighbours of a block that can be part of a probed cell; `probes` at most


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8: integers with an even sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    near[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1.0, -1.0)
    return near


def decoded(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 moved by one half in every coordinate."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def _numbers(points: np.ndarray, salt: int) -> np.ndarray:
    """A number per lattice point of (..., 16) coordinates; a clash only adds a candidate."""
    odd = np.random.default_rng([salt, 16]).integers(1, 1 << 62, 16, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    whole = np.rint(2 * points).astype(np.int64).astype(np.uint64)
    x = (whole * odd).sum(axis=-1, dtype=np.uint64)
    x ^= x >> np.uint64(31)
    return (x * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)


def cells(vectors: np.ndarray, lattice: Lattice, probing: bool) -> np.ndarray:
    """(rows, tables) numbers of the vectors' own cells, or (rows, tables * probes) of those they probe."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    out = []
    for t in range(lattice.tables):
        plane = np.random.default_rng([lattice.seed, t, unit.shape[1]]).normal(size=(unit.shape[1], 16)) * lattice.scale
        at = unit @ plane
        own = [decoded(at[:, :8]), decoded(at[:, 8:])]
        salt = lattice.seed * 1_000 + t
        if not probing:
            out.append(_numbers(np.concatenate(own, axis=1), salt)[:, None])
            continue
        far, points = [], []
        for block, home in zip((at[:, :8], at[:, 8:]), own, strict=True):
            cost = LENGTHS - 2 * ((block - home) @ SHORTEST.T)  # squared distance, less that to `home`
            near = np.argsort(cost, axis=1, kind="stable")[:, :NEAREST]
            far.append(np.take_along_axis(cost, near, axis=1))
            points.append(home[:, None] + SHORTEST[near])
        both = (far[0][:, :, None] + far[1][:, None, :]).reshape(len(unit), -1)
        best = np.argsort(both, axis=1, kind="stable")[:, :lattice.probes]
        rows = np.arange(len(unit))[:, None]
        out.append(_numbers(np.concatenate(
            [points[0][rows, best // NEAREST], points[1][rows, best % NEAREST]], axis=2), salt))
    return np.concatenate(out, axis=1)


def _valid(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _celled(classes: DataFrame, lattice: Lattice, probing: bool) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["vector"].map(len)
            for size in sizes.unique():
                part = frame[sizes == size]
                for at in range(0, len(part), 2_000):
                    some = part.iloc[at:at + 2_000]
                    keys = cells(np.stack(some["vector"].to_list()).astype(np.float64), lattice, probing)
                    yield pd.DataFrame({"class": some["class"], "keys": list(keys)})

    rows = classes.select("class", "vector").mapInPandas(run, "class long, keys array<long>")
    return rows.select("class", F.explode("keys").alias("cell"))


def _cosine(a: str, b: str) -> Column:
    def sum_(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda total, v: total + v)

    dot = sum_(F.zip_with(a, b, lambda x, y: x * y))
    return dot / (F.sqrt(sum_(F.transform(a, lambda x: x * x))) * F.sqrt(sum_(F.transform(b, lambda x: x * x))))


def links(classes: DataFrame, least: float, lattice: Lattice = Lattice()) -> DataFrame:
    """Pairs (a, b), a < b, of classes (class, vector) whose cosine is `least` or more, as far as the tables find them."""
    home, probe = _celled(classes, lattice, False), _celled(classes, lattice, True)
    # Spark can't foresee how many rows the cells become, so it is told not to broadcast them.
    pairs = home.withColumnRenamed("class", "h").join(probe.hint("merge"), "cell").where("h <> class").select(
        F.least("h", "class").alias("a"), F.greatest("h", "class").alias("b")).distinct()
    return pairs.join(classes.select(F.col("class").alias("a"), F.col("vector").alias("va")), "a").join(
        classes.select(F.col("class").alias("b"), F.col("vector").alias("vb")), "b").where(
        (F.size("va") == F.size("vb")) & (_cosine("va", "vb") >= least)).select("a", "b")


def near_vectors(rows: DataFrame, least: float = 0.9, lattice: Lattice = Lattice(), vec_id: str = "vec_id",
                 vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    A vector that is NULL, empty or zero, or holds a NULL or non-finite component, links with nothing, and neither do
    vectors of different lengths. Equal vectors always link. Rows that repeat an id count as vectors of their own. A row
    with a NULL id belongs to its component and names it only, as NULL, where no row has an id.
    """
    prepared(rows.sparkSession)
    table = rows.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    classes = written(table.where(_valid("vector")).groupBy("vector").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).withColumn(
        "class", F.monotonically_increasing_id()), "classes")
    found = written(links(classes, least, lattice), "found")
    sizes = classes.select("class", "n")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class")).agg(
        F.sum("n").alias("others"))
    rooted = classes.select("class", "first_id", "n").join(
        components(found).withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class"))
    names = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "names")
    named = written(rooted.join(others, "class", "left").join(names, "root").select(
        "class", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"), "named")
    facts = written(classes.select("class", "vector").join(named, "class").drop("class"), "facts")
    linked = table.where(_valid("vector")).join(facts, "vector").select("id", "n_links", "component_id")
    alone = table.where(~_valid("vector")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
