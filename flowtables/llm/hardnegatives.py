"""Hard negatives by threshold joins: anchors against all rows through an inverted index with norm bounds.

The rows of a batch form an index with a list of postings per dimension, the dimensions in the order of what they weigh in
the whole table, heaviest first. A row leaves its last dimensions out of the index as long as their norm alone could not
lift any anchor to its threshold. Partial scores are accumulated over the postings; a pair is dropped as soon as they and
the product of the two remaining norms stay below the anchor's threshold, and only what is left is completed from the
dimensions that the index omits. A threshold begins high, so that most pairs go early, and is lowered until the windows of
an anchor are full or it has come to their lower end; only anchors with open windows are joined again.

Anchors are a share of the rows, so they are taken in parts of a bounded size, and every part is held against all rows
where these are: a join of a part is one scan of the table, whose tasks hand on at most a window's length per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.common import discarded, prepared, written
from flowtables.session import new_folder

EXACT = 2.0 ** 53  # products below it are exact in double precision
SLACK = 1 + 1e-9   # of a bound made of rounded square roots
STEP = 16          # dimensions between two looks at the bounds
ANCHORS = 512      # anchors that are accumulated side by side
ROWS = 4_096       # rows of one index


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives an anchor gets, and where negatives lie: in percent of the positive's score."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    part: int = 32_768  # anchors that a task holds at once
    fall: float = 0.75  # of a threshold from one join to the next, first from a window's upper end


class Index:
    """Postings per dimension of up to ROWS vectors."""

    def __init__(self, vectors: np.ndarray, floor: float):
        """`floor`: the smallest threshold of any anchor, divided by the anchor's norm."""
        self.rest = _norms(vectors) * SLACK
        indexed = (self.rest[:, :-1] >= floor).sum(axis=1) if floor > 0 else np.full(len(vectors), vectors.shape[1])
        # With the rows that index most dimensions in front, the postings of a dimension are the first rows.
        self.order = np.argsort(-indexed, kind="stable")
        self.vectors, self.rest, self.indexed = vectors[self.order], self.rest[self.order], indexed[self.order]

    def reaching(self, anchors: np.ndarray, rest: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs whose score is at least the anchor's threshold."""
        size = self.vectors.shape[1]
        partial = np.zeros((len(anchors), len(self.vectors)))
        deepest = int(self.indexed.max(initial=0))
        at, pairs = 0, None
        while at < deepest:
            to = min(at + STEP, deepest)
            listed = int(np.searchsorted(-self.indexed, -at, side="left"))  # rows with a posting in any of these dimensions
            seen = np.minimum(self.indexed, to)
            if pairs is None:
                block = self.vectors[:listed, at:to] * (np.arange(at, to) < self.indexed[:listed, None])
                partial[:, :listed] += anchors[:, at:to] @ block.T
                # What a pair can still gain: per row, from the first of its dimensions that is not counted yet.
                gain = rest[:, np.unique(seen)]
                column = np.searchsorted(np.unique(seen), seen)
                alive = partial + gain[:, column] * self.rest[np.arange(len(seen)), seen] >= least[:, None]
                if to == deepest or np.count_nonzero(alive) * 8 < alive.size:
                    a, r = np.nonzero(alive)
                    pairs = a, r, partial[a, r]
            else:
                a, r, score = pairs
                mask = np.arange(at, to) < self.indexed[r][:, None]
                score = score + np.einsum("ij,ij->i", anchors[a, at:to], np.where(mask, self.vectors[r, at:to], 0))
                keep = score + rest[a, seen[r]] * self.rest[r, seen[r]] >= least[a]
                pairs = a[keep], r[keep], score[keep]
            at = to
        if pairs is None:  # nothing is indexed: no row can reach any threshold
            a = r = np.zeros(0, np.int64)
            return a, r, np.zeros(0)
        a, r, score = pairs
        for dimension in range(int(self.indexed.min(initial=size)), size):  # what the index omits
            omitted = self.indexed[r] <= dimension
            score = score + np.where(omitted, anchors[a, dimension] * self.vectors[r, dimension], 0)
        keep = score >= least[a]
        return a[keep], self.order[r[keep]], score[keep]


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Per row the norm from each dimension to the end, and 0 behind it."""
    tail = np.sqrt(np.cumsum(np.square(vectors)[:, ::-1], axis=1)[:, ::-1])
    return np.concatenate([tail, np.zeros((len(vectors), 1))], axis=1)


WINDOW = ["anchor", "window"]
FOUND = "anchor long, window int, number long, id long, nameless boolean, score long"
COLUMNS = [c.split()[0] for c in FOUND.split(", ")]


def _best(found: pd.DataFrame, most: int) -> pd.DataFrame:
    """The first `most` rows per window: higher scores first, then smaller ids, a NULL id last."""
    found = found.sort_values([*WINDOW, "score", "nameless", "id"], ascending=[True, True, False, True, True], kind="stable")
    return found[found.groupby(WINDOW, sort=False).cumcount() < most]


class Anchors:
    """Anchors of one length with open windows: (anchor, window, least, most), scores from `least` to `most`.

    In a window are rows of the anchor's own group if `same`, else of other groups.
    """

    def __init__(self, table: pd.DataFrame, windows: pd.DataFrame, order: np.ndarray, same: bool):
        self.order, self.same, self.windows = order, same, windows
        table = table.merge(windows.groupby("anchor", as_index=False)["least"].min(), left_on="number", right_on="anchor")
        self.number, self.group = table["number"].to_numpy(), table["group"].to_numpy()
        self.vectors, self.least = np.stack(table["vector"].to_list())[:, order], table["least"].to_numpy(np.float64)
        self.rest = _norms(self.vectors)

    def met(self, rows: pd.DataFrame, most: int) -> pd.DataFrame:
        """The best rows per window among these, which are of the same length."""
        vectors = np.stack(rows["vector"].to_list())[:, self.order]
        columns = {c: rows[c].to_numpy() for c in ("number", "id", "nameless", "group")}
        out = []
        for at in range(0, len(self.number), ANCHORS):
            some = slice(at, at + ANCHORS)
            with np.errstate(divide="ignore", invalid="ignore"):
                floor = np.where(self.least[some] > 0, self.least[some] / self.rest[some, 0], 0).min()
            a, r, score = Index(vectors, floor).reaching(self.vectors[some], self.rest[some], self.least[some])
            a = a + at
            same = self.group[a] == columns["group"][r]
            keep = same & (self.number[a] != columns["number"][r]) if self.same else ~same
            a, r = a[keep], r[keep]
            found = pd.DataFrame({"anchor": self.number[a], "number": columns["number"][r], "id": columns["id"][r],
                                  "nameless": columns["nameless"][r], "score": score[keep].astype(np.int64)})
            found = found.merge(self.windows, on="anchor")
            out.append(_best(found[found["score"].between(found["least"], found["most"])][COLUMNS], most))
        return pd.concat(out)


def _joined(rows: DataFrame, anchors: dict[int, Anchors], most: int) -> DataFrame:
    """FOUND rows: the best `most` per window among every task's rows. One scan; nothing is shuffled."""
    held = rows.sparkSession.sparkContext.broadcast(anchors)  # bounded by Mining.part anchors

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({c: [] for c in COLUMNS})
        for frame in frames:
            sizes = frame["vector"].map(len)
            for size, part in held.value.items():
                some = frame[sizes == size]
                for at in range(0, len(some), ROWS):
                    met = part.met(some.iloc[at:at + ROWS], most)
                    best = _best(pd.concat([best, met]) if len(best) else met, most)
        if len(best):
            yield best

    return rows.select("number", "id", "nameless", "group", "vector").mapInPandas(run, FOUND)


def _filled(rows: DataFrame, table: pd.DataFrame, windows: pd.DataFrame, order: np.ndarray, same: bool, most: int,
            fall: float) -> list[DataFrame]:
    """Written tables of (FOUND, rank) that together hold the best `most` rows of every window.

    `windows`: anchor, window, need (rows that fill it, `most` at most), low and high (the ends of the scores in it), top
    (where its threshold starts to fall; 0 or less: at its lower end). A window is joined until it is full or its threshold
    is its lower end.
    """
    spark, out = rows.sparkSession, []
    windows = windows.assign(least=np.where(windows["top"] * fall > windows["low"], windows["top"] * fall, windows["low"]), most=windows["high"])
    sizes = table["vector"].map(len)
    while len(windows):
        open_ = windows[[*WINDOW, "least", "most"]]
        anchors = {int(size): Anchors(part, open_, order[order < size], same) for size in sizes.unique()
                   if (part := table[(sizes == size) & table["number"].isin(open_["anchor"])]) is not None and len(part)}
        by = [F.desc("score"), "nameless", "id", "number"]
        ranked = _joined(rows, anchors, most).withColumn("rank", F.row_number().over(Window.partitionBy(*WINDOW).orderBy(*by)))
        found = written(ranked.where(F.col("rank") <= most), "mined")
        # One number per window of the part.
        counts = found.groupBy(*WINDOW).agg(F.count(F.lit(1)).alias("n")).toPandas()
        windows = windows.merge(counts, on=WINDOW, how="left").fillna({"n": 0})
        done = (windows["n"] >= windows["need"]) | (windows["least"] <= windows["low"])
        closed = spark.createDataFrame(windows.loc[done, WINDOW].astype({"window": "int32"}), "anchor long, window int")
        out.append(found.join(F.broadcast(closed), WINDOW, "left_semi"))  # bounded by the part's windows
        out[-1].written_to = found.written_to
        windows = windows[~done].drop(columns="n")
        least = windows["least"] * fall
        windows = windows.assign(least=np.where(least > np.maximum(windows["low"], windows["top"] / 10), least, windows["low"]))
    return out


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def hard_negatives(rows: DataFrame, is_anchor: Column, mining: Mining = Mining(), vec_id: str = "vec_id",
                   vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    Components must be whole numbers and labels fit a long; a score is the inner product. An anchor's positives are the
    first other rows of its label, its negatives per positive the first rows of other labels whose scores lie between `low`
    and `high` percent of the positive's; higher scores first, ties by smaller id, a NULL id last. Positives with a negative
    score have no negatives. Rows with a NULL label or a vector that is NULL, empty, holds a NULL or non-finite component, or
    is so long (2^26.5) that products aren't exact take no part; vectors of different lengths don't meet. Rows that repeat an
    id are rows of their own, as anchors too. Empty tables, and such without anchors, positives or negatives, give no rows.
    """
    spark = prepared(rows.sparkSession)
    taken = rows.select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(0)).alias("id"), F.col(vec_id).isNull().alias("nameless"),
        F.col(label).cast("long").alias("group"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).where(F.col("group").isNotNull() & _usable("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    table = written(taken.withColumn("square", square).where(F.col("square") < EXACT).withColumn(
        "number", F.monotonically_increasing_id()), "rows")
    weights = table.select(F.posexplode("vector")).groupBy("pos").agg(F.sum(F.col("col") * F.col("col")).alias("w")).collect()
    order = np.array([r.pos for r in sorted(weights, key=lambda r: (-r.w, r.pos))], dtype=np.int64)  # one per dimension
    peers = table.groupBy("group", F.size("vector").alias("size")).agg(
        (F.count(F.lit(1)) - 1).alias("others"), F.sqrt(F.max("square")).alias("longest"))
    chosen = written(table.where("is_anchor").withColumn("size", F.size("vector")).join(peers, ["group", "size"]).where(
        "others > 0").select("number", "id", "nameless", "group", "vector", F.least("others", F.lit(mining.positives)).alias("need"),
                             (F.sqrt("square") * F.col("longest")).alias("top")), "anchors")
    parts = -(-chosen.count() // mining.part)
    path, spent = new_folder(spark, "negatives"), [table, chosen]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for number in range(parts):
        anchors = chosen.where(F.pmod(F.xxhash64("number"), F.lit(parts)) == number).toPandas()
        anchors["vector"] = anchors["vector"].map(np.asarray)
        own = anchors.rename(columns={"number": "anchor"}).assign(window=0, low=-np.inf, high=np.inf)
        tables = _filled(table, anchors, own[[*WINDOW, "need", "low", "high", "top"]], order, True, mining.positives, mining.fall)
        spent += tables
        positives = _union(tables).toPandas().drop(columns=["window", "number"]).rename(columns={"rank": "window"})
        low, high = -(-mining.low * positives["score"] // 100), mining.high * positives["score"] // 100
        windows = positives.assign(need=mining.negatives, low=low, high=high, top=high)
        windows = windows[(windows["score"] >= 0) & (low <= high)]
        if not len(windows):
            continue
        tables = _filled(table, anchors, windows[[*WINDOW, "need", "low", "high", "top"]], order, False, mining.negatives, mining.fall)
        spent += tables
        names = spark.createDataFrame(
            windows.merge(anchors[["number", "id"]], left_on="anchor", right_on="number", suffixes=("", "_of"))[
                ["anchor", "window", "id_of", "id", "nameless", "score"]],
            "anchor long, window int, anchor_id long, positive_id long, no_positive boolean, positive_score long")
        _union(tables).join(F.broadcast(names), WINDOW).select(  # bounded by the part's windows
            "anchor_id", F.when(~F.col("no_positive"), F.col("positive_id")).alias("positive_id"), "rank",
            F.when(~F.col("nameless"), F.col("id")).alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    discarded(*spent)
    return spark.read.schema(schema).parquet(path)


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def relabelled(rows: DataFrame, every: int = 7, classes: int = 10, scale: int = 256, vec_id: str = "vec_id",
               vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, embedding): components as floor(scale * x), and (label + 1) % classes for ids that `every` divides.

    A NULL or non-finite component, and one that no long holds once scaled, makes a NULL of its vector.
    """
    moved = (F.coalesce(F.col(vec_id) % every == 0, F.lit(False)))
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    return rows.select(
        F.col(vec_id), F.when(moved, (F.col(label) + 1) % classes).otherwise(F.col(label)).alias(label),
        F.when(_usable(vector), scaled).alias(vector))


def oracle() -> str:
    """All scores of the anchors with all rows, as SQL."""
    return """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::bigint as score
  from usable a join usable b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
found as (
  select p.anchor_id, p.positive_id, n.other_id as negative_id, p.positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) as rank
  from positives p join scores n on n.anchor_id = p.anchor_id and not n.same
  where 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 3
"""
