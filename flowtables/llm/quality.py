"""Quality by compression: is a text shorter with a dictionary of good texts or with one of bad texts?

Two zstandard dictionaries are trained, on texts labelled good and bad. A text is compressed with either, in blocks so that
the dictionary matters throughout, and the difference of the sizes over their sum is the feature. A logistic curve, fitted
on labelled texts that no dictionary has seen, turns it into a score from 0 to 1.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import prepared, text_of


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample that a classifier is fitted on."""

    texts: int = 1_200         # per class and use (dictionary, calibration), chosen by a hash of the key
    longest: int = 20_000      # characters of a text to learn from; longer texts are scored, not learned
    dictionary: int = 262_144  # bytes
    level: int = 3
    block: int = 8_192         # bytes compressed at a time


@dataclass(frozen=True)
class Classifier:
    good: bytes
    bad: bytes
    slope: float
    bias: float
    level: int
    block: int

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for data in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=self.level)
            out.append(zstandard.ZstdCompressor(level=self.level, dict_data=known, write_content_size=False,
                                                write_checksum=False, write_dict_id=False))
        return out[0], out[1]

    def features(self, texts: list[str]) -> np.ndarray:
        """(bad size - good size) / (bad size + good size); 0 for an empty text."""
        good, bad = self.compressors()
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            data, a, b = text.encode("utf-8", "surrogatepass"), 0, 0
            for at in range(0, len(data), self.block):
                part = data[at:at + self.block]
                a += len(good.compress(part))
                b += len(bad.compress(part))
            out[i] = (b - a) / (a + b) if a else 0.0
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * features + self.bias, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Newton's method with a slight pull to 0, on the standardised feature."""
    scale = x.std() or 1.0
    inputs = np.stack([x / scale, np.ones_like(x)], axis=1)
    at = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(inputs @ at, -40, 40)))
        slope = inputs.T @ (weight * (p - y)) + 1e-3 * at
        curve = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(curve, slope)
    return float(at[0] / scale), float(at[1])


def fitted(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), key: str = "doc_id", text: str = "text",
           label: str = "quality") -> Classifier | None:
    """Fit on the texts of rows that `labels` (key, label) calls 1 (good) or 0 (bad); others and NULL are not used.

    The sample is drawn from the labels of texts that are there and not longer than `longest`; only ids are shuffled for it.
    None, with a warning, if either class has fewer than eight texts to learn from.
    """
    short = (F.length(text) > 0) & (F.length(text) <= fit.longest)
    there = docs.where(short).select(F.col(key).alias("key"))
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isin(0, 1)).distinct().join(there, "key", "left_semi").withColumns({
            "use": F.pmod(F.xxhash64("key", F.lit(11)), F.lit(2)).cast("int"), "order": F.xxhash64("key", F.lit(7))})
    counts = {(r[0], r[1]): r[2] for r in rows.groupBy("label", "use").count().collect()}
    uses = ((0, 0), (1, 0), (0, 1), (1, 1))
    sample = reduce(DataFrame.unionByName, [
        rows.where((F.col("label") == a) & (F.col("use") == b)).orderBy("order", "key").limit(fit.texts) for a, b in uses])
    # Bounded: at most 4 * texts keys are broadcast, and as many texts of at most `longest` characters come to the driver.
    found = docs.where(short).select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key").select(
        "label", "use", "order", "text").dropDuplicates(["label", "use", "order"])
    parts: dict[tuple[int, int], list[str]] = {u: [] for u in uses}
    for a, b, _, t in sorted(found.collect()):
        parts[a, b].append(t)
    if min(len(parts[0, 0]), len(parts[1, 0])) < 8 or not parts[0, 1] or not parts[1, 1]:
        warnings.warn("too few labelled texts to learn from: no model", stacklevel=2)
        return None
    good, bad = (_dictionary(parts[k, 0], fit.dictionary) for k in (1, 0))
    raw = Classifier(good, bad, 1.0, 0.0, fit.level, fit.block)
    x = raw.features(parts[0, 1] + parts[1, 1])
    y = np.repeat([0.0, 1.0], [len(parts[0, 1]), len(parts[1, 1])])
    # The samples are equally large; weights bring back the shares of the classes.
    weight = np.repeat([counts[0, 1] / len(parts[0, 1]), counts[1, 1] / len(parts[1, 1])],
                       [len(parts[0, 1]), len(parts[1, 1])])
    slope, bias = _logistic(x, y, weight / weight.mean())
    return Classifier(good, bad, slope, bias, fit.level, fit.block)


def _dictionary(texts: list[str], size: int) -> bytes:
    samples = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = max(1_024, min(size, sum(map(len, samples)) // 8))  # a dictionary as large as its sample learns nothing
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the samples themselves, latest last
        return b"".join(samples)[-size:]


def scored(docs: DataFrame, model: Classifier | None, keep: tuple[str | Column, ...] = ("*",), text: str = "text",
           threshold: float = 0.3) -> DataFrame:
    """Add score (0 to 1) and predicted (1 if score >= threshold) to the columns in `keep`; such columns are replaced.

    Whole texts are compressed. NULL and empty texts have the score of the feature 0, and without a model all texts score 0.5.
    """
    prepared(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.full(len(texts), 0.5))
        return pd.Series(model.scores(model.features(texts.tolist())))

    out = docs.select(*keep, score(text_of(text)).alias("__score"))
    return out.withColumns({
        "score": F.col("__score"), "predicted": (F.col("__score") >= threshold).cast("int")}).drop("__score")
