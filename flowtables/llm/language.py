"""Language of texts and of the spans inside them.

Every word gets a score per language: the log-probabilities of its character trigrams, learned from labelled texts. The
script of its letters narrows the candidates first: a language that hardly uses that script is out. Viterbi's method then
finds the sequence of languages with the highest sum of word scores less a penalty for every switch, which gives spans; the
language with the most letters is the text's.

Words are found and scored in arrays over many texts at a time, and Viterbi steps through the words of many texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import prepared, text_of

# First and last code points of the letters of common scripts, from the Unicode block list.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF), (0xFB1D, 0xFB4F))),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x900, 0x97F), (0xA8E0, 0xA8FF))),
    ("bengali", ((0x980, 0x9FF),)),
    ("tamil", ((0xB80, 0xBFF),)),
    ("telugu", ((0xC00, 0xC7F),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
BUCKETS = 1 << 18  # of trigrams
CHARS = 1_000_000  # characters scored at a time
NONE = "und"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: is it a letter, its lower case, its script (0: another one)."""
    points = range(0x110000)
    letter = np.fromiter((chr(c).isalpha() for c in points), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(letter).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            lower[c] = ord(low)
    script = np.zeros(0x110000, np.int8)
    for i, (_, ranges) in enumerate(SCRIPTS, 1):
        for first, last in ranges:
            script[first:last + 1] = i
    return letter, lower, script


@dataclass(frozen=True)
class Words:
    """Words of several texts: their first trigram, the text and place they are in, letters and script; and all trigrams."""

    trigrams: np.ndarray
    first: np.ndarray
    text: np.ndarray
    start: np.ndarray
    letters: np.ndarray
    script: np.ndarray


def words_of(texts: Sequence[str]) -> Words:
    letter, lower, script = _tables()
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    mask = letter[points]
    before = np.concatenate([[False], mask[:-1]])
    place = np.flatnonzero(mask | before)  # the letters of a word and the character after it
    low = np.where(mask, lower[points], 0).astype(np.uint64)
    # Characters before a word's first letter count as 0; `low` is 0 there already, but not two places back.
    one = low[place - 1] * (place > 0)
    two = low[place - 2] * ((place > 1) & (one > 0))
    mixed = (two * np.uint64(0x9E3779B97F4A7C15) ^ one * np.uint64(0xC2B2AE3D27D4EB4F)) + low[place] * np.uint64(0x165667B19E3779F9)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    starts = np.flatnonzero((mask & ~before)[place])
    begin = place[starts]
    ends = np.append(starts[1:], len(place))
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
    text = np.searchsorted(offsets, begin, side="right") - 1
    return Words((mixed >> np.uint64(46)).astype(np.int64), starts, text, begin - offsets[text],
                 ends - starts - 1, script[points[begin]].astype(np.int64))


@dataclass(frozen=True)
class Model:
    """Log-probabilities of trigrams per language, and which languages use a script; `switch` is the penalty."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray
    switch: float = 16.0

    def words(self, texts: Sequence[str]) -> tuple[Words, np.ndarray]:
        words = words_of(texts)
        if not len(words.first):
            return words, np.zeros((0, len(self.languages)), np.float32)
        scores = np.add.reduceat(self.scores[words.trigrams], words.first, axis=0)
        return words, np.where(self.allowed[words.script], scores, np.float32(-1e6))


def trained(docs: DataFrame, languages: str = "lang", text: str = "text", each: int = 12_000, least: float = 0.01,
            switch: float = 16.0) -> Model:
    """Learn from about `each` distinct texts of every label, all of them where a label has no more; NULL labels are left out.

    A text that several rows of a label repeat counts once. Larger labels are thinned by a hash of the text. The sample is all
    that is bounded: its texts are counted whole, in tasks, and only sums and a number per label come to the driver.
    """
    labelled = docs.where(F.col(languages).isNotNull()).select(F.col(languages).alias("lang"), text_of(text).alias("text")).withColumn(
        "hash", F.shiftrightunsigned(F.xxhash64("text"), 1))
    sizes = labelled.select("lang", "hash").distinct().groupBy("lang").count().where(F.col("count") > each).collect()
    sample = labelled
    if sizes:
        limit = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], (each << 63) // r["count"])])[F.col("lang")]
        sample = labelled.where(F.coalesce(F.col("hash") < limit, F.lit(True)))
    sample = sample.dropDuplicates(["lang", "hash"]).select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for name, part in frame.groupby("lang"):
                mine = sums.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
                for _, texts in in_blocks(part["text"].tolist()):
                    words = words_of(texts)
                    mine[:BUCKETS] += np.bincount(words.trigrams, minlength=BUCKETS)
                    mine[BUCKETS:] += np.bincount(words.script, words.letters, len(SCRIPTS) + 1).astype(np.int64)
        for name, mine in sums.items():
            used = np.flatnonzero(mine)
            yield pd.DataFrame({"lang": name, "bucket": used, "n": mine[used]})

    prepared(docs.sparkSession)
    counts = sample.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()  # at most BUCKETS rows per language
    names = tuple(sorted(counts["lang"].unique()))
    table = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(names)))
    if names:
        table[counts["bucket"], np.searchsorted(names, counts["lang"])] = counts["n"]
    grams, letters = table[:BUCKETS], table[BUCKETS:]
    seen = np.count_nonzero(grams.sum(axis=1)) + 1
    scores = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * seen)).astype(np.float32)
    shares = letters / np.maximum(letters.sum(axis=0), 1)
    allowed = shares >= least
    allowed[~allowed.any(axis=1)] = True  # a script that nobody uses tells nothing
    return Model(names, scores, allowed, switch)


def in_blocks(texts: Sequence[str], chars: int = CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about `chars` characters, and a longer text alone, with the first one's place."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, list(texts[start:i])
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, list(texts[start:])


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """A text in pieces of about CHARS characters that end between words."""
    letter, start = _tables()[0], 0
    while start < len(text):
        end = min(len(text), start + CHARS)
        while end < len(text) and letter[ord(text[end])] and letter[ord(text[end - 1])]:
            end += 1
        yield start, text[start:end]
        start = end


def best_path(scores: np.ndarray, text: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi: the language of each word, for the words of many texts (in order); `text` says whose word it is.

    Texts go side by side, the longest first, so that a step touches only those which still have words.
    """
    first = np.flatnonzero(np.diff(text, prepend=-1))
    length = np.diff(np.append(first, len(text)))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    best = scores[first].astype(np.float64)
    back = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    own = np.arange(scores.shape[1])
    running = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
    for step in range(1, len(running)):
        n = running[step]
        now = best[:n]
        top = now.argmax(axis=1)
        high = now[np.arange(n), top][:, None] - switch
        stay = now >= high
        rows = first[:n] + step
        back[rows] = np.where(stay, own, top[:, None])
        best[:n] = np.where(stay, now, high) + scores[rows]
    path = np.zeros(len(text), np.int64)
    state = best.argmax(axis=1) if len(length) else own
    for step in range(len(running) - 1, -1, -1):
        n = running[step]
        rows = first[:n] + step
        path[rows] = state[:n]
        state[:n] = back[rows, state[:n]]
    return path


def spans(texts: Sequence[str], model: Model) -> list[list[tuple[str, int, int, int]]]:
    """Per text its spans of one language: (language, first and last character, letters)."""
    if len(texts) == 1 and len(texts[0]) > CHARS:
        parts = [(at, *model.words([piece])) for at, piece in _pieces(texts[0])]
        start = np.concatenate([at + w.start for at, w, _ in parts])
        letters = np.concatenate([w.letters for _, w, _ in parts])
        scores = np.concatenate([s for _, _, s in parts])
        text = np.zeros(len(start), np.int64)
    else:
        words, scores = model.words(texts)
        start, letters, text = words.start, words.letters, words.text
    out: list[list[tuple[str, int, int, int]]] = [[] for _ in texts]
    if not len(start) or not model.languages:
        return out
    path = best_path(scores, text, model.switch)
    heads = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    tails = np.append(heads[1:], len(path)) - 1
    sums = np.add.reduceat(letters, heads)
    for h, t, n in zip(heads.tolist(), tails.tolist(), sums.tolist(), strict=True):
        out[text[h]].append((model.languages[path[h]], int(start[h]), int(start[t] + letters[t]), n))
    return out


def predicted(texts: Sequence[str], model: Model) -> list[tuple[str, float, list]]:
    """(language, share of the letters in it, spans) of each text; `und` and 0 for a text without letters."""
    out: list[tuple[str, float, list]] = []
    for _, block in in_blocks(texts):
        for found in spans(block, model):
            sums: dict[str, int] = {}
            for name, _, _, letters in found:
                sums[name] = sums.get(name, 0) + letters
            top = min(sums, key=lambda k: (-sums[k], k)) if sums else NONE
            out.append((top, sums[top] / sum(sums.values()) if sums else 0.0, [s[:3] for s in found]))
    return out


def has_letters(text: str = "text") -> Column:
    """Does the text hold a letter, as `words_of` sees them?"""
    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: any(map(str.isalpha, t)))

    return run(text_of(text))


def with_language(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str | Column] = ("*",),
                  with_spans: bool = False) -> DataFrame:
    """Add lang_pred, score and, if asked for, spans (language, first, last character) to the columns in `keep`.

    NULL and empty texts and texts without a letter are `und` with score 0. Ties go to the first language by name. Nothing but
    the text is used. Columns that already have these names are replaced.
    """
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded: BUCKETS numbers per language

    @F.pandas_udf("lang string, score double, spans array<struct<lang: string, first: long, last: long>>")
    def label(texts: pd.Series) -> pd.DataFrame:
        found = predicted(texts.tolist(), shared.value)
        return pd.DataFrame({
            "lang": [f[0] for f in found], "score": [f[1] for f in found],
            "spans": [[dict(zip(("lang", "first", "last"), s, strict=True)) for s in f[2]] if with_spans else [] for f in found]})

    out = docs.select(*keep, label(text_of(text)).alias("__found"))
    new = {"lang_pred": F.col("__found.lang"), "score": F.col("__found.score")}
    if with_spans:
        new["spans"] = F.col("__found.spans")
    return out.withColumns(new).drop("__found")
