"""License scan: phrases word by word, and an exact set-similarity join of text blocks with license templates.

A text is cut into overlapping blocks of words. A template matches a block that holds at least `least` of its distinct words.
To find all such pairs without comparing every pair, words are ordered by how many texts hold them, the rarest first:
* prefix filter: if a template with n words has to share k of them, any match shares one of its first n - k + 1 words;
* length filter: a block with fewer than k words of the templates' vocabulary can't match;
* positional filter: the first shared word's places in both ordered lists bound how many can still follow.
What is left is counted exactly. The templates are a parameter, so their index is as small as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import prepared, text_of

# Phrases and labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening or central sentences of public license texts and notices.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
             "published by the free software foundation"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable for any damages arising from the use of this software"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software "
              "and accompanying documentation covered by this license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under "
            "copyright law including all related and neighboring rights"),
    ("creative-commons", "this work is licensed under a creative commons attribution 4 0 international license"),
)
# Every byte of a word as itself, A-Z as a-z, all others as a space; bytes from 0x80 on are parts of other characters.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Scan:
    phrases: Mapping[str, str]
    templates: Sequence[tuple[str, str]]
    least: float = 0.8   # share of a template's distinct words that a block must hold
    block: int = 256     # words in a block
    step: int = 128      # words from one block to the next


DEFAULT = Scan(PHRASES, TEMPLATES)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits, lower-cased, and of characters beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def blocks_of(words: Sequence[bytes], scan: Scan) -> Iterator[tuple[int, Sequence[bytes]]]:
    """First word and words of each block; together they hold every run of `block - step` words."""
    for start in range(0, max(1, len(words) - scan.step), scan.step):
        yield start, words[start:start + scan.block]


class Index:
    """Templates by the words of their prefixes, in the order of `frequency` (texts that hold a word)."""

    def __init__(self, scan: Scan, frequency: Mapping[bytes, int]):
        sets = [(label, set(words_of(text))) for label, text in scan.templates]
        ordered = sorted({w for _, s in sets for w in s}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ordered)}
        self.templates = [(label, sorted(self.rank[w] for w in s), ceil(scan.least * len(s) - 1e-9)) for label, s in sets if s]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for i, (_, ranks, need) in enumerate(self.templates):
            for place, r in enumerate(ranks[:len(ranks) - need + 1]):
                self.prefix.setdefault(r, []).append((i, place))
        self.shortest = min((need for _, _, need in self.templates), default=1)
        self.hints = {ordered[r] for r in self.prefix}

    def matches(self, block: Sequence[bytes]) -> dict[int, float]:
        """Share of the template's words in the block, for every template that reaches its threshold."""
        own = sorted({self.rank[w] for w in block if w in self.rank})
        if len(own) < self.shortest:
            return {}
        found: dict[int, float] = {}
        seen: set[int] = set()
        held = set(own)
        for at, r in enumerate(own):
            for i, place in self.prefix.get(r, ()):
                if i in seen:
                    continue  # an earlier word of its prefix has already decided
                seen.add(i)
                _, ranks, need = self.templates[i]
                if 1 + min(len(ranks) - place - 1, len(own) - at - 1) < need:
                    continue
                shared = sum(x in held for x in ranks)
                if shared >= need:
                    found[i] = shared / len(ranks)
        return found


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    out, at = [], 0
    try:
        while True:
            at = words.index(phrase[0], at)
            if words[at:at + len(phrase)] == phrase:
                out.append(at)
            at += 1
    except ValueError:
        return out


def scanned_text(text: str, scan: Scan, index: Index) -> dict:
    words = words_of(text)
    present = set(words)
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in scan.phrases.items():
        parts = words_of(phrase)
        if parts and all(p in present for p in parts):
            found = _places(words, parts)
            if found:
                places += found
                base.add(label)
    spans = []
    if not index.hints.isdisjoint(present):
        for start, block in blocks_of(words, scan):
            for i, share in index.matches(block).items():
                label = index.templates[i][0]
                labels.add(label)
                score = max(score, share)
                spans.append({"label": label, "first_word": start, "words": len(block), "share": share})
    return {"n_words": len(words), "n_base": len(places), "first_word": min(places, default=None),
            "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | labels)), "score": 1.0 if places else score, "blocks": spans}


def word_frequencies(docs: DataFrame, scan: Scan = DEFAULT, text: str = "text") -> dict[bytes, int]:
    """How many texts hold each word of the templates; one number per such word comes to the driver."""
    vocabulary = {w for _, t in scan.templates for w in words_of(t)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = dict.fromkeys(vocabulary, 0)
        for frame in frames:
            for t in frame["text"]:
                for w in vocabulary.intersection(words_of(t)):
                    sums[w] += 1
        yield pd.DataFrame({"word": list(sums), "n": list(sums.values())})

    prepared(docs.sparkSession)
    rows = docs.select(text_of(text).alias("text")).mapInPandas(count, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")).collect()
    return {bytes(r[0]): r[1] for r in rows}


def license_scan(docs: DataFrame, scan: Scan = DEFAULT, keep: Sequence[str | Column] = ("*",), text: str = "text",
                 with_blocks: bool = False) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels, score and, if asked for, the matching blocks.

    `n_base` counts all places where a phrase's words follow each other, also overlapping ones; first_word and last_word are
    NULL without any. Labels are distinct, sorted and joined by commas, an empty string if there are none. The score is 1 with
    a phrase, else the largest share of a matching template, else 0. NULL text is empty. Columns with these names are replaced.
    """
    index = Index(scan, word_frequencies(docs, scan, text))
    kind = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
            "blocks array<struct<label: string, first_word: long, words: long, share: double>>")

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([scanned_text(t, scan, index) for t in texts], columns=[
            "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"])
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    out = docs.select(*keep, run(text_of(text)).alias("__scan"))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return out.withColumns({n: F.col(f"__scan.{n}") for n in names + ["blocks"] * with_blocks}).drop("__scan")


def oracle(scan: Scan = DEFAULT) -> str:
    """The query of `license_scan` over `documents` as SQL, without any filter."""
    quoted = lambda words: "[" + ", ".join("'" + w.decode() + "'" for w in words) + "]"
    phrases = ", ".join(f"({quoted(words_of(p))}, '{label}')" for p, label in scan.phrases.items())
    templates = ", ".join(f"({quoted(sorted(set(words_of(t))))}, '{label}')" for label, t in scan.templates)
    return f"""
with texts as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
phrases(words, label) as (values {phrases}),
templates(words, label) as (values {templates}),
places as (
  select doc_id, label, unnest(list_filter(range(1, len(t.words) - len(p.words) + 2),
    lambda i: list_slice(t.words, i, i + len(p.words) - 1) = p.words)) - 1 as place
  from texts t join phrases p on list_has_all(t.words, p.words)),
blocks as (
  select doc_id, list_distinct(list_slice(words, start + 1, start + {scan.block})) as held
  from (select *, unnest(range(0, greatest(1, len(words) - {scan.step}), {scan.step})) as start from texts)),
matches as (
  select doc_id, label, len(list_intersect(held, t.words)) / len(t.words)::double as share
  from blocks b join templates t on len(list_intersect(b.held, t.words)) >= ceil({scan.least} * len(t.words) - 1e-9)),
based as (
  select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels from places group by doc_id),
labelled as (
  select doc_id, string_agg(distinct label, ',' order by label) as labels from (
    select doc_id, label from places union select doc_id, label from matches) group by doc_id),
best as (select doc_id, max(share) as share from matches group by doc_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0)::double end as score
from texts left join based using (doc_id) left join labelled using (doc_id) left join best using (doc_id)
"""
