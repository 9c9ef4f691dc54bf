"""Spelling variants: words one edit apart, found by a frontier of states that walks a trie, and the forms they stand for.

The trie of all words is a table of edges (node, letter, child); a node is the hash of a prefix. States (word, position,
node, edits) are joined with the edges of their depth, level by level: a state without an edit follows its own letter, or
takes one edit; a state with one follows its letters until its word ends at a node where a word ends. Two words one edit
apart share the first half of one of them or its second half, so a word's walk begins at the node of its first half, where
few words are left, and, in the trie of the reversed words, at that of its second half; edits come after that node only.

An edge knows, as a mask of 256 bits, the hashes of what the words below it go on with, and a state takes an edge only if
the rest of its own word is among them. The mask only saves joins: what is found is looked up among the words in the end.
A step that inserts, deletes or replaces is taken at the last place of a run of equal letters, so each neighbour is met once
from each side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import discarded, prepared, text_of, written
from flowtables.llm.components import _rooted
from flowtables.session import new_folder

BITS = 256  # of an edge's mask, in columns of 64
BELOW = [f"below{k}" for k in range(BITS // 64)]
LONGEST = 64  # letters of a word that walks the trie: there are as many joins as letters
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PRIMES = ((2_147_483_647, 1_000_003), (2_147_483_629, 998_244_353))  # modulus and base of two rolling hashes


def _lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else; the quick way where all letters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def vocabulary(docs: DataFrame, letters: int = 7, occurrences: int = 2, noise: int = 31, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, of at least `letters` code points and `occurrences` in all texts.

    Where `noise` divides the hash of a document's id and a run, the run loses one letter there. A NULL id is an empty one,
    NULL text has no words.
    """
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        text_of(text), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{letters},}}"), F.lit(0))).alias("run"))
    found = runs.select("id", _lowered(F.col("run")).alias("run")).select(
        "run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.select(F.when(F.col("h") % noise == 0, less).otherwise(F.col("run")).alias("word")).where(
        F.char_length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= occurrences)


def _spot(rest: Column) -> Column:
    """Which of the BITS of a mask stands for the rest of a word."""
    return F.pmod(F.xxhash64(rest), F.lit(BITS)).cast("int")


def _masks(spot: Column) -> list[Column]:
    """The mask of one rest, 64 bits to a column."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), spot % 64)
    return [F.when(F.floor(spot / 64) == k, bit).otherwise(F.lit(0).cast("long")) for k in range(BITS // 64)]


def _among(spot: Column) -> Column:
    """Is the rest at that spot among those of the edge's mask?"""
    part = F.col("below0")
    for k in range(1, BITS // 64):
        part = F.when(spot >= 64 * k, F.col(f"below{k}")).otherwise(part)
    return F.getbit(part, spot % 64) == 1


def _node(way: Column, prefix: Column) -> Column:
    return F.xxhash64(prefix, way)


def _letter(word: Column, at: Column) -> Column:
    """Letter at a place from 0, empty behind the end."""
    return F.substring(word, at + 1, F.lit(1))


def _rest(word: Column, at: Column) -> Column:
    return F.substring(word, at + 1, F.lit(LONGEST))


def _ways(words: DataFrame) -> DataFrame:
    """(size, way, w, half): every word as it is and reversed, with the depth where its walk begins."""
    size = F.char_length("word")
    both = F.explode(F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("w"), F.floor(size / 2).cast("int").alias("half")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("w"), F.ceil(size / 2).cast("int").alias("half"))))
    return words.where(size <= LONGEST).select(size.alias("size"), both.alias("x")).select("size", "x.*")


def _edges(words: DataFrame) -> DataFrame:
    """The edge table in a folder per depth, as far as walks of words of nearly the same length can come."""
    at = F.col("at")
    rows = _ways(words).select(
        "way", "w", "size", F.explode(F.sequence(F.floor((F.col("size") - 1) / 2).cast("int"), F.col("size") - 1)).alias("at"))
    edges = rows.select(
        at.alias("depth"), _node(F.col("way"), F.substring("w", F.lit(1), at)).alias("node"), _letter(F.col("w"), at).alias("letter"),
        _node(F.col("way"), F.substring("w", F.lit(1), at + 1)).alias("child"), _spot(_rest(F.col("w"), at + 1)).alias("spot"),
        (at + 1 == F.col("size")).alias("ends")).select("*", *[m.alias(n) for m, n in zip(_masks(F.col("spot")), BELOW, strict=True)])
    merged = edges.groupBy("depth", "node", "letter", "child").agg(*[F.bit_or(n).alias(n) for n in BELOW], F.max("ends").alias("ends"))
    return _by_folder(merged, "depth", "trie")


def _by_folder(df: DataFrame, column: str, name: str) -> DataFrame:
    """The rows as a table with a folder per value of a column, so that a level reads its own rows only."""
    path = new_folder(df.sparkSession, name)
    df.write.partitionBy(column).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def _followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: the states (way, w, size, at, node, seen) that follow from an edge, `seen` the other word or NULL.

    `done` marks those whose word ends at a node where another word ends.
    """
    at, w = F.col("at"), F.col("w")
    asked = states.select(
        "*", _letter(w, at).alias("l0"), _letter(w, at + 1).alias("l1"),
        *[_spot(_rest(w, at + k)).alias(f"s{k}") for k in (0, 1, 2)])
    fits = {k: _among(F.col(f"s{k}")) for k in (0, 1, 2)}
    own, other, edited = F.col("letter") == F.col("l0"), F.col("letter") != F.col("l0"), F.col("seen").isNotNull()
    goes_on = edited & own & fits[1]
    inserts, replaces = ~edited & other & fits[0], ~edited & other & (at < F.col("size")) & fits[1]
    deletes = ~edited & other & (F.col("letter") == F.col("l1")) & fits[2]
    joined = asked.join(edges.select("node", "letter", "child", *BELOW, "ends"), "node").where(
        goes_on | (~edited & own) | inserts | replaces | deletes)

    def state(test: Column, step: int, seen: Column) -> Column:
        end = at + step == F.col("size")
        return F.when(test, F.struct((at + step).alias("at"), seen.alias("seen"), (seen.isNotNull() & end & F.col("ends")).alias("done")))

    before = F.substring("w", F.lit(1), at)
    steps = F.array_compact(F.array(
        state(goes_on | (~edited & own), 1, F.col("seen")),
        state(inserts, 0, F.concat(before, "letter", _rest(w, at))),
        state(replaces, 1, F.concat(before, "letter", _rest(w, at + 1))),
        state(deletes, 2, F.concat(before, _rest(w, at + 1)))))
    return joined.select("way", "w", "size", F.col("child").alias("node"), F.col("ends"), F.explode(steps).alias("s")).select(
        "way", "w", "size", "s.at", "node", "ends", "s.seen", "s.done")


def _walked(words: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Tables of (word, near) by the trie, for words of at most LONGEST letters, and the written tables they rest on."""
    edges = _edges(words)
    starts = _by_folder(_ways(words), "half", "starts")
    first, last = starts.agg(F.min("half"), F.max("size")).first()
    levels, frontier = [], None
    for depth in range(first or 0, (last or -1) + 1):  # no level for an empty table
        half = F.col("half")
        states = starts.where(half == depth).select(
            "way", "w", "size", half.alias("at"), _node(F.col("way"), F.substring("w", F.lit(1), half)).alias("node"),
            F.lit(None).cast("string").alias("seen"))
        if frontier is not None:
            # At its word's end a state can insert one more letter, if it has no edit yet.
            goes_on = ~F.col("done") & (F.col("seen").isNull() | (F.col("at") < F.col("size")))
            states = states.unionByName(frontier.where(goes_on).select(*states.columns))
        frontier = written(_followed(states, edges.where(F.col("depth") == depth)), "frontier")
        levels.append(frontier)
    forwards = F.col("way") == 0
    half = F.floor(F.col("size") / 2).cast("int")
    found = []
    for level in levels:
        less = F.substring("w", F.lit(1), F.col("size") - 1)  # the word without its last letter ends here
        short = F.col("seen").isNull() & (F.col("at") == F.col("size") - 1) & F.col("ends")
        seen = level.where(F.col("done") | short).select("way", "w", half.alias("half"), F.coalesce("seen", less).alias("seen"))
        near = seen.select("way", "half", *[F.when(forwards, F.col(x)).otherwise(F.reverse(x)).alias(y)
                                            for x, y in (("w", "word"), ("seen", "near"))])
        # What shares the first half was found forwards already.
        again = F.substring("word", F.lit(1), F.col("half")) == F.substring("near", F.lit(1), F.col("half"))
        found.append(near.where(forwards | ~again).select("word", "near"))
    return found, [*levels, starts, edges]


def _deletions(words: DataFrame) -> DataFrame:
    """(number, at, key): a rolling hash of each word without its letter `at`, and of the whole word at -1.

    A run of equal letters gives the same hash at every place; all are there, as words that differ in one letter meet at
    its place. Work and rows are as many as there are letters.
    """
    def hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number, word in zip(frame["number"], frame["word"], strict=True):
                letters = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.int64)
                key = np.zeros(len(letters) + 1, np.int64)
                for modulus, base in PRIMES:
                    powers = np.ones(len(letters), np.int64)
                    done = 1
                    while done < len(letters):  # doubles the known powers
                        step = pow(base, done, modulus)
                        powers[done:2 * done] = powers[:done][:len(letters) - done] * step % modulus
                        done *= 2
                    sums = np.concatenate([[0], np.cumsum(letters * powers % modulus) % modulus])
                    after = (sums[-1] - sums[1:]) % modulus * pow(base, -1, modulus) % modulus
                    key = key * modulus + np.append((sums[:-1] + after) % modulus, sums[-1])
                at = np.append(np.arange(len(letters)), -1)
                for i in range(0, len(at), 100_000):
                    yield pd.DataFrame({"number": number, "at": at[i:i + 100_000], "key": key[i:i + 100_000]})

    return words.select(F.xxhash64("word").alias("number"), "word").mapInPandas(hashes, "number long, at long, key long")


def _long_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for words of LONGEST letters and more, by hashes of each word without one letter."""
    rows = written(_deletions(words), "deletions")
    whole, less = rows.where("at < 0").select(F.col("number").alias("b"), "key"), rows.where("at >= 0")
    same_place = less.select(F.col("number").alias("b"), "at", "key")
    one = less.select(F.col("number").alias("a"), "at", "key")
    shorter = one.join(whole, "key").select("a", "b")
    pairs = one.join(same_place, ["key", "at"]).select("a", "b").unionByName(shorter).unionByName(
        shorter.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    a = words.select(F.xxhash64("word").alias("a"), "word")
    b = words.select(F.xxhash64("word").alias("b"), F.col("word").alias("near"))
    out = written(pairs.join(a, "a").join(b, "b").where(F.levenshtein("word", "near", 1) == 1).select("word", "near"), "long")
    discarded(rows)
    return out


def near_words(words: DataFrame, word: str = "word") -> DataFrame:
    """(word, near): all ordered pairs of the distinct words that differ by one inserted, deleted or replaced code point.

    Words need four code points; shorter, NULL and empty ones have no pair. Words longer than LONGEST, for which a level per
    letter would be too many, meet by rolling hashes of all but one letter instead. No words give no pairs.
    """
    prepared(words.sparkSession)
    words = words.select(F.col(word).alias("word"))
    size = F.char_length("word")
    found, tables = _walked(words.where(size >= 4))
    long = words.where(size >= LONGEST)
    if not long.isEmpty():
        extra = _long_pairs(long)
        # Two words of exactly LONGEST letters have met in the trie.
        found.append(extra.where((size > LONGEST) | (F.char_length("near") > LONGEST)))
        tables.append(extra)
    pairs = words.select("word", F.col("word").alias("near")).limit(0)
    for table in found:
        pairs = pairs.unionByName(table)
    # The masks let through what ends nowhere; every pair is looked up.
    out = written(pairs.join(words.select(F.col("word").alias("near")), "near").select("word", "near"), "near")
    discarded(*tables)
    return out


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with counts (word, n).

    A word's form is its near word of the largest n, among equals the smallest in code-point order, if that n is `ratio`
    times the word's n or more. Forms lead to ever larger n, so they end at a root.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    met = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    large = -F.col("best.less") >= F.col("n") * ratio
    formed = written(words.join(met, "word", "left").select(
        "word", F.when(large, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, -F.col("best.less")).alias("form_n")), "formed")
    roots = _rooted(written(formed.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("root")), "roots"))
    out = formed.join(roots.select(F.col("node").alias("word"), "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    discarded(words, near)
    return out


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = 7, occurrences: int = 2,
                      noise: int = 31, ratio: int = 10) -> DataFrame:
    """The words of all texts with the forms they are variants of; see `vocabulary` and `variants`.

    Repeated rows count each, ties of a form go to the smallest word, very long texts and words are taken whole, and tables
    without words give no rows. Other columns of the table play no part, whatever their names.
    """
    return variants(vocabulary(docs, letters, occurrences, noise, doc_id, text), ratio)


def oracle() -> str:
    """The same by deleting every letter of every word in turn, as SQL; CRC-32 by half bytes."""
    table = ("[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
             "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]")
    return rf"""
with recursive runs as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{7,}}')) as run
  from documents),
counted as (select id, run, count(*) as n, hex(encode(id || ':' || run)) as bytes from runs group by id, run),
halves as (
  select run, n, list_transform(range(0, len(bytes)), lambda i:
    (instr('0123456789ABCDEF', bytes[(i + 2 - 2 * (i % 2))::int]) - 1)::bigint) as digits
  from counted),
hashed as (
  select run, n, xor(list_reduce(digits, lambda crc, d:
    xor(crc >> 4, cast({table} as bigint[])[(xor(crc & 15, d) + 1)::int]), 4294967295::bigint), 4294967295) as h
  from halves),
results as (
  select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
    n from hashed),
words as (select word, sum(n)::bigint as n from results where length(word) >= 7 group by word having sum(n) >= 2),
less as (
  select word, i, left(word, i::int) || substr(word, i::int + 2) as rest
  from (select word, unnest(range(length(word))) as i from words)),
near as (
  select a.word, b.word as near from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word from less a join words b on a.rest = b.word
  union select b.word, a.word from less a join words b on a.rest = b.word),
best as (
  select p.word, count(*) as n_near, max(v.n) as most from near p join words v on v.word = p.near group by p.word),
named as (
  select p.word, min(p.near) as form from near p join words v on v.word = p.near join best b on b.word = p.word
  where v.n = b.most group by p.word),
forms as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.most >= 10 * w.n then b.most end as form_n,
    case when b.most >= 10 * w.n then m.form end as form
  from words w left join best b on b.word = w.word left join named m on m.word = w.word),
chain as (
  select word, word as last from forms
  union all select c.word, f.form from chain c join forms f on f.word = c.last where f.form is not null)
select f.word, f.form, c.last as root, f.n, f.n_near, f.form_n
from forms f join chain c on c.word = f.word join forms e on e.word = c.last and e.form is null
"""
