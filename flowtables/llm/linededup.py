"""Fuzzy duplicates of lines by MinHash, in DataFrame operations only.

A line's shingles are all its runs of `width` characters (UTF-16 units; a shorter line is one shingle). One hash of a shingle
picks one of `bands * rows` bins and competes for its minimum there; the minima of `rows` bins make a band. Lines that
share a band form a bucket. Pairs of a bucket are not listed: every line is first compared with its bucket's representative,
by exact Jaccard similarity of the shingle sets, and the links found are united. Lines that are still in another component are
compared with a few lines picked from their bucket, and those which even then are apart with all others, so that every link
between components that a bucket holds is found.
One line per component stays, the first by (doc_id, position).

Pairs are joined by their bucket and by marks, a bitmap of each line's shingles by parity: shared shingles cancel, so two lines' marks
differ in no more bits than the lines in shingles. Only pairs that can be similar by it become rows, and only their texts are
cut into shingles and compared; the marks lose no link. The lines are written once; everything else works on 64-bit hashes of
lines and on positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm.common import discarded, text_of, written
from flowtables.llm.components import components

PAIRS = 1 << 17  # pairs that are compared at once, if there are fewer lines than that
MARKS = [f"m{i}" for i in range(16)]  # words of 64 bits
BLOCK = 16  # shingles that are hashed in one row


@dataclass(frozen=True)
class Fuzzy:
    """With 8 bands of 4 rows, two lines of similarity 0.8 share a bucket with probability 0.985, of 0.9 with 0.9999."""

    width: int = 8
    bands: int = 8
    rows: int = 4
    least: float = 0.8
    heads: int = 8  # lines of a bucket that are each compared with all that the first round left apart


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, copy, pos, line, key) of all lines with anything but white space; rows with equal id and text count as one."""
    lines = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text_of(text)).alias("copy"), text_of(text).alias("text")).select(
        "doc", "copy", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.regexp_like("line", F.lit("\\S"))).withColumn("key", F.xxhash64("line"))


def _units(line: str) -> Column:
    return F.encode(line, "UTF-16BE")


def _shingled(rows: DataFrame, width: int, *names: str) -> DataFrame:
    """Explode (names, units) to (names, hash) of every shingle; the hash is not negative."""
    last = F.greatest((F.octet_length("units") / 2 - width).cast("int"), F.lit(0))
    shingle = F.substring(F.col("units"), F.col("i") * 2 + 1, F.lit(2 * width))
    return rows.select(*names, "units", F.explode(F.sequence(F.lit(0), last)).alias("i")).select(
        *names, F.shiftrightunsigned(F.xxhash64(shingle), 1).alias("hash"))


def bands(lines: DataFrame, fuzzy: Fuzzy = Fuzzy()) -> DataFrame:
    """(key, band) for the bands of each distinct line (key, line); a band none of whose bins holds a shingle is left out."""
    distinct = lines.select("key", "line").dropDuplicates(["key"])
    bins = fuzzy.bands * fuzzy.rows
    size = -(-(1 << 63) // bins)
    # A shift where it does; a division checks for more than can be here.
    bin_ = f"shiftrightunsigned(hash, {63 - bins.bit_length() + 1})" if bins & (bins - 1) == 0 else f"hash div {size}L"
    hashes = _shingled(distinct.select("key", _units("line").alias("units")), fuzzy.width, "key").withColumn(
        "bin", F.expr(f"cast({bin_} as int)"))
    # All on the partitioning of `distinct`: the minima need no shuffle of their own.
    least = [F.min(F.when(F.col("bin") % fuzzy.rows == i, F.col("hash"))).alias(f"l{i}") for i in range(fuzzy.rows)]
    minima = hashes.groupBy("key", F.expr(f"cast(bin div {fuzzy.rows} as int)").alias("j")).agg(*least)
    return minima.select("key", F.xxhash64("j", *[f"l{i}" for i in range(fuzzy.rows)]).alias("band"))


def _blocks(rows: DataFrame, width: int, *names: str) -> DataFrame:
    """Explode (names, units) to (names, hashes): the hashes of all shingles, BLOCK of them in an array. The last array repeats
    the last shingle."""
    last = F.greatest((F.octet_length("units") / 2 - width).cast("int"), F.lit(0))
    at = rows.select(*names, "units", last.alias("last")).select(
        *names, "units", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(BLOCK))).alias("i"))
    starts = [F.least(F.col("i") + k, F.col("last")) * 2 + 1 for k in range(BLOCK)]
    return at.select(*names, F.array(*[
        F.shiftrightunsigned(F.xxhash64(F.substring(F.col("units"), start, F.lit(2 * width))), 1) for start in starts]).alias("hashes"))


def _sets(rows: DataFrame, width: int, *names: str) -> DataFrame:
    """(names, set): the different shingle hashes of all lines of a group; `rows` has (names, line) and its partitioning is kept."""
    blocks = _blocks(rows.select(*names, _units("line").alias("units")), width, *names)
    return blocks.groupBy(*names).agg(F.array_distinct(F.flatten(F.collect_list("hashes"))).alias("set"))


def _marked(texts: DataFrame, fuzzy: Fuzzy) -> DataFrame:
    """(key, size, marks): how many different shingles a line of `texts` (key, line) has, and for each bit of the marks whether
    it is an odd number of them that fall on it."""
    rows = texts.repartition("key")  # the partitioning of all that follows
    words = _sets(rows, fuzzy.width, "key").select("key", F.explode("set").alias("hash")).groupBy(
        "key", F.pmod("hash", F.lit(len(MARKS))).cast("int").alias("i")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.expr("shiftleft(1L, cast(shiftrightunsigned(hash, 32) % 64 as int))")).alias("word"))
    return words.groupBy("key").agg(F.sum("n").alias("size"), *[
        F.coalesce(F.max(F.when(F.col("i") == i, F.col("word"))), F.lit(0)).alias(m) for i, m in enumerate(MARKS)])


def _alike(least: float, marks: Sequence[str]) -> Column:
    """Can sets of sizes na and nb have the similarity? Only pairs that can't are left out.

    The smaller set's share of the larger one bounds the similarity. Similar sets differ in (1 - least) / (1 + least) of the sum
    of their sizes at most; shared shingles cancel in the marks of the two, so these differ in no more bits than that.
    """
    sizes = F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-9
    if not marks:
        return sizes
    differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a{m}").bitwiseXOR(F.col(f"b{m}"))) for m in marks])
    return sizes & (differ * (1 + least) <= (1 - least) * (F.col("na") + F.col("nb")) + 1e-6)


def _similar(pairs: DataFrame, texts: DataFrame, fuzzy: Fuzzy) -> DataFrame:
    """Those rows of `pairs` (a, b, their sizes na and nb, and more) with at least the Jaccard similarity; `texts` has (key, line)."""
    met = pairs.join(texts.withColumnsRenamed({"key": "a", "line": "la"}), "a").join(
        texts.withColumnsRenamed({"key": "b", "line": "lb"}), "b")
    names = pairs.columns
    all_, sizes = F.size("set"), F.col("na") + F.col("nb")  # sizes - all_ are in both
    return _sets(met.select(*names, F.explode(F.array("la", "lb")).alias("line")), fuzzy.width, *names).where(
        (sizes - all_) * (1 + fuzzy.least) >= fuzzy.least * sizes - 1e-9).select(*names)


def similar_lines(lines: DataFrame, fuzzy: Fuzzy = Fuzzy()) -> DataFrame:
    """(node, root): the keys of lines that are linked to another distinct line, with their component's smallest key."""
    members = bucketed(bands(lines, fuzzy))
    needed = written(members.select("key").distinct(), "needed")
    # Repeats of a line go before the join, so a common line is a row per task there.
    texts = written(lines.select("key", "line").dropDuplicates(["key"]).join(needed.hint("shuffle_hash"), "key", "left_semi"), "texts")
    discarded(needed)
    sizes = written(_marked(texts, fuzzy), "sizes")
    roots = linked(members, sizes, lambda pairs: _similar(pairs, texts, fuzzy), fuzzy.least, fuzzy.heads, MARKS)
    discarded(texts, sizes)
    return roots


def bucketed(banded: DataFrame) -> DataFrame:
    """(band, key, head) of the bands that several keys share; the head is the smallest of them."""
    here = Window.partitionBy("band")  # nearly all bands have one key, so there is nothing to aggregate before the shuffle
    return written(banded.select("band", "key", F.min("key").over(here).alias("head"), F.max("key").over(here).alias("top"))
                   .where("head <> top").select("band", "key", "head"), "members")


def linked(members: DataFrame, sizes: DataFrame, similar: Callable[[DataFrame], DataFrame], least: float, heads: int,
           marks: Sequence[str] = ()) -> DataFrame:
    """(node, root) of the keys that `similar` links inside their buckets; `members` is from `bucketed` and is removed.

    `sizes` has (key, size and `marks`) of every member's set, see `_alike`. `similar` gets pairs (a, b and more) that by it can
    have the similarity `least`, with their sizes na and nb, and returns those that are links.
    """
    at_once = max(PAIRS, sizes.count())

    def of(side: str) -> DataFrame:
        return sizes.select(F.col("key").alias(side), F.col("size").alias(f"n{side}"), *[F.col(m).alias(f"{side}{m}") for m in marks])

    can_link = _alike(least, marks)
    stars = members.where("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b")).distinct()
    links = _in_parts(stars.join(of("a"), "a").join(of("b"), "b").where(can_link).select("a", "b", "na", "nb"), similar, at_once)
    roots = components(links)
    discarded(links)
    # A component is as good as one line from here on, and only buckets that hold several are looked at again.
    parts = _still_mixed(members.select("band", "key", F.col("key").alias("part")), roots)
    discarded(members)
    picked = written(parts.groupBy("band").agg(*[
        F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("h"), "key", "part")).alias(f"h{i}") for i in range(heads)])
        .select("band", F.explode(F.array(*[f"h{i}" for i in range(heads)])).alias("h"))
        .select("band", F.col("h.key").alias("b"), F.col("h.part").alias("pb")).distinct(), "picked")
    for others in (picked, None):
        here = parts.withColumnsRenamed({"key": "a", "part": "pa"}).join(of("a"), "a")
        apart = F.col("pa") != F.col("pb")
        if others is None:  # whatever is still apart is compared in full
            others, apart = parts.withColumnsRenamed({"key": "b", "part": "pb"}), F.col("pa") < F.col("pb")
        met = here.join(others.join(of("b"), "b").hint("merge"), "band").where(apart & can_link)
        links = _in_parts(met.select("a", "b", "pa", "pb", "na", "nb").distinct(), similar, at_once)
        united = components(links.select(F.col("pa").alias("a"), F.col("pb").alias("b")))
        older, roots = (parts, roots, links), _chained(roots, united)
        parts = _still_mixed(parts, united)
        discarded(*older, united)
    discarded(picked, parts)
    return roots


def _in_parts(pairs: DataFrame, similar: Callable[[DataFrame], DataFrame], at_once: int) -> DataFrame:
    """`similar` of all pairs, about `at_once` of them in a job: what pairs carry to be compared takes no more disk at a time,
    however many lines a bucket holds that are not quite similar."""
    pairs = written(pairs, "pairs")
    parts = -(-pairs.count() // at_once)
    found = [written(similar(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == i) if parts > 1 else pairs), "links")
             for i in range(max(parts, 1))]
    if len(found) == 1:
        out = found[0]
    else:
        out = written(reduce(DataFrame.unionByName, found), "links")
        discarded(*found)
    discarded(pairs)
    return out


def _still_mixed(parts: DataFrame, united: DataFrame) -> DataFrame:
    """(band, key, part) with parts replaced by their components, of the bands that hold several."""
    moved = written(parts.join(united.select(F.col("node").alias("part"), "root"), "part", "left").select(
        "band", "key", F.coalesce("root", "part").alias("part")), "parts")
    mixed = written(moved.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
                    .select("band"), "mixed")
    out = written(moved.join(mixed, "band", "left_semi"), "parts")
    discarded(moved, mixed)
    return out


def _chained(roots: DataFrame, united: DataFrame) -> DataFrame:
    """Components of components; a line that was alone so far is in `united` under its own key."""
    up = united.select(F.col("node").alias("root"), F.col("root").alias("above"))
    both = roots.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return written(both.unionByName(united.join(roots, "node", "left_anti").select("node", "root")), "roots")


def without_repeats(docs: DataFrame, fuzzy: Fuzzy = Fuzzy(), doc_id: str = "doc_id", text: str = "text",
                    n_chars: str | None = "n_chars") -> DataFrame:
    """The documents with all lines removed that are in the component of an earlier line; plus n_lines and n_dropped.

    Earlier means smaller (doc_id, position), a NULL id last; rows that repeat id and text are the same document and stay
    equal. Lines of white space only always stay, and so does every document, if need be with an empty text. A NULL text has
    no lines and stays NULL. `n_chars`, if present, is counted anew. Columns named n_lines or n_dropped are replaced.
    """
    lines = written(lines_of(docs, doc_id, text), "lines")
    roots = similar_lines(lines, fuzzy)
    at = F.struct(F.col("doc").isNull().alias("no"), "doc", "copy", "pos").alias("at")
    placed = written(lines.select("key", at).join(
        roots.withColumnRenamed("node", "key").hint("shuffle_hash"), "key", "left").select(
        F.coalesce("root", "key").alias("root"), "at"), "occurrences")
    discarded(lines)
    heads = written(placed.groupBy("root").agg(F.min("at").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("root", "head"), "heads")
    drops = placed.join(heads.hint("shuffle_hash"), "root").where("at <> head").groupBy(
        F.col("at.doc").alias("__doc"), F.col("at.copy").alias("__copy")).agg(
        F.collect_set("at.pos").alias("__drops"))  # at most the document's lines
    lost = F.coalesce(F.size("__drops"), F.lit(0))
    kept = F.array_join(F.filter(F.split(text_of(text), "\n"), lambda _, i: ~F.array_contains("__drops", i)), "\n")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(*names, F.col(doc_id).alias("__id"), F.xxhash64(text_of(text)).alias("__copy"))
    gone = written(drops.withColumnRenamed("__copy", "__of"), "drops")
    discarded(roots, placed, heads)
    joined = rows.join(gone.hint("shuffle_hash"), F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__copy") == F.col("__of")), "left")
    out = joined.withColumn("__new", F.when(F.col("__drops").isNull(), F.col(text)).otherwise(kept))
    columns = {text: F.col("__new"), "n_lines": F.size(F.split(text_of(text), "\n")).cast("long"), "n_dropped": lost.cast("long")}
    if n_chars in names:
        columns[n_chars] = F.when(F.col("__drops").isNull(), F.col(n_chars)).otherwise(F.length("__new")).cast(
            docs.schema[n_chars].dataType)
    return out.select(*[columns.get(c, F.col(c)).alias(c) for c in names], *[columns[c].alias(c) for c in ("n_lines", "n_dropped")])
