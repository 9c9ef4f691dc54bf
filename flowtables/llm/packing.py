"""Best-fit packing of tokenised documents into fixed-length sequences, after a dominance reduction.

Documents are cut into pieces of at most `length` tokens. How many pieces there are of each length is all that the
plan needs: at most `length` numbers, however many documents there are. On these counts the reduction of Martello and
Toth fixes sets of one to three pieces that provably dominate every other set with their largest piece, and best fit
in decreasing order places what is left, whole groups of equal sequences at a time. The plan is a list of patterns
(a multiset of lengths and how often it is used), at most a few per length, and every piece finds its slot by its rank
among the pieces of its length. Ranks are counted per (length, bucket of ids) with offsets per bucket, so a length that
a third of all pieces share is spread like any other.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowtables.llm.common import mapped, prepared, text_of, written

SPECIAL = "<|endoftext|>"
CACHED = 300_000  # units after which a worker forgets those it has not met again since the last time; both halves take some 130 MB
LEARNED = 10_000  # units in a call of the tokenizer, whose results take many times the memory of the ids
_workers: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts by a byte-level vocabulary file, as little-endian 32-bit numbers.

    A space or line break between two visible characters always begins a new unit of this kind of vocabulary, and so does a
    punctuation mark after a letter or digit. So plain texts are cut there, all texts of a batch at once as an array of bytes, and
    every distinct unit is encoded once and remembered. Other white space, scripts outside Latin, Greek and Cyrillic, and the
    special token's string go through the tokenizer as a whole.
    """

    PLAIN = re.compile("[\\n -~¡-ȳΑ-ΡΣ-ϿА-я‐-‧‰-⁞€]*")
    LATIN = bytes([10, *range(32, 127), *range(161, 256)])
    ODD_SPACE = ("  ", " \n", "\n ", "\n\n")
    MARKS = b".,;:!?#$%&*|)-"  # never part of the unit that a letter or digit before them belongs to
    SPACE, MARK, ALNUM, LEAD, TAIL = 1, 2, 4, 8, 16

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.recent: dict[bytes, bytes] = {}  # ids of units; when it is full it becomes the older half, so frequent ones are kept
        self.older: dict[bytes, bytes] = {}
        self.newline = self.whole("\n")
        self.kinds = np.zeros(256, np.uint8)
        self.kinds[[10, 32]] = self.SPACE
        self.kinds[list(self.MARKS)] = self.MARK
        self.kinds[[c for c in range(128) if chr(c).isalnum()]] = self.ALNUM
        self.kinds[[0xC3, 0xD0, 0xD1]] = self.LEAD  # with these tails only letters, as the signs for times and division are left out
        self.kinds[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = self.TAIL

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def plain(self, text: str) -> bool:
        if not text or text[0] in " \n" or text[-1] in " \n" or SPECIAL in text or any(x in text for x in self.ODD_SPACE):
            return False
        try:
            return not text.encode("latin-1").translate(None, self.LATIN)
        except UnicodeEncodeError:
            return self.PLAIN.fullmatch(text) is not None

    def _starts(self, data: np.ndarray) -> np.ndarray:
        """Where the units of UTF-8 bytes begin; a space or line break belongs to the unit after it."""
        kinds = self.kinds[data]
        letter = kinds == self.ALNUM
        letter[1:] |= (kinds[1:] == self.TAIL) & (kinds[:-1] == self.LEAD)
        starts = kinds == self.SPACE
        starts[1:] |= (kinds[1:] == self.MARK) & letter[:-1]
        return np.flatnonzero(starts)

    def _learned(self, units: list[bytes]) -> list[bytes]:
        """Ids of every unit: texts with a line each, cut at the line breaks' ids."""
        out = []
        for start in range(0, len(units), LEARNED):
            part = units[start:start + LEARNED]
            ids = np.asarray(self.tokenizer.encode_batch_fast(
                [b"\n".join([u.lstrip(b"\n") for u in part]).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == int.from_bytes(self.newline, "little")).tolist()
            data = ids.tobytes()
            out += [(self.newline if u[0] == 10 else b"") + data[4 * a:4 * b]
                    for u, a, b in zip(part, [0, *[c + 1 for c in cuts]], [*cuts, len(ids)], strict=True)]
        return out

    def _looked_up(self, units: list[bytes]) -> list[bytes]:
        """The ids of every distinct unit; those not known yet are learned at once."""
        known = self.recent
        found = list(map(known.get, units))
        if holes := [i for i, x in enumerate(found) if x is None]:
            new = []
            for i in holes:
                found[i] = self.older.get(units[i])
                if found[i] is None:
                    new.append(i)
            for i, ids in zip(new, self._learned([units[i] for i in new]) if new else (), strict=True):
                found[i] = ids
            known.update((units[i], found[i]) for i in holes)
            if len(known) > CACHED:
                self.older, self.recent = known, {}
        return found

    def _encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts."""
        data = [b"\n" + t.encode() for t in texts]
        begins = np.cumsum([0, *map(len, data)])
        raw = b"".join(data)
        starts = self._starts(np.frombuffer(raw, np.uint8))
        offsets = np.append(starts, len(raw)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        found = self._looked_up(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, codes = np.frombuffer(b"".join(found), "<u4"), units.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        firsts, n = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        ends = np.cumsum(n)
        out = ids[np.repeat(firsts - (ends - n), n) + np.arange(ends[-1])]
        at = np.append((ends - n)[np.searchsorted(starts, begins[:-1])], len(out)).tolist()
        return [out[a + 1:b].tobytes() for a, b in zip(at, at[1:])]  # without the line break put before each text

    def forget(self) -> None:
        """Give the memory back, as the worker goes on to tasks of other kinds."""
        self.recent, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[str]) -> list[bytes]:
        easy = [self.plain(t) for t in texts]
        got = iter(self._encoded([t for t, e in zip(texts, easy, strict=True) if e]) if any(easy) else ())
        return [next(got) if e else self.whole(t) for t, e in zip(texts, easy, strict=True)]


def encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def _batches(texts: list[str], chars: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, texts[start:]


def tokenized_pieces(docs: DataFrame, path: str, length: int = 2_048, separator: int = 0, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row's ids with the separator's id after them.

    A row is cut only if it has more than `length` ids, and then into pieces of exactly `length` but for the first. NULL
    text is empty text, which gives one piece that is the separator alone.
    """
    end = np.asarray([separator], dtype="<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoder(path)
        try:
            for frame in frames:
                keys = frame[doc_id].to_numpy()
                for at, texts in _batches(frame["__text"].tolist()):
                    owner, rows = [], []
                    for i, ids in enumerate(tokens.encode(texts), at):
                        ids += end
                        n = len(ids) // 4
                        head = n % length or length
                        view, start = memoryview(ids), 0
                        for piece in range(-(-n // length)):
                            size = length if piece else min(head, n)
                            owner.append(i)
                            rows.append((piece, start, size, zlib.crc32(view[4 * start:4 * (start + size)])))
                            start += size
                    out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"])
                    out.insert(0, doc_id, pd.Series(keys[owner], dtype=frame[doc_id].dtype))
                    yield out
        finally:
            tokens.forget()

    prepared(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    return mapped(docs.select(doc_id, text_of(text).alias("__text")), cut,
                  f"`{doc_id}` {kind}, piece int, start long, length long, ids_crc32 long", [doc_id])


def packing_plan(counts: Mapping[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns [(times, [(length, how many), ...]), ...] that together use every piece exactly once."""
    left = {s: c for s, c in counts.items() if c}
    sizes = sorted(left)
    patterns: list[tuple[int, list[tuple[int, int]]]] = []

    def take(times: int, *members: int) -> None:
        pattern: dict[int, int] = {}
        for s in members:
            pattern[s] = pattern.get(s, 0) + 1
        patterns.append((times, list(pattern.items())))
        for s, k in pattern.items():
            left[s] -= times * k
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    def largest(room: int, without: int) -> int:
        """Largest length that fits, where one piece of `without` is already used; 0 if there is none."""
        for s in reversed(sizes[:bisect_left(sizes, room + 1)]):
            if s != without or left[s] > 1:
                return s
        return 0

    fixed = True
    while fixed:  # what was fixed shrinks the instance, so earlier pieces may now be dominated too
        fixed = False
        for s in sorted(left, reverse=True):
            while s in left:
                room, times = capacity - s, left[s]
                smallest = []
                for x in sizes[:4]:
                    smallest += [x] * min(3, left[x] - (x == s))
                smallest = smallest[:3]
                partner = largest(room, s)
                if not partner:
                    take(times, s)  # nothing fits beside it
                elif partner == room or sum(smallest[:2]) > room or len(smallest) < 2:
                    # Fills the sequence, or is the largest of the single pieces that can be added.
                    take(times // 2 if partner == s else min(times, left[partner]), s, partner)
                elif (sum(smallest) > room or len(smallest) < 3) and partner >= _best_pair(sizes, left, s, room):
                    # At most two pieces can be added, and no two together exceed the single one.
                    take(times // 2 if partner == s else min(times, left[partner]), s, partner)
                elif (sum(smallest) > room or len(smallest) < 3) and (third := _dominating(sizes, left, s, partner, room)):
                    # At most two pieces can be added, and this pair is as good as any two.
                    members = (s, partner, third)
                    take(min(left[x] // members.count(x) for x in members), *members)
                else:
                    break
                fixed = True

    # Best fit, decreasing: `open_` holds groups of equal sequences by the room they have left.
    open_: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []

    def put(room: int, times: int, members: tuple) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((times, members))

    for s in sorted(left, reverse=True):
        rest = left[s]
        while rest:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                fit = capacity // s
                if rest >= fit:
                    put(capacity - fit * s, rest // fit, ((s, fit),))
                if rest % fit:
                    put(capacity - rest % fit * s, 1, ((s, rest % fit),))
                break
            room = rooms[at]
            times, members = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            fit = min(room // s, rest)  # equal pieces follow each other into the tightest sequence
            used = min(times, rest // fit)
            put(room - fit * s, used, (*members, (s, fit)))
            if times > used:
                put(room, times - used, members)
            rest -= used * fit
    return patterns + [(times, list(members)) for groups in open_.values() for times, members in groups]


def _best_pair(sizes: list[int], left: Mapping[int, int], used: int, room: int) -> int:
    """Largest sum of two pieces that fits."""
    best, low, high = 0, 0, len(sizes) - 1
    have = lambda s: left[s] - (s == used)
    while low <= high:
        a, b = sizes[low], sizes[high]
        if a + b > room or not have(b):
            high -= 1
        elif not have(a) or (low == high and have(a) < 2):
            low += 1
        else:
            best = max(best, a + b)
            low += 1
    return best


def _dominating(sizes: list[int], left: Mapping[int, int], used: int, partner: int, room: int) -> int:
    """The largest length that fits beside `used` and `partner`, the largest that fits in `room`; 0 if another pair may be better.

    Of any two pieces the smaller must fit in its place: no two larger ones may fit together.
    """
    third = 0
    for s in reversed(sizes[:bisect_left(sizes, room - partner + 1)]):
        if left[s] > (s == used) + (s == partner):
            third = s
            break
    larger: list[int] = []
    for s in sizes[bisect_left(sizes, third + 1):]:
        larger += [s] * min(2, left[s] - (s == used))
        if len(larger) > 1:
            break
    return third if sum(larger[:2]) > room or len(larger) < 2 else 0


def pack(pieces: DataFrame, capacity: int = 2_048, size: str = "length", key: tuple[str, ...] = ("doc_id", "piece")
         ) -> DataFrame:
    """Add sequence_id and offset: pieces of a sequence lie one after the other from 0, within `capacity`.

    Every row gets its own place, repeated rows and rows with NULL keys too; equal rows are interchangeable. Lengths must
    be from 1 to `capacity`. An empty table stays empty.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy(size).count().collect()}  # one row per length: at most `capacity`
    if any(s is None or not 1 <= s <= capacity for s in counts):
        raise ValueError(f"{size} must be from 1 to {capacity}")
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    base, taken = 0, dict.fromkeys(counts, 0)
    for times, members in packing_plan(counts, capacity):
        at = 0
        for s, k in members:
            slots.setdefault(s, []).append((taken[s], k, base, at))
            taken[s] += times * k
            at += s * k
        base += times
    lookup = {s: np.array(x, dtype=np.int64) for s, x in slots.items()}  # bounded by the number of lengths, not pieces

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            lengths, ranks = frame[size].to_numpy(np.int64), frame["__rank"].to_numpy(np.int64)
            for s in np.unique(lengths):
                rows = np.flatnonzero(lengths == s)
                plan = lookup[int(s)]
                slot = plan[np.searchsorted(plan[:, 0], ranks[rows], side="right") - 1]
                inside = ranks[rows] - slot[:, 0]
                sequence[rows] = slot[:, 2] + inside // slot[:, 1]
                offset[rows] = slot[:, 3] + inside % slot[:, 1] * s
            yield frame.drop(columns="__rank").assign(sequence_id=sequence, offset=offset)

    ranked = _ranked(pieces, size, key, sum(counts.values()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return mapped(ranked, place, f"{schema}, sequence_id long, offset long", [c for c in pieces.columns if c != size])


def _ranked(pieces: DataFrame, size: str, key: tuple[str, ...], rows: int) -> DataFrame:
    """Add __rank from 0 among the rows of the same size."""
    buckets = isqrt(rows) + 1  # about as many buckets as a bucket has rows, so neither outgrows a task
    spread = pieces.withColumn("__bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    within = Window.partitionBy(size, "__bucket").orderBy(*key)
    before = Window.partitionBy(size).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.groupBy(size, "__bucket").agg(F.count(F.lit(1)).alias("__n")).select(
        size, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    local = spread.withColumn("__local", F.row_number().over(within) - 1)
    return local.join(offsets, [size, "__bucket"]).select(
        *pieces.columns, (F.col("__local") + F.col("__before")).alias("__rank"))


def packed_documents(docs: DataFrame, path: str, length: int = 2_048) -> DataFrame:
    """Tokenise, cut and pack a table of documents; see `tokenized_pieces` and `pack`."""
    return pack(written(tokenized_pieces(docs, path, length), "pieces"), length)
