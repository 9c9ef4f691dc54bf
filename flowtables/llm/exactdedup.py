"""Exact duplicates of whole texts, decided on full byte strings in compressed radix tries.

Texts count as equal when they are identical after every run of white space is replaced by one space. Each task first
finds the equal texts in every batch of its rows, so that of a group of copies, however large, only one row per batch
is shuffled with its bytes. Those rows are partitioned by length and content hash, and each partition inserts them into a
radix trie whose terminal nodes keep the smallest identifier. A trie that outgrows its budget writes its largest subtree
to a file of the task and sends later keys of that subtree there; such files are worked off one by one, a byte deeper.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import mapped, prepared, text_of, written

BUDGET = 128 << 20  # bytes of keys a trie holds before it writes a subtree out
HASH = 8            # bytes of content hash in front of every key
LAST = (True, 0)    # an identifier that is NULL comes after all others


class Node:
    """Edge label, children by their first byte, and for a terminal node the smallest owner, rows and members."""

    __slots__ = ("edge", "children", "owner", "rows", "members")

    def __init__(self, edge: bytes):
        self.edge, self.children = edge, {}
        self.owner, self.rows, self.members = None, 0, None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Radix trie of byte strings with subtrees on disk when `budget` is exceeded.

    `add` takes a key, an owner (compared as a tuple), how many rows it stands for, and a member to report; `groups` gives
    (owner, rows, members) per distinct key. `depth` is the key byte at which subtrees are told apart.
    """

    def __init__(self, budget: int = BUDGET, depth: int = 0):
        self.budget, self.depth = budget, depth
        self.subtrees: dict[int, Node] = {}
        self.held: dict[int, int] = {}
        self.total = 0
        self.files: dict[int, object] = {}

    def add(self, key: bytes, owner: tuple, rows: int, members: list) -> None:
        branch = key[self.depth] if len(key) > self.depth else -1
        if branch in self.files:
            pickle.dump((key, owner, rows, members), self.files[branch])
            return
        node = self.subtrees.get(branch)
        if node is None:
            node = self.subtrees[branch] = Node(b"")
        grown = self._insert(node, key, owner, rows, members)
        self.held[branch] = self.held.get(branch, 0) + grown
        self.total += grown
        while self.total > self.budget and self._spill():
            pass

    @staticmethod
    def _insert(node: Node, key: bytes, owner: tuple, rows: int, members: list) -> int:
        at, grown = 0, 100
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                node, at, grown = child, len(key), grown + len(key) - at + 300
            elif key.startswith(child.edge, at):
                node, at = child, at + len(child.edge)
            else:
                same = _common(child.edge, key[at:at + len(child.edge)])
                upper = Node(child.edge[:same])
                child.edge = child.edge[same:]
                upper.children[child.edge[0]] = child
                node.children[key[at]] = upper
                node, at, grown = upper, at + same, grown + 300
        if node.members is None:
            node.owner, node.members = owner, []
        node.owner = min(node.owner, owner)
        node.rows += rows
        node.members += members
        return grown + 40 * len(members)

    def _spill(self) -> bool:
        if self.depth >= HASH - 1 or not self.held:
            return False  # one text or a clash of hashes: it has to be held
        branch = max(self.held, key=self.held.get)
        file = self.files[branch] = tempfile.TemporaryFile()
        for key, node in _terminals(self.subtrees.pop(branch)):
            pickle.dump((key, node.owner, node.rows, node.members), file)
        self.total -= self.held.pop(branch)
        return True

    def groups(self) -> Iterator[tuple[tuple, int, list]]:
        for root in self.subtrees.values():
            for _, node in _terminals(root, False):
                yield node.owner, node.rows, node.members
        self.subtrees.clear()
        for file in self.files.values():
            file.seek(0)
            below = Trie(self.budget, self.depth + 1)
            try:
                while True:
                    below.add(*pickle.load(file))
            except EOFError:
                file.close()
            yield from below.groups()


def _terminals(root: Node, keys: bool = True) -> Iterator[tuple[bytes, Node]]:
    stack = [(root.edge, root)]
    while stack:
        key, node = stack.pop()
        if node.members is not None:
            yield key, node
        stack += [(key + c.edge if keys else b"", c) for c in node.children.values()]


def _id(value) -> tuple:
    return LAST if value is None else (False, int(value))


def _local(budget: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Group the rows of a batch; the first row of a group carries its bytes, its number of rows and its owner."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row, group = TaskContext.get().partitionId() << 40, TaskContext.get().partitionId() << 40
        for frame in frames:
            trie = Trie(budget, HASH)  # lives for one batch of bounded bytes, so it writes nothing out
            texts, shas = frame["content"].tolist(), frame["text_sha256"].tolist()
            for i, (text, sha, doc) in enumerate(zip(texts, shas, frame["doc_id"].tolist(), strict=True)):
                trie.add(bytes.fromhex(sha[:2 * HASH]) + text, (*_id(doc), row + i), 1, [i])
            number = np.empty(len(frame), np.int64)
            owner_row, rows = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            content = [None] * len(frame)
            for owner, n, members in trie.groups():
                number[members] = group
                at = owner[-1] - row
                content[at], owner_row[at], rows[at] = texts[at], owner[-1], n
                group += 1
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "text_sha256": frame["text_sha256"], "row": row + np.arange(len(frame)),
                "part": number, "n": rows, "content": content})
            row += len(frame)

    return run


def _owners(budget: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    columns = ["part", "doc_id", "keep_row", "group_size"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie(budget)
        for frame in frames:
            for doc, sha, row, part, n, content in frame.itertuples(index=False):
                trie.add(bytes.fromhex(sha[:2 * HASH]) + content, (*_id(doc), row), n, [part])
        out: list[tuple] = []
        for (no_id, doc, row), n, members in trie.groups():
            out += [(part, None if no_id else str(doc), row, n) for part in members]
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    return run


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `docs`; other columns are not read.

    NULL text is empty text. Of equal texts the row with the smallest id stays; a NULL id comes last; of rows that repeat
    the same id and text exactly one stays. An empty table gives no rows.
    """
    prepared(docs.sparkSession)
    normal = F.regexp_replace(text_of(text), "[\\x20\\x09-\\x0D]+", " ")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(normal, "UTF-8").alias("content"))
    rows = rows.select("doc_id", "content", F.sha2("content", 256).alias("text_sha256"))
    local = written(mapped(rows, _local(budget), "doc_id long, text_sha256 string, row long, part long, n long, content binary",
                           ["doc_id"]), "texts")
    first = local.where("content is not null")
    owners = mapped(first.select("doc_id", "text_sha256", "row", "part", "n", "content").repartition(
        F.length("content"), F.col("text_sha256")), _owners(budget), "part long, doc_id long, keep_row long, group_size long",
        ["doc_id"]).withColumnRenamed("doc_id", "keep_id")
    return local.select("doc_id", "text_sha256", "row", "part").join(owners, "part").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
