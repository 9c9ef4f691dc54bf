"""Connected components over a table of links: distributed union-find by contraction.

Each round every node hooks onto its smallest neighbour, the pointers are shortened to their roots, and the links are
rewritten to roots; links inside one tree vanish. Roots only ever become smaller, so a component ends with its smallest
node as label. All steps are joins and partial aggregates on node ids: a hub with a third of all links is a skewed
join key, which adaptive execution splits, and never a list in one task. Each round's tables are written to the
shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.common import discarded, written


def _rooted(pointers: DataFrame) -> DataFrame:
    """Follow (node, root) pointers to their ends; every step doubles the length already followed."""
    while True:
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("above"))
        stepped = written(
            pointers.join(up, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root"),
                (F.coalesce("above", "root") != F.col("root")).alias("moved")), "pointers")
        discarded(pointers)
        if stepped.where("moved").isEmpty():
            return stepped
        pointers = stepped


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another one; root is the component's smallest node.

    NULL ends and links of a node to itself are no links; repeated links count once; no links give no rows.
    """
    links = written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        # A node without a smaller neighbour is a root and needs no pointer.
        pointers = _rooted(written(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "pointers"))
        if labels is None:
            tops = links.select(F.col("b").alias("node")).distinct().join(pointers, "node", "left_anti")
            labels = written(pointers.select("node", "root").unionByName(tops.select("node", F.col("node").alias("root"))), "labels")
        else:
            up = pointers.select(F.col("node").alias("root"), F.col("root").alias("above"))
            older = labels
            labels = written(labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")),
                             "labels")
            discarded(older)
        left = pointers.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = pointers.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        ends = links.join(left, "a", "left").join(right, "b", "left").select(
            F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        older = links
        links = written(ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
        discarded(older, pointers)
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        labels.written_to = links.written_to
    return labels
