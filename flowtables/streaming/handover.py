"""A table from a snapshot and then from its change log, without a gap or a repeat between the two."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.sinks import keyed
from flowtables.streaming.runs import drain

Snapshot = Callable[[], tuple[DataFrame, object]]


def load_snapshot(spark: SparkSession, path: str, snapshot: Snapshot, keys: Sequence[str], position: str,
                  buckets: int | None = None) -> object:
    """Load the snapshot into the keyed table at `path` unless that was done before; the log position it holds for.

    `snapshot` gives the rows and the position of the log that was current *before* they were read, a number or a text. Rows may
    already hold later changes: these come again from the log and replace them. Rows and position become visible together, so
    a job that is lost half-way starts again with another snapshot, and one that comes later finds the position of the first.
    """
    mark = keyed.table_mark(spark, path)
    if mark is not None:
        return json.loads(mark)
    rows, at = snapshot()
    if at is None:
        raise ValueError("a snapshot needs the position of the log that it holds for")
    rows = rows.withColumns({position: F.lit(at), "deleted": F.lit(False)})
    keyed.load(path, rows, keys, [position], buckets, json.dumps(at))
    return at


def snapshot_then_changes(spark: SparkSession, path: str, snapshot: Snapshot, changes: DataFrame, keys: Sequence[str],
                          position: str, checkpoint: str, op: str = "op", deletes: Sequence[str] = ("d",),
                          buckets: int | None = None) -> None:
    """Bring the table at `path` up to all changes that are there; call it again for later ones.

    The log may start long before the snapshot. Changes up to the snapshot's position are dropped before they are looked at, as they
    would bring back rows that were deleted since; later ones are folded in by position, in whatever order they come. A batch
    that is repeated changes nothing. Changes without a position have no place in the log and are dropped too.
    Read the table with `keyed.read_table(spark, path, "deleted")`.
    """
    at = load_snapshot(spark, path, snapshot, keys, position, buckets)
    later = changes.where(F.col(position) > F.lit(at).cast(changes.schema[position].dataType))
    drain(later, keyed.changelog_batches(path, keys, [position], op, deletes), checkpoint)
