"""Files closed by size and idle time."""

import os

from pyspark.sql import functions as F

from flowtables.plans.chunks import Split
from flowtables.streaming import rolling

HOUR = 3600


def batch_of(rows, data):
    return rows(data, "s long, v string").withColumn("ts", F.timestamp_seconds("s"))


def sizes(path):
    """Bytes of every file by hour folder."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".txt"):
                hour = folder.split("bucket=")[1].split("/")[0]
                found.setdefault(hour, []).append(os.path.getsize(os.path.join(folder, name)))
    return found


def test_sizes_idle_hours_and_repeats(spark, rows, tmp_path):
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = rolling.sized_file_batches(path, "ts", ["v"], state, 1000, "2 hours", Split(rows=50))
    batches = [[(i, f"a{i:05d}") for i in range(300)],
               [(HOUR + i, f"b{i:05d}") for i in range(20)] + [(None, "no time")],
               [(3 * HOUR + 30, "far later")],
               [(7, "comes back"), (HOUR + 5, "x" * 3000)]]
    want = sorted(f"({v})" for b in batches for _, v in b)
    for n, data in enumerate(batches):
        write(batch_of(rows, data), n)
        first = sizes(path)
        write(batch_of(rows, data), n)  # a batch that is repeated
        assert sizes(path) == first or sorted(map(sorted, sizes(path).values())) == sorted(map(sorted, first.values()))
        if n == 0:
            (files,) = first.values()
            assert len(files) == 2 and all(500 <= size <= 1000 for size in files)
            assert rolling.open_lines(spark, state).count() == 300 - sum(files) // 9
        if n == 2:
            assert {r.bucket for r in rolling.open_lines(spark, state).select("bucket").distinct().collect()} > {"none"}
            assert any("00" in hour[-2:] and len(files) == 3 for hour, files in first.items())  # idle, so closed
    for _ in range(2):
        rolling.close_open(spark, path, state)
        assert sorted(r.value for r in spark.read.text(f"{path}/*/*").collect()) == want


def test_nothing_comes(spark, rows, tmp_path):
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = rolling.sized_file_batches(path, "ts", ["v"], state, 1000)
    write(batch_of(rows, []), 0)
    write(batch_of(rows, []), 1)
    assert rolling.open_lines(spark, state).isEmpty() and not os.path.exists(path)
