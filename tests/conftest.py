import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowtables.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(base / "checkpoints"), spark__sql__warehouse__dir=str(base / "warehouse"))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from literals."""
    def make(data, schema):
        return spark.createDataFrame(data, schema)
    return make


@pytest.fixture
def text_files(tmp_path):
    """Folder of text files with rising modification times, so that a file stream reads them in order."""
    folder = tmp_path / "in"
    folder.mkdir()
    state = {"n": 0, "at": time.time() - 10_000}

    def add(*lines):
        state["n"] += 1
        state["at"] += 10
        path = folder / f"part-{state['n']:03d}.txt"
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        os.utime(path, (state["at"], state["at"]))
        return str(folder)
    return add


def tuples(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
