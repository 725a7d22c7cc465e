from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parents[1])
sys.path[:0] = [REPO, str(Path(__file__).resolve().parent)]
# Python workers import the packages from here.
os.environ["PYTHONPATH"] = os.pathsep.join([REPO, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import local_session

    session = local_session("4", memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frames(spark):
    from compare import DATA
    from suite.frames import Frames

    return Frames(spark, DATA)


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate one-column expressions over (text, ...) rows and return them in order."""

    def evaluate(rows, ddl, column):
        table = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {ddl}")
        found = table.select("i", column.alias("found")).collect()
        return [r["found"] for r in sorted(found, key=lambda r: r["i"])]

    return evaluate
