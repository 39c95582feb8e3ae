from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postfeed.schema import PUBLISHED, STAGING  # noqa: E402
from postfeed.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _rows(spark, schema, rows):
    names = schema.names
    full = []
    for row in rows:
        values = {"position": "Clerk", **row}
        full.append(tuple(values.get(name) for name in names))
    relaxed = schema.__class__([f.__class__(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame(full, relaxed)


@pytest.fixture(scope="session")
def published(spark):
    return lambda *rows: _rows(spark, PUBLISHED, rows)


@pytest.fixture(scope="session")
def staging(spark):
    return lambda *rows: _rows(spark, STAGING, rows)


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column built from named string values."""

    def evaluate(build, **values):
        schema = ", ".join(f"{name} string" for name in values)
        return spark.createDataFrame([tuple(values.values())], schema).select(build.alias("x")).first()[0]

    return evaluate
