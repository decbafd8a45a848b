from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from estatelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """``make("a int, b string", [(1, "x")])``"""
    return lambda ddl, rows: spark.createDataFrame(rows, ddl)


def tuples(df):
    return [tuple(row) for row in df.collect()]


def plan_text(df, executed: bool = False) -> str:
    """The physical plan; after running it when ``executed``."""
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
