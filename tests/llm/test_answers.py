"""Queries with an answer in SQL against DuckDB, over a small table and over edge cases."""

from __future__ import annotations

import pytest

from estatelens.llm import queries
from estatelens.llm.expected import expected
from tests.checks.compare import duckdb_bag, duckdb_connection, spark_bag
from tests.llm.conftest import SF


@pytest.mark.parametrize("rows", ["small", "edge", "nothing"])
@pytest.mark.parametrize("name", sorted(expected()))
def test_answer(spark, request, monkeypatch, name, rows):
    docs = request.getfixturevalue(rows)
    real = queries.table
    monkeypatch.setattr(queries, "table", lambda s, folder, t: docs if t == "documents" else real(s, folder, t))
    duck = duckdb_connection(SF)
    duck.register("given", docs.toArrow())
    duck.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM given")
    wanted, kinds = duckdb_bag(duck, expected()[name])
    got = queries.registered()[name](spark, SF)
    assert spark_bag(got) == wanted
    assert set(got.columns) == set(kinds)
