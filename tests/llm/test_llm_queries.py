"""Queries with SQL against DuckDB; the registry."""

import pytest
from compare import difference, open_oracle

from pricelens.llm.oracle_sql import ORACLES
from pricelens.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small_dir, name):
    assert difference(QUERIES[name](spark, small_dir), open_oracle(small_dir).sql(ORACLES[name])) is None


def test_every_operator_has_a_query():
    import __spark_entry__ as entry

    names = [*entry.queries()]
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
