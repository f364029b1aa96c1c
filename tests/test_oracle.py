"""Every query of the core library with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import pytest

from compare import duck_bag, spark_bag
from conftest import SF

from quillon.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    ours, theirs = spark_bag(QUERIES[name](spark, SF)), duck_bag(SF, SQL[name])
    assert ours[0] == theirs[0]
    assert len(ours[1]) > 0
    assert ours[1] == theirs[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
