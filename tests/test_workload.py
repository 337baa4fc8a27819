"""Every registered query: results beside its SQL twin, and plan shape."""

from __future__ import annotations

import pytest

import oracle
from lakestrata.workload.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name, capsys):
    query = QUERIES[name]
    problem = oracle.compare(spark, con, SF, query)
    assert problem == ""
    query.run(spark, SF).explain()
    plan = capsys.readouterr().out
    # No Python workers, no cross products.
    for unwanted in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["customer_state", "wide_rows", "customers", "price_total"]
