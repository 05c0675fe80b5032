import os

import pytest
from compare import duckdb_rows, spark_rows

from citeloom.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, name):
    assert spark_rows(registry.QUERIES[name](spark, DATA)) == duckdb_rows(registry.ORACLE_SQL[name], DATA)


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_no_python_in_any_plan(spark):
    """But in that of the paged works, whose source is written in Python."""
    for name, q in registry.QUERIES.items():
        if name == "works_from_pages":
            continue
        plan = q(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan, name
