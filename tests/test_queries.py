import sys, os

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest
from helpers import SF, same_as_sql

from millrace.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    same_as_sql(registry.QUERIES[name](spark, SF), registry.ORACLES[name])


def test_near_dups_has_no_nested_loop(spark):
    plan = registry.QUERIES["near_dups"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
