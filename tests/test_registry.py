"""Every registered query against its SQL on the smallest given tables."""
import os

import pytest

import __spark_entry__ as driver
from check import compare
from registry.views import ENTRIES

SF = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no given tables here")
@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, name):
    assert name in SQL
    problem = compare(spark, SF, driver.queries()[name], SQL[name])
    assert problem in (None, "no rows on either side")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no given tables here")
def test_flagship(spark):
    result = driver.entry(spark)
    assert result.columns == ["load_area", "demand"] and result.count() > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    # the stored metadata is known to be small, and the dates reach the scan of the stored timestamps
    assert "GreaterThanOrEqual(l_shipdate" in plan and "BroadcastHashJoin" in plan
