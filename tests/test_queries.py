"""Every registered query against its SQL on the smallest provided data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import connect, difference  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(ours, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 969


def test_scans_are_pruned(spark):
    """Only the needed columns of the prior partition are read."""
    plan = entry.queries()["fe_basket_size"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "(get_eval" in scan and "= prior)" in scan
    assert "order_dow" not in scan and "add_to_cart_order" not in scan and "reordered" not in scan
