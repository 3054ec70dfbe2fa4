"""History derived from the provided tables: rows, exchanges, and who asks for it."""

import datetime
import os
import re

import pytest

from cartlens.plans.registry import registered
from cartlens.plans.workspace import Workspace
from cartlens.sources.adapter import basket_sources

DAY = datetime.date(1995, 1, 1)


@pytest.fixture()
def provided(spark, folder):
    """Two users; an order with a repeated part, a line without a part, two orders on one day."""
    days = [0, 0, 5, 9, 2, 3]
    orders = [(10 + i, 1 if i < 4 else 2, DAY + datetime.timedelta(days=d)) for i, d in enumerate(days)]
    lines = [(10, 7, 1), (10, 107, 2), (10, None, 3), (10, 8, 4), (11, 7, 1), (12, 8, 1), (12, 9, 2), (13, 7, 1), (14, 7, 1), (15, 9, 1), (99, 7, 1), (None, 7, 1)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_linenumber int"),
        "part": ([(p, f"name {p}", "brand") for p in (7, 8, 9, 107)], "p_partkey long, p_name string, p_brand string"),
        "customer": ([(u, f"user {u}", 1) for u in (1, 2)], "c_custkey long, c_name string, c_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_history_rows(spark, provided):
    rows = basket_sources(spark, provided).history.collect()
    found = sorted((r.order_id, r.product_id, r.order_number, r.add_to_cart_order, r.reordered, r.eval_set) for r in rows)
    assert found == [
        (10, 8, 1, 1, 0, "prior"),
        (10, 9, 1, 3, 0, "prior"),
        (11, 8, 2, 1, 1, "prior"),
        (12, 9, 3, 1, 1, "prior"),
        (12, 10, 3, 2, 0, "prior"),
        (13, 8, 4, 1, 1, "train"),
        (14, 8, 1, 1, 0, "prior"),
        (15, 10, 2, 1, 0, "train"),
    ]


def test_lines_move_once_by_order_and_once_by_user_and_product(spark, provided):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to broadcast
    try:
        history = basket_sources(spark, provided, folded=False).history
        moves = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, (.*)", history._jdf.queryExecution().executedPlan().toString())
        assert history.count() == 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_user = [rest for first, rest in moves if first in ("user_id", "o_custkey") and ("product_id" in rest or "l_partkey" in rest)]
    by_order = [rest for first, rest in moves if first in ("order_id", "l_orderkey", "o_orderkey")]
    assert (len(by_user), len(by_order)) == (1, 2)


def test_reports_on_orders_alone_derive_no_history(spark, provided):
    rows = registered()["orders_per_user_stats"](spark, provided).collect()
    assert [(r["count"], r["mean"]) for r in rows] == [(2, 3.0)]
    made = os.listdir(Workspace.open(spark, provided).path)
    assert "orders" in made and not [m for m in made if m.startswith(("placed", "history"))]
