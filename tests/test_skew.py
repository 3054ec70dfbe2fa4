"""A user and a product that each hold a large part of all rows give the same exact results."""

import os
import random
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from cartlens.operators import eda, features as fe, metrics
from frames import dim_product, fact_rows

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import connect, difference  # noqa: E402

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    draw = random.Random(2)
    rows = []
    for number in range(1, 301):  # the hot user
        rows += [(1, number, p, float(number % 9), "prior") for p in {0, draw.randint(1, 30)}]
    for user in range(2, 60):
        for number in range(1, 6):
            rows += [(user, number, p, 2.0, "prior") for p in {0, draw.randint(1, 30)}]  # the hot product
    return rows, fact_rows(spark, rows), dim_product(spark, range(31))


def test_hot_user_and_product_features(skewed):
    rows, fact, dim = skewed
    matrix = fe.feature_matrix(fact, dim, 1, 1, contract_types=False)
    hot = matrix.where("user_key = 1 and product_key = 0").first()
    assert hot.up_times_purchased == hot.user_total_orders == 300
    assert hot.product_total_purchases == sum(r[2] == 0 for r in rows)
    assert hot.product_unique_users == 59
    other = matrix.where("user_key = 1 and product_key <> 0").first()
    expected = sum(n % 9 for n in range(other.up_last_order_number + 1, 301))
    assert other.up_days_since_last == expected


def test_ranking_and_metrics_with_hot_groups(spark, skewed):
    rows, fact, _ = skewed
    named = fact.select(F.col("product_key").alias("product_id"))
    curve = eda.lorenz_curve(named).orderBy("product_rank").collect()
    counts = {}
    for r in rows:
        counts[r[2]] = counts.get(r[2], 0) + 1
    assert [r.product_id for r in curve] == sorted(counts, key=lambda p: (-counts[p], p))
    assert curve[-1].purchase_share == pytest.approx(1.0)
    scored = fact.select("user_key", "product_key", (F.col("product_key") % 2).alias("label"), F.lit(0.5).alias("score"))
    assert metrics.auc(scored).first().auc == 0.5


def test_per_user_ranking_prunes_before_the_shuffle(skewed):
    _, fact, _ = skewed
    scored = fact.select("user_key", "product_key", F.col("order_number").alias("score"))
    plan = metrics.top_k_per_user(scored)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


HOT_QUERIES = [
    "etl_fact",
    "fe_feature_matrix",
    "drift_by_feature",
    "ndcg_at_10",
    "rec_batch",
    "lorenz_curve",
    "catalog_coverage",
    "users_prior_and_train",
    "date_range_dim_user",
    "split_sizes",
    "risk_temporal_leakage",
    "co_purchase_pairs",
]


@pytest.fixture(scope="module")
def hot_folder(tmp_path_factory):
    """Provided tables with one customer on a third of the orders and one part on a third of the lines."""
    if not os.path.isdir(SOURCE):
        pytest.skip("no test data")
    out = str(tmp_path_factory.mktemp("hot"))
    hot = {
        "part": "*",
        "customer": "*",
        "orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
        "lineitem": "* REPLACE (CASE WHEN hash(l_orderkey, l_linenumber) % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey)",
    }
    for table, columns in hot.items():
        duckdb.sql(f"COPY (SELECT {columns} FROM '{SOURCE}/{table}.parquet') TO '{out}/{table}.parquet'")
    return out


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_hot_keys_equal_sql(spark, hot_folder, name):
    ours = entry.queries()[name](spark, hot_folder).toPandas()
    theirs = connect(hot_folder).execute(entry.oracle_sql()[name]).df()
    assert difference(ours, theirs) is None
