import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.functions import ordering


@pytest.mark.parametrize("pivots", [1, 4, 64])
def test_running_totals_match_a_plain_cumulative_sum(spark, pivots):
    draw = random.Random(1)
    rows = [(k, v, draw.randint(0, 9)) for k in ("a", "b") for v in draw.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "k string, v long, m long")
    out = ordering.running_totals(df, "v", ["m"], ["k"], pivots).toPandas()
    for key, part in out.groupby("k"):
        part = part.sort_values("v")
        assert (part.m_before == part.m.cumsum() - part.m).all()
        assert (part.m_total == part.m.sum()).all()
    assert len(out) == len(rows)


def test_running_totals_order_by_a_struct(spark):
    df = spark.createDataFrame([(i, i % 3, 1) for i in range(50)], "id long, n long, one long")
    ordered = df.withColumn("o", F.struct((-F.col("n")).alias("n"), F.col("id").alias("id")))
    out = ordering.running_totals(ordered, "o", ["one"], pivots=5).toPandas()
    expected = df.toPandas().sort_values(["n", "id"], ascending=[False, True])["id"].tolist()
    assert out.sort_values("one_before")["id"].tolist() == expected


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 90 + list(map(float, range(11))), None])
def test_percentiles_match_numpy(spark, values):
    values = values or np.random.default_rng(3).normal(5, 2, 501).tolist()
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    percents = [0, 1, 25, 50, 75, 99, 100]
    for small_domain in (False, True):
        row = ordering.exact_percentiles(df, "v", percents, small_domain=small_domain).first()
        assert [row[f"p{p}"] for p in percents] == pytest.approx(np.percentile(values, percents).tolist())


def test_seeded_sample_is_exact_and_repeatable(spark):
    df = spark.range(500).select((F.col("id") % 250).alias("user_key"))
    first = {r[0] for r in ordering.seeded_sample(df, "user_key", 40, 42).collect()}
    again = {r[0] for r in ordering.seeded_sample(df.repartition(3), "user_key", 40, 42).collect()}
    other = {r[0] for r in ordering.seeded_sample(df, "user_key", 40, 43).collect()}
    assert len(first) == 40 and first == again and first != other
    assert ordering.seeded_sample(df, "user_key", 1000, 42).count() == 250
    assert ordering.seeded_fraction(df, "user_key", 0.1, 42).count() == 25


def test_rows_are_sorted_per_range_not_in_one_task(spark):
    df = spark.range(1000).select(F.col("id").alias("v"), F.lit(1).alias("m"))
    plan = ordering.running_totals(df, "v", ["m"])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # the one window outside the ranges adds up the range totals, at most PIVOTS + 1 rows
    assert sum("_range" not in line for line in windows) == 1
    assert all("m_total" in line for line in windows if "_range" not in line)
