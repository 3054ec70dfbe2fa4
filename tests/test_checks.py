"""Validation gate, drift and integrity."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.operators import drift, features as fe, integrity, validate
from frames import dim_product, fact_rows, synthetic_star


@pytest.fixture(scope="module")
def good(spark):
    fact, dim = synthetic_star(spark)
    return fe.feature_matrix(fact, dim, 2, 1).cache()


def failed(matrix):
    return {r.check for r in validate.validate(matrix).collect() if not r.passed}


def test_valid_matrix_passes_all_six(good):
    report = validate.validate(good).collect()
    assert len(report) == 6 and all(r.passed for r in report)
    validate.gate(validate.validate(good))


@pytest.mark.parametrize(
    ("column", "value", "check"),
    [
        ("user_total_orders", "0", "user_total_orders_positive"),
        ("up_times_purchased", "-1", "up_times_purchased_positive"),
        ("label", "2", "label_binary"),
        ("user_reorder_ratio", "cast(null as float)", "no_unexpected_nulls"),
    ],
)
def test_each_check_fails(good, column, value, check):
    assert failed(good.withColumn(column, F.expr(value))) == {check}


def test_duplicates_missing_columns_and_several_failures(good):
    assert failed(good.unionByName(good.limit(1))) == {"no_duplicate_pairs"}
    report = {r.check: r for r in validate.validate(good.drop("label")).collect()}
    assert not report["columns_present"].passed and "label" in report["columns_present"].detail
    assert "label_binary" not in report
    both = good.withColumn("label", F.lit(3)).withColumn("user_total_orders", F.lit(0))
    assert failed(both) == {"label_binary", "user_total_orders_positive"}
    with pytest.raises(validate.GateError, match="label_binary"):
        validate.gate(validate.validate(both))


def test_nullable_columns_may_be_null(good):
    assert not failed(good.withColumn("up_delta_days", F.lit(None).cast("float")))


def test_extended_checks(good):
    report = {r.check: r.passed for r in validate.validate_extended(good).collect()}
    assert report["up_reorder_rate_in_unit_range"] and report["both_classes_present"]
    bad = good.withColumn("product_reorder_rate", F.lit(1.5))
    assert not {r.check: r.passed for r in validate.validate_extended(bad).collect()}["product_reorder_rate_in_unit_range"]


# --- drift --------------------------------------------------------------------------------------
def numpy_psi(expected, actual):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, 11)))
    if len(edges) < 2:
        return 0.0
    a = (np.histogram(expected, edges)[0] + 1e-6) / len(expected)
    b = (np.histogram(actual, edges)[0] + 1e-6) / len(actual)
    return float(np.sum((b - a) * np.log(b / a)))


def numpy_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    return float(
        np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)))
    )


@pytest.mark.parametrize("shift", [0, 1, 25])
def test_psi_and_ks_match_numpy(spark, shift):
    draw = np.random.default_rng(11)
    data = {
        "x": (draw.normal(5, 1, 400), draw.normal(5 + shift, 1, 300)),
        "y": (draw.integers(0, 4, 400).astype(float), draw.integers(0, 6, 300).astype(float)),
        "constant": (np.ones(400), np.ones(300)),
    }
    ref = spark.createDataFrame(list(zip(*(v[0].tolist() for v in data.values()))), list(data))
    cur = spark.createDataFrame(list(zip(*(v[1].tolist() for v in data.values()))), list(data))
    psi = {r.feature: r.psi for r in drift.psi(ref, cur, list(data)).collect()}
    ks = {r.feature: r.ks for r in drift.ks(ref, cur, list(data)).collect()}
    for name, (a, b) in data.items():
        assert psi[name] == pytest.approx(numpy_psi(a, b), abs=1e-9)
        assert ks[name] == pytest.approx(numpy_ks(a, b), abs=1e-12)
        assert 0 <= ks[name] <= 1


def test_drift_report_flags_and_skips_empty_features(spark):
    same = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    moved = same.withColumn("x", F.col("x") + 1000)
    stable = drift.drift_by_feature(same, same, ["x", "y"])
    assert [(r.feature, r.psi, r.ks) for r in stable.collect()] == [("x", 0.0, 0.0)]
    assert not drift.drift_report(stable).first().drift_detected
    assert drift.drift_report(drift.drift_by_feature(same, moved, ["x"])).first().drift_detected
    with pytest.raises(ValueError, match="no monitored feature"):
        drift.drift_by_feature(same, same, ["absent"])


def test_stability_classes(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.25,)], "psi double")
    assert [r[0] for r in df.select(drift.stability(F.col("psi"))).collect()] == ["stable", "moderate", "significant"]


# --- integrity ----------------------------------------------------------------------------------
def test_orphans_duplicates_and_leaks(spark):
    fact = fact_rows(spark, [(1, 1, 1, None, "prior"), (9, 1, 2, 3.0, "train")])
    users = spark.createDataFrame([(1,)], "user_key long")
    found = {r.dimension: r.orphans for r in integrity.orphans(fact, users, dim_product(spark, [1])).collect()}
    assert found == {"user": 1, "product": 1}
    items = spark.createDataFrame([("prior", 1, 1), ("prior", 1, 1), ("prior", 1, 2)], "eval_set string, order_id int, product_id int")
    assert integrity.duplicate_pairs(items).first().duplicates == 1
    orders = spark.createDataFrame(
        [(1, 1, "prior", 2), (2, 1, "train", 1), (3, 1, "train", 3), (1, 2, "train", 1)],
        "order_id int, user_id int, eval_set string, order_number int",
    )
    leaks = {r.check: r.violations for r in integrity.temporal_leakage(orders).collect()}
    assert leaks == {
        "users_with_several_eval_orders": 1,
        "eval_order_not_last": 1,
        "order_ids_in_prior_and_train": 1,
    }
