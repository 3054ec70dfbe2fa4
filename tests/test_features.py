import random

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from cartlens.operators import features as fe
from cartlens.schemas import MATRIX, MATRIX_COLUMNS
from frames import dim_product, fact_rows, synthetic_star


def matrix(fact, dim, **kwargs):
    return fe.feature_matrix(fact, dim, **{"min_user_orders": 1, "min_product_orders": 1, **kwargs})


def test_leakage_is_strict(spark):
    def violations(prior_numbers, train_number):
        rows = [(1, n, 1, None, "prior") for n in prior_numbers] + [(1, train_number, 1, 3.0, "train")]
        fact = fact_rows(spark, rows)
        return fe.leakage_violations(fe.prior_rows(fact), fe.train_rows(fact)).count()

    assert violations([1, 2], 3) == 0
    assert violations([1, 2, 3], 3) == 1
    assert violations([1, 5], 3) == 1


def test_check_leakage_raises(spark):
    fact = fact_rows(spark, [(1, 3, 1, None, "prior"), (1, 2, 1, None, "train"), (2, 1, 1, None, "prior")])
    with pytest.raises(fe.LeakageError):
        fe.check_leakage(fe.prior_rows(fact), fe.train_rows(fact))


def test_multi_train_users(spark):
    fact = fact_rows(spark, [(1, 3, 1, None, "train"), (1, 4, 2, None, "train"), (2, 1, 1, None, "train")])
    assert [r.user_key for r in fe.multi_train_users(fact).collect()] == [1]


def test_labels_are_distinct_and_outer_pairs_get_zero(spark):
    rows = [(1, 1, 7, None, "prior"), (1, 2, 8, 5.0, "prior"), (1, 3, 7, 4.0, "train"), (1, 3, 9, 4.0, "train")]
    out = {r.product_key: r.label for r in matrix(fact_rows(spark, rows), dim_product(spark, [7, 8, 9])).collect()}
    assert out == {7: 1, 8: 0}  # product 9 was never bought in prior


def test_bought_once_has_no_gap_and_no_delta(spark):
    rows = [
        (1, 1, 1, None, "prior"),
        (1, 1, 2, None, "prior"),
        (1, 2, 2, 7.0, "prior"),
    ]
    out = {r.product_key: r for r in matrix(fact_rows(spark, rows), dim_product(spark, [1, 2])).collect()}
    assert out[1].up_avg_days_between_orders is None and out[1].up_delta_days is None
    assert out[1].up_days_since_last == 7.0
    assert out[2].up_avg_days_between_orders == 7.0 and out[2].up_delta_days == -7.0


def test_missing_gaps_sum_to_zero_and_last_known_gap_is_kept(spark):
    rows = [(1, 1, 1, 9.0, "prior"), (1, 2, 1, None, "prior"), (2, 1, 1, None, "prior"), (2, 2, 1, None, "prior")]
    fact = fact_rows(spark, rows)
    last = {r.user_key: r[1] for r in fe.last_days(fact).collect()}
    assert last == {1: 9.0, 2: None}
    pairs = {r.user_key: r.up_avg_days_between_orders for r in fe.add_days_between(fe.pair_base(fact)).collect()}
    assert pairs == {1: 9.0, 2: 0.0}


@pytest.mark.parametrize("chunk", [3, 4096])
def test_days_since_last_equals_the_theta_join(spark, monkeypatch, chunk):
    monkeypatch.setattr(fe, "ORDER_CHUNK", chunk)
    draw = random.Random(5)
    rows = []
    for user in range(1, 15):
        for number in sorted(draw.sample(range(1, 40), draw.randint(1, 20))):
            days = None if draw.random() < 0.2 else float(draw.randint(0, 30))
            rows += [(user, number, p, days, "prior") for p in draw.sample(range(6), draw.randint(1, 3))]
    fact = fact_rows(spark, rows)
    got = {
        (r.user_key, r.product_key): r.up_days_since_last
        for r in fe.add_days_since_last(fe.pair_base(fact), fe.basket_size(fact)).collect()
    }
    orders, last = {}, {}
    for user, number, product, days, _ in rows:
        orders[user, number] = days or 0.0
        last[user, product] = max(number, last.get((user, product), 0))
    expected = {
        (u, p): sum(d for (w, n), d in orders.items() if w == u and n > top) for (u, p), top in last.items()
    }
    assert got == expected


def test_user_filter_segment_and_ratio(spark):
    rows = [(u, n, p, None, "prior", 1, n % 2) for u, k in ((1, 6), (2, 2)) for n in range(1, k + 1) for p in (1, 2)]
    fact = fact_rows(spark, rows)
    out = fe.user_features(fe.basket_size(fact), fe.pair_base(fact), 5).collect()
    assert [(r.user_key, r.user_total_orders, r.user_segment_code) for r in out] == [(1, 6, 2)]
    assert out[0].user_avg_basket_size == 2.0 and out[0].user_distinct_products == 2
    assert out[0].user_reorder_ratio == 0.5


def test_category_codes_are_alphabetical_with_minus_one(spark):
    dim = spark.createDataFrame(
        [(i, n) for i, n in enumerate(["b", "a", None, "b", "Z"])], "product_key long, department_name string"
    )
    coded = fe.product_codes(dim).orderBy("product_key").collect()
    assert [r.department_key for r in coded] == [2, 1, -1, 2, 0]


def test_dimension_variants(spark):
    keyed = spark.createDataFrame([(1, 4, 9)], "product_key long, department_key int, aisle_id int")
    row = fe.product_codes(keyed).first()
    assert row.department_key == 4 and row.aisle_key == 9
    bare = spark.createDataFrame([(1,)], "product_key long")
    totals = fe.product_totals(fe.pair_base(fact_rows(spark, [(1, 1, 1, None, "prior")])))
    out = fe.product_features(totals, fe.product_codes(bare), 1).first()
    assert out.p_department_reorder_rate is None and out.p_aisle_reorder_rate is None


def test_favorite_breaks_ties_by_smallest_code(spark):
    rows = [(1, 1, 1, None, "prior"), (1, 1, 2, None, "prior"), (2, 1, 2, None, "prior"), (2, 2, 2, 1.0, "prior")]
    coded = spark.createDataFrame([(1, 5), (2, 3)], "product_key long, department_key int")
    out = fe.favorite(fe.pair_base(fact_rows(spark, rows)), coded, "department").collect()
    assert {r.user_key: r.u_favorite_department for r in out} == {1: 3, 2: 3}


def test_matrix_contract(spark):
    fact, dim = synthetic_star(spark)
    out = fe.feature_matrix(fact, dim, 2, 1)
    assert out.columns == MATRIX_COLUMNS
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in MATRIX.fields]
    assert out.count() == out.select("user_key", "product_key").distinct().count()
    checks = out.agg(
        F.max("up_reorder_rate"), F.min("up_orders_since_last_purchase"), F.sum("label"), F.min("user_total_orders")
    ).first()
    assert checks[0] <= 1 and checks[1] >= 0 and checks[2] == 80 and checks[3] == 4


def test_empty_orders_never_give_negative_recency(spark):
    # order number 9 is the second surviving order
    rows = [(1, 1, 1, None, "prior"), (1, 9, 2, 4.0, "prior")]
    out = matrix(fact_rows(spark, rows), dim_product(spark, [1, 2])).collect()
    assert {r.product_key: r.up_orders_since_last_purchase for r in out} == {1: 1, 2: 0}


def test_narrowing_raises_instead_of_wrapping(spark):
    fact = fact_rows(spark, [(1, 40000, 1, None, "prior")])
    dim = dim_product(spark, [1])
    with pytest.raises(ArithmeticException):
        matrix(fact, dim).collect()
    assert matrix(fact, dim, contract_types=False).first().up_last_order_number == 40000


def test_reports(spark):
    fact, dim = synthetic_star(spark)
    out = fe.feature_matrix(fact, dim, 2, 1)
    balance = fe.label_balance(out).first()
    assert balance.n_pos == 80 and balance.n_pos + balance.n_neg == out.count()
    assert fe.matrix_summary(out).first().users == 40
    nulls = {r.column_name: r.null_count for r in fe.null_report(out).collect()}
    assert nulls["up_delta_days"] == nulls["up_avg_days_between_orders"] > 0


def test_one_hot_columns(spark):
    from cartlens.operators import train

    frame = spark.createDataFrame([(1, 2, None), (2, -1, 7), (3, 2, 8)], "user_key int, a int, b int")
    codes = train.categories(frame.where("user_key < 3"), ["a", "b"])
    assert codes == {"a": [-1, 2], "b": [7]}
    encoded = train.one_hot(frame, codes)
    assert encoded.columns == ["user_key", "a_-1", "a_2", "b_7"]
    assert sorted(map(tuple, encoded.collect())) == [(1, 0, 1, 0), (2, 1, 0, 1), (3, 0, 1, 0)]


def test_name_codes_are_alphabetical_for_any_number_of_names(spark):
    from cartlens.operators import features as fe

    names = [f"n{i * 7919 % 3001:04}" for i in range(3_001)]
    dim = spark.createDataFrame([(n,) for n in names] * 2 + [(None,)], "name string")
    found = {r.name: r.code for r in fe.name_codes(dim, "name", "code").collect()}
    assert found == {n: i for i, n in enumerate(sorted(names))}
