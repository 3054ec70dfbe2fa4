"""Constraints and the load job."""

import pytest
from pyspark.sql import functions as F

from cartlens.functions import ordering
from cartlens.operators import constraints, etl
from cartlens.plans import load
from cartlens.schemas import STAR_SCHEMAS


@pytest.fixture(scope="module")
def star(spark):
    users = spark.createDataFrame([(1, "Ann", "A st", None), (2, None, None, None)], STAR_SCHEMAS["dim_user"])
    products = spark.createDataFrame([(10, "milk", "dairy", "cold"), (11, "bread", "bakery", "dry")], STAR_SCHEMAS["dim_product"])
    lines = [(100, 1, 10, 1, 8, None, 1, 0, 1, "prior"), (100, 1, 11, 1, 8, None, 2, 0, 1, "prior"), (101, 2, 10, 2, 9, 3.0, 1, 1, 2, "train")]
    fact = spark.createDataFrame(lines, STAR_SCHEMAS["fact_order_products"])
    return {"dim_user": users, "dim_product": products, "fact_order_products": fact}


def broken(tables) -> dict:
    return {(r.table, r.kind, r["columns"]): r.violations for r in constraints.violations(tables).where("violations > 0").collect()}


def test_a_sound_star_breaks_nothing(star):
    assert broken(star) == {}
    constraints.enforce(star)
    assert constraints.violations({n: t.limit(0) for n, t in star.items()}).where("violations <> 0").isEmpty()


def test_every_kind_of_violation_is_found(spark, star):
    fact = star["fact_order_products"]
    more = [
        fact.where("order_key = 101"),  # the key once more
        fact.where("order_key = 101").withColumns({"order_key": F.lit(102), "user_key": F.lit(9)}),
        fact.where("order_key = 101").withColumns({"order_key": F.lit(103), "product_key": F.lit(99)}),
        fact.where("order_key = 101").withColumns({"order_key": F.lit(104), "get_eval": F.lit("a very long word")}),
        fact.where("order_key = 101").withColumns({"order_key": F.lit(None).cast("int"), "reordered": F.lit(None).cast("smallint")}),
    ]
    whole = fact
    for part in more:
        whole = whole.unionByName(part)
    users = star["dim_user"].withColumn("user_name", F.when(F.col("user_key") == 1, F.lit("x" * 151)))
    assert broken(star | {"fact_order_products": whole, "dim_user": users}) == {
        ("fact_order_products", "primary_key", "order_key, product_key"): 1,
        ("fact_order_products", "foreign_key", "user_key"): 1,
        ("fact_order_products", "foreign_key", "product_key"): 1,
        ("fact_order_products", "check", "get_eval"): 1,
        ("fact_order_products", "length", "get_eval"): 1,
        ("fact_order_products", "not_null", "order_key"): 1,
        ("fact_order_products", "not_null", "reordered"): 1,
        ("dim_user", "length", "user_name"): 1,
    }
    with pytest.raises(constraints.ConstraintError, match="foreign_key"):
        constraints.enforce(star | {"fact_order_products": whole})


def incoming(spark, days: int = 0, details=None, users: int = 3):
    """Every user has six prior orders and a train order of two products, each bought at least 50 times."""
    people = [(u, f"User {u}", f"Street {u}", 30) for u in range(1, users + 1)]
    orders, prior, train = [], [], []
    for u in range(1, users + 1):
        for n in range(1, 8):
            order = u * 100 + n
            orders.append((order, u, "prior" if n < 7 else "train", n, n % 7, "08", None if n == 1 else 5.0 + days))
            lines = [(order, p, p, int(n > 1)) for p in (1, 2)]
            (prior if n < 7 else train).extend(lines)
    for n in range(60):  # orders of a user that is not loaded make the products frequent
        orders.append((9_000 + n, 99, "prior", n + 1, 1, "10", None))
        prior.extend((9_000 + n, p, p, 0) for p in (1, 2))
    frame = spark.createDataFrame
    items = "order_id int, product_id int, add_to_cart_order int, reordered int"
    return load.Incoming(
        frame(people, "user_id int, user_name string, user_address string, user_age int"),
        frame([(p, f"Product {p}", "aisle", "department") for p in (1, 2, 3)], "product_id int, product_name string, aisle string, department string"),
        frame(orders, "order_id int, user_id int, eval_set string, order_number int, order_dow int, order_hour_of_day string, days_since_prior_order double"),
        frame(prior, items),
        frame(train, items),
        "2001-08-01",
        details,
    )


def states(report) -> list[tuple]:
    return [(r.table, r.state, r.rows) for r in report.collect()]


NAMES = ("dim_user", "dim_product", "fact_order_products")


def test_load_repeat_and_add(spark, folder):
    root = f"{folder}/star"
    assert load.current_run(spark, root) is None
    with pytest.raises(FileNotFoundError):
        load.read_star(spark, root)
    first = load.etl_job(spark, root, "one", incoming(spark))
    assert states(first) == [(n, "completed", k) for n, k in zip(NAMES, (3, 2, 42))]
    again = load.etl_job(spark, root, "one", incoming(spark))
    assert states(again) == [(n, "skipped", k) for n, k in zip(NAMES, (3, 2, 42))]
    # new values of known rows are ignored, new users are added
    second = load.etl_job(spark, root, "two", incoming(spark, days=7, users=4))
    assert states(second) == [(n, "completed", k) for n, k in zip(NAMES, (4, 2, 56))]
    fact = load.read_star(spark, root)["fact_order_products"]
    days = {r.user_key: r.d for r in fact.groupBy("user_key").agg(F.max("days_since_prior_order").alias("d")).collect()}
    assert days == {1: 5.0, 2: 5.0, 3: 5.0, 4: 12.0}


def test_a_stopped_load_is_resumed(spark, folder, monkeypatch):
    root = f"{folder}/star"
    load.etl_job(spark, root, "old", incoming(spark))
    real = etl.build_fact
    monkeypatch.setattr(etl, "build_fact", lambda *a: real(*a).withColumn("order_dow", F.raise_error(F.lit("stop")).cast("smallint")))
    failed = load.etl_job(spark, root, "new", incoming(spark, users=5))
    assert [r.state for r in failed.collect()] == ["completed", "completed", "failed"] and "stop" in failed.collect()[2].error
    assert load.current_run(spark, root) == "old" and load.read_star(spark, root)["dim_user"].count() == 3
    monkeypatch.setattr(etl, "build_fact", real)
    resumed = load.etl_job(spark, root, "new", incoming(spark, users=5))
    assert [r.state for r in resumed.collect()] == ["resumed", "resumed", "completed"]
    assert load.current_run(spark, root) == "new" and load.read_star(spark, root)["dim_user"].count() == 5


def test_a_star_that_breaks_its_rules_is_not_made_current(spark, folder, monkeypatch):
    root = f"{folder}/star"
    real = etl.build_fact
    monkeypatch.setattr(etl, "build_fact", lambda *a: real(*a).withColumn("get_eval", F.lit("other")))
    with pytest.raises(constraints.ConstraintError, match="get_eval"):
        load.etl_job(spark, root, "bad", incoming(spark))
    assert load.current_run(spark, root) is None


def test_users_without_a_name_are_filled_in(spark, folder):
    details = spark.createDataFrame([(1, "Z", "B\nroad"), (1, "A", "C"), (2, None, "D")], "user_key int, user_name string, user_address string")
    new = incoming(spark, details=details)
    unnamed = load.Incoming(new.users.withColumn("user_name", F.lit(None).cast("string")), *(getattr(new, f) for f in ("products", "orders", "prior_items", "train_items", "as_of", "details")))
    load.etl_job(spark, f"{folder}/star", "one", unnamed)
    found = {r.user_key: (r.user_name, r.user_address) for r in load.read_star(spark, f"{folder}/star")["dim_user"].collect()}
    assert found[1] == ("A", "C") and found[2][0] is None  # the smallest name of several, whatever their order


def test_one_row_of_each_key_is_the_smallest(spark):
    rows = [(1, "b", None), (1, "a", 2), (1, "a", 1), (2, None, 5), (2, "x", 1), (3, "q", None), (3, "q", 0)]
    frame = spark.createDataFrame(rows, "k int, s string, n int").repartition(5)
    assert sorted(map(tuple, etl.first_of_each(frame, ["k"]).collect())) == [(1, "a", 1), (2, None, 5), (3, "q", None)]


@pytest.mark.parametrize("pivots", [1, 2, 8, 128, 4096])
def test_running_totals_do_not_depend_on_ranges(spark, pivots):
    frame = spark.range(700).select((F.col("id") * 37 % 701).alias("v"), (F.col("id") % 5).alias("n"), (F.col("id") % 2).alias("g"))
    for keys in ([], ["g"]):
        expected = {}
        rows = sorted((tuple(r[k] for k in keys), r.v, r.n) for r in frame.collect())
        for group in {r[0] for r in rows}:
            before = 0
            for _, v, n in (r for r in rows if r[0] == group):
                expected[group, v] = before
                before += n
        found = ordering.running_totals(frame, "v", ["n"], keys, pivots).collect()
        assert {(tuple(r[k] for k in keys), r.v): r.n_before for r in found} == expected


def test_ranges_follow_the_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        assert ordering.default_pivots(spark.range(1)) == 2_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
