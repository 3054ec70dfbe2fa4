import datetime

import pytest
from pyspark.sql import functions as F

from cartlens.operators import etl
from cartlens.schemas import SOURCE_SCHEMAS
from cartlens.sources import sinks, tables
from frames import dim_product, fact_rows


def test_csv_is_typed_and_missing_files_are_listed(spark, folder):
    aisles = spark.createDataFrame([(1, "bread"), (2, "milk, fresh")], "aisle_id int, aisle string")
    aisles.write.option("header", True).csv(f"{folder}/aisles.csv")
    loaded, missing = tables.load_csv_folder(spark, folder)
    assert loaded["aisles"].dtypes == [("aisle_id", "int"), ("aisle", "string")]
    assert sorted(r.aisle for r in loaded["aisles"].collect()) == ["bread", "milk, fresh"]
    assert missing[0] == "users" and "orders" in missing and "aisles" not in missing


def test_malformed_csv_fails(spark, folder):
    with open(f"{folder}/aisles.csv", "w") as out:
        out.write("aisle_id,aisle\nx,bread\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, f"{folder}/aisles.csv", SOURCE_SCHEMAS["aisles"]).collect()


def test_missing_parquet_raises(spark, folder):
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, f"{folder}/none")


def test_order_range_keeps_the_share_of_order_numbers(spark):
    fact = fact_rows(spark, [(10 * i, n, 1, None, "prior") for i, n in enumerate((1, 2, 8, 9), start=1)])
    kept = tables.order_range(fact, "2017-01-01", "2017-06-30")
    assert sorted(r.order_number for r in kept.collect()) == [1, 2]
    users = spark.createDataFrame([(10,), (20,), (30,), (40,)], "user_key long")
    assert sorted(r[0] for r in tables.active_users(users, kept).collect()) == [10, 20]


def test_load_tables_filters_only_tables_with_users(spark):
    fact = fact_rows(spark, [(u, 1, 1, None, "prior") for u in range(1, 21)])
    users = spark.createDataFrame(
        [(u, None, None, None) for u in range(1, 21)],
        "user_key long, user_name string, user_address string, user_birthdate date",
    )
    source = {"fact_order_products": fact, "dim_user": users, "dim_product": dim_product(spark, [1, 2])}
    loaded = tables.load_tables(source, list(source), n_users=5)
    assert loaded["dim_user"].count() == loaded["fact_order_products"].count() == 5
    assert loaded["dim_product"].count() == 2
    assert dict(loaded["fact_order_products"].dtypes)["reordered"] == "smallint"
    with pytest.raises(ValueError, match="unknown tables"):
        tables.load_tables(source, ["orders"])


def test_insert_ignore_and_backfill(spark):
    target = spark.createDataFrame([(1, "a")], "user_key long, user_name string")
    incoming = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "user_key long, user_name string")
    assert [tuple(r) for r in etl.insert_ignore(target, incoming, ["user_key"]).collect()] == [(2, "y")]

    dim = spark.createDataFrame(
        [(1, None, None), (2, "kept", "here"), (3, None, None)],
        "user_key long, user_name string, user_address string",
    )
    new = spark.createDataFrame(
        [(1, "one", "a\nb"), (2, "two", "c")], "user_key long, user_name string, user_address string"
    )
    rows = {r.user_key: tuple(r)[1:] for r in etl.backfill_dim_user(dim, new).collect()}
    assert rows == {1: ("one", "a, b"), 2: ("kept", "here"), 3: (None, None)}


def test_birth_date_is_the_first_of_january(spark):
    df = spark.createDataFrame([(20,), (0,)], "age int")
    out = [r[0] for r in df.select(etl.birth_date(F.col("age"), "2001-08-01")).collect()]
    assert out == [datetime.date(1981, 1, 1), datetime.date(2001, 1, 1)]


def test_load_report_counts_skips_and_stops(spark, folder):
    good = spark.range(7)

    def broken():
        raise RuntimeError("no source")

    report = sinks.load_with_report(spark, {"a": lambda: good, "b": broken, "c": lambda: good}, folder)
    assert [(r.table, r.state, r.rows) for r in report.collect()] == [
        ("a", "completed", 7),
        ("b", "failed", 0),
        ("c", "pending", 0),
    ]
    again = sinks.load_with_report(spark, {"a": lambda: good}, folder, skip_existing=True)
    assert again.first().state == "skipped"


def test_report_sinks_and_counts(spark, folder):
    counts = sinks.table_counts({"a": spark.range(3), "b": spark.range(4)})
    assert {r.table: r.rows for r in counts.collect()} == {"a": 3, "b": 4, "total": 7}
    sinks.write_json(counts, f"{folder}/json")
    sinks.write_csv(counts, f"{folder}/csv")
    assert spark.read.json(f"{folder}/json").count() == 3
    assert spark.read.option("header", True).csv(f"{folder}/csv").columns == ["table", "rows"]


def test_normalised_products_join_back(spark):
    products = spark.createDataFrame([(1, "p", 5, 7)], "product_id int, product_name string, aisle_id int, department_id int")
    aisles = spark.createDataFrame([(5, "bread")], "aisle_id int, aisle string")
    departments = spark.createDataFrame([(7, "bakery")], "department_id int, department string")
    assert tuple(etl.denormalise_products(products, aisles, departments).first()) == (1, "p", "bread", "bakery")
