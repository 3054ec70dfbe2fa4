"""Integrity checks of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartlens.functions.columns import as_rows, ratio
from cartlens.schemas import MIN_PRODUCT_ORDERS, MIN_USER_ORDERS


def _count(frame: DataFrame, name: str) -> DataFrame:
    return frame.agg(F.count("*").alias(name))


def _distinct(frame: DataFrame, column: str):
    return _count(frame.select(column).distinct(), column).scalar()


def volume(tables: dict[str, DataFrame]) -> DataFrame:
    """V-1: rows per table."""
    parts = [_count(f, "rows").select(F.lit(n).alias("table"), "rows") for n, f in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def eval_distribution(fact: DataFrame) -> DataFrame:
    """V-2: rows per evaluation set; there must be no test rows."""
    return fact.groupBy("get_eval").agg(F.count("*").alias("rows"))


def users_with_orders(fact: DataFrame, min_orders: int = MIN_USER_ORDERS) -> DataFrame:
    """Users with enough distinct prior orders."""
    orders = fact.where(F.col("get_eval") == "prior").select("user_key", "order_key").distinct()
    per_user = orders.groupBy("user_key").agg(F.count("*").alias("orders"))
    return per_user.where(F.col("orders") >= min_orders)


def products_with_rows(fact: DataFrame, min_rows: int = MIN_PRODUCT_ORDERS) -> DataFrame:
    """Products with enough rows over all evaluation sets."""
    per_product = fact.groupBy("product_key").agg(F.count("*").alias("rows"))
    return per_product.where(F.col("rows") >= min_rows)


def eligible_users(fact: DataFrame) -> DataFrame:
    """V-3: number of users with enough prior orders."""
    return _count(users_with_orders(fact), "eligible_users")


def eligible_products(fact: DataFrame) -> DataFrame:
    """V-4: number of products with enough rows."""
    return _count(products_with_rows(fact), "eligible_products")


def eligible_rows(fact: DataFrame) -> DataFrame:
    """V-5: fact rows of eligible users and eligible products."""
    kept = fact.join(users_with_orders(fact), "user_key", "left_semi").join(
        products_with_rows(fact), "product_key", "left_semi"
    )
    return _count(kept, "eligible_rows")


def null_days(fact: DataFrame) -> DataFrame:
    """V-6: missing gaps (first orders) in rows and percent, two decimals."""
    missing = F.count_if(F.col("days_since_prior_order").isNull())
    return fact.agg(
        F.count("*").alias("total_rows"),
        missing.alias("null_rows"),
        F.round(ratio(missing, F.count("*")) * 100, 2).alias("null_pct"),
    )


def orphans(fact: DataFrame, dim_user: DataFrame, dim_product: DataFrame) -> DataFrame:
    """V-7: fact rows without their user or product."""
    users = _count(fact.join(dim_user, "user_key", "left_anti"), "orphans")
    products = _count(fact.join(dim_product, "product_key", "left_anti"), "orphans")
    return users.select(F.lit("user").alias("dimension"), "orphans").unionByName(
        products.select(F.lit("product").alias("dimension"), "orphans")
    )


def summary(fact: DataFrame, dim_user: DataFrame, dim_product: DataFrame) -> DataFrame:
    """V-8: executive summary in one row."""
    return _count(fact, "facts_loaded").select(
        _count(dim_user, "n").scalar().alias("users_loaded"),
        _count(dim_product, "n").scalar().alias("products_loaded"),
        "facts_loaded",
        _distinct(fact, "order_key").alias("distinct_orders"),
        _distinct(fact.where(F.col("get_eval") == "prior"), "user_key").alias("users_with_prior"),
        _distinct(fact.where(F.col("get_eval") == "train"), "user_key").alias("users_with_train"),
    )


def users_in_both(fact: DataFrame) -> DataFrame:
    """Users present in both prior and train rows: one flagged row per user, combined before the shuffle."""
    seen = fact.groupBy("user_key").agg(
        F.bool_or(F.col("get_eval") == "prior").alias("prior"), F.bool_or(F.col("get_eval") == "train").alias("train")
    )
    return seen.where("prior and train").select("user_key")


def star_expectations(
    fact: DataFrame, dim_user: DataFrame, dim_product: DataFrame, expected: DataFrame
) -> DataFrame:
    """Post-load expectations as (check, passed, observed).

    ``expected`` is one row with ``users``, ``products``, ``facts``, ``users_in_both`` (a minimum)
    and ``orders`` (matched within 100).
    """
    orphan_rows = orphans(
        fact.select("user_key", "product_key").distinct(), dim_user, dim_product
    )

    def orphan(dimension: str):
        return orphan_rows.where(F.col("dimension") == dimension).select("orphans").scalar()

    seen = expected.select(
        F.struct(*expected.columns).alias("expected"),
        _count(dim_user, "n").scalar().alias("users"),
        _count(dim_product, "n").scalar().alias("products"),
        _count(fact, "n").scalar().alias("facts"),
        _count(fact.where(F.col("get_eval") == "test"), "n").scalar().alias("test_rows"),
        orphan("user").alias("orphan_users"),
        orphan("product").alias("orphan_products"),
        _count(users_in_both(fact), "n").scalar().alias("users_in_both"),
        _distinct(fact, "order_key").alias("orders"),
    )
    conditions = {
        "users": F.col("users") == F.col("expected.users"),
        "products": F.col("products") == F.col("expected.products"),
        "facts": F.col("facts") == F.col("expected.facts"),
        "test_rows": F.col("test_rows") == 0,
        "orphan_users": F.col("orphan_users") == 0,
        "orphan_products": F.col("orphan_products") == 0,
        "users_in_both": F.col("users_in_both") >= F.col("expected.users_in_both"),
        "orders": F.abs(F.col("orders") - F.col("expected.orders")) < 100,
    }
    checks = [
        F.struct(F.lit(name).alias("check"), passed.alias("passed"), F.col(name).alias("observed"))
        for name, passed in conditions.items()
    ]
    return seen.select(F.inline(F.array(*checks)))


def duplicate_pairs(items: DataFrame) -> DataFrame:
    """Surplus rows per evaluation set that repeat an (order, product) pair."""
    per_pair = items.groupBy("eval_set", "order_id", "product_id").agg(F.count("*").alias("n"))
    return per_pair.groupBy("eval_set").agg(F.sum(F.col("n") - 1).alias("duplicates"))


def order_stats(orders: DataFrame) -> DataFrame:
    """Order count, mean gap and range of order numbers."""
    return orders.agg(
        F.count("*").alias("orders"),
        F.avg("days_since_prior_order").alias("avg_days"),
        F.min("order_number").alias("min_order_number"),
        F.max("order_number").alias("max_order_number"),
    )


def catalog_listing(dim_product: DataFrame, limit: int = 20) -> DataFrame:
    """First products by name with their department and aisle."""
    return (
        dim_product.select("product_key", "product_name", "department_name", "aisle_name")
        .orderBy("product_name", "product_key")
        .limit(limit)
    )


def temporal_leakage(orders: DataFrame) -> DataFrame:
    """Counts that must be zero for a clean temporal split, as (check, violations)."""
    evaluated = F.col("eval_set").isin("train", "test")
    per_user = orders.groupBy("user_id").agg(
        F.count_if(evaluated).alias("eval_orders"),
        F.count_if(F.col("eval_set") == "train").alias("train_orders"),
        F.max("order_number").alias("last"),
    )
    late = orders.where(evaluated).join(per_user, "user_id").where(F.col("order_number") != F.col("last"))
    seen = orders.groupBy("order_id").agg(
        F.bool_or(F.col("eval_set") == "prior").alias("prior"), F.bool_or(F.col("eval_set") == "train").alias("train")
    )
    shared = seen.where("prior and train")
    counts = per_user.agg(
        F.count_if(F.col("eval_orders") > 1).alias("users_with_several_eval_orders")
    ).select(
        "users_with_several_eval_orders",
        _count(late, "n").scalar().alias("eval_order_not_last"),
        _count(shared, "n").scalar().alias("order_ids_in_prior_and_train"),
    )
    return as_rows(counts, "check", "violations").withColumn("violations", F.col("violations").cast("bigint"))
