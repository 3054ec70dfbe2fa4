"""Star-schema ETL: operational tables to dimensions and the order-line fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartlens.functions.ordering import seeded_sample
from cartlens.schemas import MIN_PRODUCT_ORDERS, MIN_USER_ORDERS


def eligible_users(orders: DataFrame, min_prior: int = MIN_USER_ORDERS, min_train: int = 1) -> DataFrame:
    """Users with enough prior orders and an evaluation order."""
    per_user = orders.groupBy("user_id").agg(
        F.count_if(F.col("eval_set") == "prior").alias("prior_orders"),
        F.count_if(F.col("eval_set") == "train").alias("train_orders"),
    )
    return per_user.where((F.col("prior_orders") >= min_prior) & (F.col("train_orders") >= min_train))


def birth_date(age: Column, as_of: str) -> Column:
    """First of January of the as-of date moved back by the age."""
    return F.trunc(F.add_months(F.to_date(F.lit(as_of)), (age * F.lit(-12)).cast("int")), "year")


def build_dim_user(
    users: DataFrame, orders: DataFrame, as_of: str, n_users: int | None = None, seed: int = 42
) -> DataFrame:
    """User dimension of the eligible users, optionally a seeded sample of them."""
    keep = eligible_users(orders).select("user_id")
    if n_users is not None:
        keep = seeded_sample(keep, "user_id", n_users, seed)
    return users.join(keep, "user_id", "left_semi").select(
        F.col("user_id").alias("user_key"),
        "user_name",
        "user_address",
        birth_date(F.col("user_age"), as_of).alias("user_birthdate"),
    )


def eligible_products(prior_items: DataFrame, min_purchases: int = MIN_PRODUCT_ORDERS) -> DataFrame:
    """Products bought often enough in prior orders."""
    bought = prior_items.groupBy("product_id").agg(F.count("*").alias("purchases"))
    return bought.where(F.col("purchases") >= min_purchases)


def denormalise_products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """Products with their aisle and department names (inner joins on the id columns)."""
    return (
        products.join(aisles, "aisle_id")
        .join(departments, "department_id")
        .select("product_id", "product_name", "aisle", "department")
    )


def build_dim_product(products: DataFrame, eligible: DataFrame) -> DataFrame:
    """Product dimension of the eligible products."""
    return products.join(eligible, "product_id", "left_semi").select(
        F.col("product_id").alias("product_key"),
        "product_name",
        F.col("aisle").alias("aisle_name"),
        F.col("department").alias("department_name"),
    )


def union_items(prior_items: DataFrame, train_items: DataFrame) -> DataFrame:
    """All order lines of the prior and train files."""
    return prior_items.unionByName(train_items)


def consolidate(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the attributes of their order."""
    return items.join(orders, "order_id")


def build_fact(history: DataFrame, dim_user: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Order-line fact: prior and train lines of loaded users and products.

    ``history`` is the output of :func:`consolidate`. The dimensions only filter, so both joins
    are semi joins; no id list passes through the driver.
    """
    users = dim_user.select(F.col("user_key").alias("user_id"))
    products = dim_product.select(F.col("product_key").alias("product_id"))
    return (
        history.where(F.col("eval_set").isin("prior", "train"))
        .join(users, "user_id", "left_semi")
        .join(products, "product_id", "left_semi")
        .select(
            F.col("order_id").alias("order_key"),
            F.col("user_id").alias("user_key"),
            F.col("product_id").alias("product_key"),
            F.col("order_dow").cast("smallint").alias("order_dow"),
            F.col("order_hour_of_day").cast("smallint").alias("order_hour_of_day"),
            "days_since_prior_order",
            "add_to_cart_order",
            F.col("reordered").cast("smallint").alias("reordered"),
            "order_number",
            F.col("eval_set").alias("get_eval"),
        )
    )


def prior_full(history: DataFrame, products: DataFrame) -> DataFrame:
    """Consolidated prior history with product, aisle and department names."""
    return history.where(F.col("eval_set") == "prior").join(products, "product_id")


def first_of_each(frame: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest in the order of the other columns as they stand (null first).

    The aggregate is combined before its shuffle, so a key with very many rows is one row per task.
    """
    rest = [c for c in frame.columns if c not in keys]
    if not rest:
        return frame.distinct()
    # a flag before each value, as structs compare null after all others in no engine's stated way
    ordered = F.struct(*[e for i, c in enumerate(rest) for e in (F.col(c).isNotNull().alias(f"f{i}"), F.col(c).alias(f"v{i}"))])
    best = frame.groupBy(*keys).agg(F.min(ordered).alias("_best"))
    named = {c: F.col("_best")[f"v{i}"] for i, c in enumerate(rest)}
    return best.select(*[named.get(c, F.col(c)).alias(c) for c in frame.columns])


def backfill_dim_user(dim_user: DataFrame, incoming: DataFrame) -> DataFrame:
    """Fill the descriptive columns of users without a name from an incoming list.

    Of several incoming rows of a user with a name, the one with the smallest name, then address, counts.
    """
    named = incoming.where(F.col("user_name").isNotNull()).select(
        "user_key",
        F.col("user_name").alias("_name"),
        F.regexp_replace("user_address", "\n", ", ").alias("_address"),
    )
    new = first_of_each(named, ["user_key"])
    missing = F.col("user_name").isNull() & F.col("_name").isNotNull()
    return dim_user.join(new, "user_key", "left").select(
        *[
            F.when(missing, F.col(source)).otherwise(F.col(column)).alias(column)
            if (source := {"user_name": "_name", "user_address": "_address"}.get(column))
            else F.col(column)
            for column in dim_user.columns
        ]
    )


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` to append: new keys only, of several rows of a key the smallest."""
    return first_of_each(incoming.join(target.select(*keys), keys, "left_anti"), keys)
