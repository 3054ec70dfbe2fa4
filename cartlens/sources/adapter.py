"""Adapter: the provided order tables expressed as basket source tables.

The provided files carry dated orders and order lines; the engine works on numbered orders with a
gap in days, numbered cart positions and a reordered flag, as grocery data sets publish them. The
adapter derives those columns. It is the only module that knows the provided tables; on real
basket data the readers in ``tables.py`` take its place.

``folded=True`` maps parts onto ``CATALOGUE`` products by part key so that users buy products
repeatedly. A cart holds a product once: lines of one order whose parts fold onto one product become
one cart position, as a quantity above one would. ``folded=False`` keeps each part as its own product.
Keys start at 1.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartlens.functions.staging import Stage, unstaged

CATALOGUE = 100


@dataclass(frozen=True)
class BasketSources:
    """Operational tables of the basket domain; ``history`` is items joined with their order.

    The history is derived when it is first asked for, so reports on orders, users or products alone do not move lines.
    """

    users: DataFrame
    orders: DataFrame
    products: DataFrame
    load_history: Callable[[], DataFrame]

    @cached_property
    def history(self) -> DataFrame:
        return self.load_history()

    @property
    def items(self) -> DataFrame:
        return self.history.select("order_id", "product_id", "add_to_cart_order", "reordered", "eval_set")

    @property
    def prior_items(self) -> DataFrame:
        return self.items.where(F.col("eval_set") == "prior").drop("eval_set")

    @property
    def train_items(self) -> DataFrame:
        return self.items.where(F.col("eval_set") == "train").drop("eval_set")

    @property
    def aisles(self) -> DataFrame:
        return self.products.select("aisle").distinct()

    @property
    def departments(self) -> DataFrame:
        return self.products.select("department").distinct()


def number_orders(orders: DataFrame) -> DataFrame:
    """Number each user's orders by date and measure the gap to the previous one.

    A user may own a large part of all orders. Row numbers are therefore drawn within a (user, day), and the per-user
    window only sees one row per calendar day. Both read one exchange by (user, day).
    """
    day = ["o_custkey", "o_orderdate"]
    in_day = Window.partitionBy(*day).orderBy("o_orderkey")
    ranked = orders.select("o_orderkey", *day).withColumn("_in_day", F.row_number().over(in_day))
    daily = ranked.groupBy(*day).agg(F.max("_in_day").cast("long").alias("_day_orders"))
    by_day = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    days = daily.select(
        "o_custkey",
        "o_orderdate",
        F.coalesce(
            F.sum("_day_orders").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_earlier"),
        F.lag("o_orderdate").over(by_day).alias("_previous"),
        F.sum("_day_orders").over(Window.partitionBy("o_custkey")).alias("_orders"),
    )
    numbered = ranked.join(days, day)
    number = F.col("_earlier") + F.col("_in_day")
    gap = F.when(F.col("_in_day") > 1, F.lit(0)).otherwise(F.datediff("o_orderdate", "_previous"))
    return numbered.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(number < F.col("_orders"), "prior")
        .when(F.col("o_custkey") % 10 == 0, "test")
        .otherwise("train")
        .alias("eval_set"),
        number.alias("order_number"),
        (F.dayofweek("o_orderdate") - 1).alias("order_dow"),
        (F.col("o_orderkey") % 24).alias("order_hour_of_day"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def raw_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Every order line as delivered, (order_id, product_id, eval_set), repeated products included."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    )
    return lines.join(orders.select("order_id", "eval_set"), "order_id")


def order_history(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines (order_id, product_id, l_linenumber) with cart position, order and reordered flag.

    Lines move twice: by order, where they are combined, placed and joined on one exchange, and by user and product.
    """
    # a repeated product is one row before the window and the join, so with the fold an order has at most CATALOGUE rows there
    combined = lines.repartition("order_id").groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("_line"))
    in_cart = Window.partitionBy("order_id").orderBy("_line", "product_id")
    placed = combined.withColumn("add_to_cart_order", F.row_number().over(in_cart)).drop("_line").join(orders, "order_id")
    first = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
    # a line without a product has its place in the cart, but is in no history
    return placed.where(F.col("product_id").isNotNull()).select(
        "order_id",
        "user_id",
        "product_id",
        "eval_set",
        "order_number",
        "order_dow",
        "order_hour_of_day",
        "days_since_prior_order",
        "add_to_cart_order",
        (F.col("order_number") > first).cast("int").alias("reordered"),
    )


def basket_sources(
    spark: SparkSession, sf_dir: str, folded: bool = True, stage: Stage = unstaged
) -> BasketSources:
    """Derive the operational basket tables from the provided parquet files.

    ``stage`` may write the numbered orders, which are read more than once.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def product_of(part_key: str):
        return F.col(part_key) % CATALOGUE + 1 if folded else F.col(part_key)

    orders = stage("orders", number_orders(read("orders")))
    lines = read("lineitem").select(
        F.col("l_orderkey").alias("order_id"), product_of("l_partkey").alias("product_id"), "l_linenumber"
    )

    parts = read("part")
    if folded:
        # the lowest part key of each fold names the product
        products = (
            parts.groupBy(product_of("p_partkey").alias("product_id"))
            .agg(F.min(F.struct("p_partkey", "p_name", "p_brand")).alias("_part"))
            .select("product_id", "_part.*")
        )
    else:
        products = parts.withColumn("product_id", F.col("p_partkey"))
    products = products.select(
        "product_id",
        F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_name").alias("aisle"),
        F.col("p_brand").alias("department"),
    )
    users = read("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("user_address"),
        (F.lit(16) + F.col("c_custkey") % 65).alias("user_age"),
    )
    return BasketSources(users=users, orders=orders, products=products, load_history=lambda: order_history(lines, orders))
