"""Descriptive reports over orders, baskets, users and the catalogue.

``prior`` is the consolidated prior history (one row per order line with product, aisle and
department names), ``orders`` the order table, ``products`` the catalogue.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartlens.functions.columns import as_rows, ratio, segment_code, segment_name
from cartlens.functions.ordering import (
    counted_percentiles,
    exact_percentiles,
    percentile_of,
    running_totals,
    seeded_fraction,
    value_counts,
)
from cartlens.functions.staging import Stage, unstaged
from cartlens.schemas import DAY_NAMES, MIN_PRODUCT_ORDERS

CATALOG_THRESHOLDS = (10, 50, 100, 500, 1000)
COLD_USER_THRESHOLDS = (1, 2, 3, 5)
COLD_PRODUCT_THRESHOLDS = (1, 5, 10, 20)
HIGHLIGHTED_GAPS = (7, 14, 21, 30)
FREQUENT_PRODUCTS = 100
BASKET_BLOCK = 512
HIGH_CORRELATION = 0.7
OTHERS = "Otros"


# --- shared shapes ------------------------------------------------------------------------------
def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )


def describe(
    df: DataFrame,
    columns: Sequence[str],
    percents: Sequence[int] = (25, 50, 75),
    small_domain: bool = False,
    stage: Stage = unstaged,
) -> DataFrame:
    """Count, mean, sample deviation, range and exact percentiles of each column.

    Values are counted first, in the one pass over all rows; what follows reads distinct values with their counts, which
    ``stage`` may write. ``small_domain`` as in :func:`exact_percentiles`.
    """
    values = _long(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    counted = stage("value_counts", values)
    n, value = F.when(F.col("value").isNotNull(), F.col("n")), F.col("value")
    totals = counted.groupBy("feature").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"),
        F.try_divide(F.sum(value * n), F.sum(n)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # a row per column; deviations from the mean lose no digits to large values
    off = counted.join(F.broadcast(totals.select("feature", "mean")), "feature").groupBy("feature")
    squares = off.agg(F.sum(n * (value - F.col("mean")) * (value - F.col("mean"))).alias("_squares"))
    moments = totals.join(squares, "feature").select(
        "feature",
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.try_divide(F.col("_squares"), F.col("count") - 1))).alias("std"),
        "min",
        "max",
    )
    known = counted.where(F.col("value").isNotNull())
    return moments.join(counted_percentiles(known, "value", percents, ["feature"], small_domain), "feature", "left")


def histogram(df: DataFrame, column: str, bins: int, cap: float | Column | None = None) -> DataFrame:
    """Equal-width histogram between the smallest and largest value, values above ``cap`` clipped.

    Bins are closed on the left, the last one on both sides; empty bins are not listed.
    """
    value = F.col(column).cast("double")
    if cap is not None:
        value = F.least(value, cap if isinstance(cap, Column) else F.lit(float(cap)))
    present = df.where(F.col(column).isNotNull())  # least() would turn a NULL into the cap
    counted = value_counts(present.select(value.alias("value")), [], "value")
    bounds = counted.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    placed = counted.withColumn("_b", bounds).select(
        "n",
        F.col("_b.lo").alias("lo"),
        ((F.col("_b.hi") - F.col("_b.lo")) / bins).alias("width"),
        F.least(
            F.coalesce(
                F.floor(
                    F.try_divide((F.col("value") - F.col("_b.lo")) * bins, F.col("_b.hi") - F.col("_b.lo"))
                ),
                F.lit(0),
            ),
            F.lit(bins - 1),
        ).alias("bin"),
    )
    return placed.groupBy((F.col("bin") + 1).alias("bin")).agg(
        F.first(F.col("lo") + F.col("width") * F.col("bin")).alias("lower"), F.sum("n").alias("n")
    )


def threshold_counts(
    df: DataFrame, column: str, thresholds: Sequence[int], at_most: bool, name: str
) -> DataFrame:
    """Rows at or beyond each threshold, absolute and as a share of all rows, in one pass."""
    value = F.col(column)
    hits = {t: F.count_if(value <= t if at_most else value >= t) for t in thresholds}
    counted = df.agg(F.count("*").alias("all"), *[n.alias(f"t{t}") for t, n in hits.items()])
    entries = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.col(f"t{t}").alias(name),
            (ratio(F.col(f"t{t}"), F.col("all")) * 100).alias("pct"),
        )
        for t in thresholds
    ]
    return counted.select(F.inline(F.array(*entries)))


def purchases(prior: DataFrame, key: str = "product_id") -> DataFrame:
    """Purchases and reorder rate per product (or other key)."""
    return prior.groupBy(key).agg(F.count("*").alias("purchases"), F.avg("reordered").alias("reorder_rate"))


def orders_per_user(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id").agg(F.max("order_number").alias("total_orders"))


def prior_orders_per_user(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("eval_set") == "prior").groupBy("user_id").agg(F.count("*").alias("prior_orders"))
    )


def cart_sizes(prior: DataFrame) -> DataFrame:
    return prior.groupBy("user_id", "order_id", "order_number").agg(F.count("*").alias("cart_size"))


def pairs(prior: DataFrame) -> DataFrame:
    """Observed (user, product) pairs with additive measures."""
    return prior.groupBy("user_id", "product_id").agg(
        F.count("*").alias("n"), F.sum("reordered").alias("reordered_items")
    )


def _rows(df: DataFrame, name: str) -> Column:
    return df.agg(F.count("*")).scalar().alias(name)


# --- structure ----------------------------------------------------------------------------------
def profile_columns(df: DataFrame, name: str) -> DataFrame:
    """Type, nulls, distinct values and a sample value per column.

    Values are unpivoted and grouped, one shuffle for all columns, instead of one distinct
    aggregate per column.
    """
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    long = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column_name", "value"
    )
    grouped = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    return grouped.groupBy("column_name").agg(
        F.lit(name).alias("table"),
        nulls.alias("nulls"),
        F.round(ratio(nulls, F.sum("n")) * 100, 2).alias("null_pct"),
        F.count("value").alias("distinct_values"),
        F.min("value").alias("sample"),
    ).withColumn("dtype", types[F.col("column_name")])


def structure(
    orders: DataFrame, prior_items: DataFrame, train_items: DataFrame, products: DataFrame
) -> DataFrame:
    """Table sizes, and whether every user has exactly one first order."""
    per_user = orders.groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("days_since_prior_order").isNull()).alias("first")
    )
    counts = per_user.agg(
        F.count("*").alias("users"), F.sum("n").alias("orders"), F.sum("first").alias("first_orders")
    ).select(
        "users",
        "orders",
        _rows(products.select("product_id").distinct(), "products"),
        _rows(products.select("department").distinct(), "departments"),
        _rows(products.select("aisle").distinct(), "aisles"),
        _rows(prior_items, "prior_items"),
        _rows(train_items, "train_items"),
        "first_orders",
        (F.col("first_orders") == F.col("users")).cast("int").alias("first_orders_match_users"),
    )
    return as_rows(counts)


# --- orders in time -----------------------------------------------------------------------------
def orders_by_day(orders: DataFrame) -> DataFrame:
    """Orders per named weekday; days without orders are listed with 0."""
    counted = orders.agg(*[F.count_if(F.col("order_dow") == d).alias(f"d{d}") for d in DAY_NAMES])
    entries = [
        F.struct(F.lit(d).alias("dow"), F.lit(name).alias("day"), F.col(f"d{d}").alias("orders"))
        for d, name in DAY_NAMES.items()
    ]
    return counted.select(F.inline(F.array(*entries)))


def orders_by_hour(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("order_hour_of_day").alias("hour")).agg(F.count("*").alias("orders"))


def peak_slots(orders: DataFrame) -> DataFrame:
    """Busiest hour and weekday (the first one on a tie)."""
    hour = F.min_by("hour", F.struct(-F.col("orders"), F.col("hour")))
    day = F.min_by("day", F.struct(-F.col("orders"), F.col("dow")))
    return orders_by_hour(orders).agg(hour.alias("peak_hour")).withColumn(
        "peak_day", orders_by_day(orders).agg(day).scalar()
    )


def day_hour_pivot(orders: DataFrame) -> DataFrame:
    """Orders by weekday (rows) and hour (columns h0..h23), empty cells 0."""
    hours = list(range(24))
    table = orders.groupBy("order_dow").pivot("order_hour_of_day", hours).agg(F.count("order_id"))
    return table.select(
        F.col("order_dow").alias("dow"),
        *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h}") for h in hours],
    )


def gap_distribution(orders: DataFrame) -> DataFrame:
    """Orders per gap in days, weekly and monthly gaps flagged."""
    gaps = orders.where(F.col("days_since_prior_order").isNotNull())
    return (
        gaps.groupBy(F.col("days_since_prior_order").alias("days"))
        .agg(F.count("*").alias("orders"))
        .withColumn("highlighted", F.col("days").isin(*HIGHLIGHTED_GAPS))
    )


# --- reordering ---------------------------------------------------------------------------------
def reorder_rate(prior: DataFrame) -> DataFrame:
    return prior.agg(F.avg("reordered").alias("reorder_rate"), F.count("*").alias("items"))


def class_balance(items: DataFrame) -> DataFrame:
    """Counts and shares of the reordered flag per evaluation set, with the 1:0 ratio."""
    ones, zeros = F.count_if(F.col("reordered") == 1), F.count_if(F.col("reordered") == 0)
    return items.groupBy("eval_set").agg(
        zeros.alias("class_0"),
        ones.alias("class_1"),
        ratio(zeros, F.count("reordered")).alias("share_0"),
        ratio(ones, F.count("reordered")).alias("share_1"),
        ratio(ones, zeros).alias("ratio_1_0"),
    )


def reorder_by_position(prior: DataFrame, positions: int = 15) -> DataFrame:
    return (
        prior.where(F.col("add_to_cart_order") <= positions)
        .groupBy("add_to_cart_order")
        .agg(F.avg("reordered").alias("reorder_rate"))
    )


def reorder_by_department(prior: DataFrame) -> DataFrame:
    """Reorder rate and items per department, flagged when above the overall rate."""
    per_department = prior.groupBy("department").agg(
        F.avg("reordered").alias("reorder_rate"), F.count("*").alias("n_items")
    )
    overall = reorder_rate(prior).select("reorder_rate").scalar()
    return per_department.withColumn("above_mean", F.col("reorder_rate") > overall)


def top_reordered(prior: DataFrame, min_orders: int = MIN_PRODUCT_ORDERS, limit: int = 20) -> DataFrame:
    """Products with the highest reorder rate among those bought often enough."""
    return (
        purchases(prior, "product_name")
        .where(F.col("purchases") >= min_orders)
        .orderBy(F.desc("reorder_rate"), "product_name")
        .limit(limit)
    )


def rate_filter_effect(prior: DataFrame, min_orders: int = MIN_PRODUCT_ORDERS) -> DataFrame:
    """How a purchase threshold changes the number of products and their mean reorder rate."""
    kept = F.col("purchases") >= min_orders
    return (
        purchases(prior)
        .agg(
            F.count("*").alias("products"),
            F.count_if(kept).alias("products_kept"),
            F.avg("reorder_rate").alias("mean_rate"),
            F.avg(F.when(kept, F.col("reorder_rate"))).alias("mean_rate_kept"),
        )
        .select(
            "*",
            (F.col("products") - F.col("products_kept")).alias("excluded"),
            ratio(F.col("products") - F.col("products_kept"), F.col("products")).alias("excluded_share"),
        )
    )


# --- users --------------------------------------------------------------------------------------
def user_volume(prior: DataFrame, orders: DataFrame) -> DataFrame:
    """Items, reorder rate and total orders per user."""
    bought = prior.groupBy("user_id").agg(
        F.count("*").alias("total_products"), F.avg("reordered").alias("reorder_rate")
    )
    return bought.join(orders_per_user(orders), "user_id")


def volume_correlation(prior: DataFrame, orders: DataFrame) -> DataFrame:
    return user_volume(prior, orders).agg(F.corr("total_orders", "reorder_rate").alias("correlation"))


def volume_sample(prior: DataFrame, orders: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    """Seeded fraction of the users' volumes."""
    volumes = user_volume(prior, orders)
    return volumes.join(seeded_fraction(volumes, "user_id", fraction, seed), "user_id", "left_semi")


def segment_summary(prior: DataFrame, orders: DataFrame, upper: int = 100) -> DataFrame:
    """Users, share and mean reorder rate per frequency segment."""
    segmented = orders_per_user(orders).withColumn("segment", segment_code(F.col("total_orders"), upper))
    rates = prior.groupBy("user_id").agg(F.avg("reordered").alias("rate"))
    summary = (
        segmented.where(F.col("segment") > 0)
        .join(rates, "user_id", "left")
        .groupBy("segment")
        .agg(F.count("*").alias("users"), F.avg("rate").alias("mean_reorder_rate"))
    )
    total = segmented.agg(F.count_if(F.col("segment") > 0)).scalar()
    return summary.withColumn("share", ratio(F.col("users"), total))


def cohort_basket(prior: DataFrame, orders_shown: int = 20) -> DataFrame:
    """Mean basket size by the user's order number."""
    return (
        cart_sizes(prior.where(F.col("order_number") <= orders_shown))
        .groupBy("order_number")
        .agg(F.avg("cart_size").alias("mean_cart_size"))
    )


def user_coverage(orders: DataFrame, min_prior: int = 5) -> DataFrame:
    """Users present in each evaluation set and lost by each filter, from flags per user."""
    flags = orders.groupBy("user_id").agg(
        F.count_if(F.col("eval_set") == "prior").alias("prior_n"),
        F.bool_or(F.col("eval_set") == "train").alias("train"),
    )
    prior, train, enough = F.col("prior_n") > 0, F.col("train"), F.col("prior_n") >= min_prior
    full = prior & train & enough
    counted = flags.agg(
        F.count("*").alias("total"),
        F.count_if(prior).alias("with_prior"),
        F.count_if(train).alias("with_train"),
        F.count_if(enough).alias("with_min_prior"),
        F.count_if(full).alias("full_coverage"),
        F.count_if(prior & ~train).alias("excluded_no_train"),
        F.count_if(prior & train & ~enough).alias("excluded_few_prior"),
        F.count_if(~full).alias("excluded_total"),
    )
    return as_rows(counted)


def eval_set_distribution(orders: DataFrame) -> DataFrame:
    """Orders, share and users per evaluation set."""
    per_user = orders.groupBy("eval_set", "user_id").agg(F.count("*").alias("n"))
    total = orders.agg(F.count("*")).scalar()
    return (
        per_user.groupBy("eval_set")
        .agg(F.sum("n").alias("orders"), F.count("*").alias("users"))
        .withColumn("share", ratio(F.col("orders"), total))
    )


# --- catalogue ----------------------------------------------------------------------------------
def top_products(prior: DataFrame, limit: int = 20) -> DataFrame:
    """Most bought products with a short label."""
    return (
        purchases(prior, "product_name")
        .select("product_name", "purchases", F.substring("product_name", 1, 30).alias("short_name"))
        .orderBy(F.desc("purchases"), "product_name")
        .limit(limit)
    )


def ranked_products(prior: DataFrame) -> DataFrame:
    """Products by descending purchases with rank and running totals (distributed)."""
    counts = prior.groupBy("product_id").agg(F.count("*").alias("purchases"))
    ordered = counts.select(
        "product_id",
        "purchases",
        F.lit(1).alias("one"),
        F.struct((-F.col("purchases")).alias("n"), F.col("product_id").alias("id")).alias("_order"),
    )
    return running_totals(ordered, "_order", ["one", "purchases"]).select(
        "product_id",
        "purchases",
        (F.col("one_before") + 1).alias("product_rank"),
        F.col("one_total").alias("products"),
        (F.col("purchases_before") + F.col("purchases")).alias("cumulative"),
        F.col("purchases_total").alias("total"),
    )


def lorenz_curve(prior: DataFrame) -> DataFrame:
    """Cumulative share of purchases over products in descending order."""
    return ranked_products(prior).select(
        "product_rank",
        "product_id",
        "purchases",
        ratio(F.col("product_rank"), F.col("products")).alias("product_share"),
        ratio(F.col("cumulative"), F.col("total")).alias("purchase_share"),
    )


def concentration(prior: DataFrame) -> DataFrame:
    """Share of purchases of the top 1% and 10% of products, and products bought once."""
    ranked = ranked_products(prior)

    def top_share(fraction: float) -> Column:
        inside = F.col("product_rank") <= F.floor(F.col("products") * F.lit(fraction))
        return ratio(F.sum(F.when(inside, F.col("purchases")).otherwise(0)), F.max("total")) * 100

    once = F.count_if(F.col("purchases") == 1)
    return ranked.agg(
        F.count("*").alias("products"),
        top_share(0.01).alias("top_1_pct_share"),
        top_share(0.10).alias("top_10_pct_share"),
        once.alias("bought_once"),
        (ratio(once, F.count("*")) * 100).alias("bought_once_pct"),
    )


def department_share(prior: DataFrame, top: int = 8) -> DataFrame:
    """Items per department, everything after the ``top`` largest rolled into one row."""
    counts = prior.groupBy("department").agg(F.count("*").alias("items"))
    largest = counts.orderBy(F.desc("items"), "department").limit(top).agg(F.collect_set("department"))
    named = F.when(F.array_contains("_largest", F.col("department")), F.col("department")).otherwise(OTHERS)
    rolled = counts.withColumn("_largest", largest.scalar()).groupBy(named.alias("department"))
    total = counts.agg(F.sum("items")).scalar()
    return rolled.agg(F.sum("items").alias("items")).withColumn("share", ratio(F.col("items"), total))


def top_aisles(prior: DataFrame, limit: int = 15) -> DataFrame:
    """Largest aisles with a combined label."""
    return (
        prior.groupBy("department", "aisle")
        .agg(F.count("*").alias("items"))
        .orderBy(F.desc("items"), "department", "aisle")
        .limit(limit)
        .withColumn("label", F.concat("aisle", F.lit(" ("), "department", F.lit(")")))
    )


def catalog_by_department(products: DataFrame) -> DataFrame:
    return products.groupBy("department").agg(F.count("*").alias("products"))


def sparsity(prior: DataFrame) -> DataFrame:
    """Share of the user-by-product grid never bought."""
    observed = pairs(prior)
    per_user = observed.groupBy("user_id").agg(F.count("*").alias("n"))
    counted = per_user.agg(F.count("*").alias("users"), F.sum("n").alias("observed")).withColumn(
        "products", _rows(observed.select("product_id").distinct(), "products")
    )
    possible = F.col("users") * F.col("products")
    return counted.select(
        "users",
        "products",
        "observed",
        possible.alias("possible"),
        (F.lit(1.0) - ratio(F.col("observed"), possible)).alias("sparsity"),
    )


def catalog_coverage(products: DataFrame, prior_items: DataFrame, train_items: DataFrame) -> DataFrame:
    """Catalogue products bought in prior, in train, in both and never."""
    # distinct first: a much bought product is one row of each side, not a hot key
    prior_ids = prior_items.select("product_id").distinct()
    train_ids = train_items.select("product_id").distinct()
    catalogue = products.select("product_id")
    never = catalogue.join(prior_ids, "product_id", "left_anti")
    counted = catalogue.distinct().agg(F.count("*").alias("catalogue")).select(
        "catalogue",
        _rows(prior_ids, "in_prior"),
        _rows(train_ids, "in_train"),
        _rows(prior_ids.join(train_ids, "product_id", "left_semi"), "in_both"),
        _rows(never.distinct(), "never_bought"),
    )
    return as_rows(counted)


def pairs_in_baskets(lines: DataFrame, block: int = BASKET_BLOCK) -> DataFrame:
    """All product pairs of every basket, (product_a < product_b, together), over distinct lines.

    A basket of at most ``block`` products is one sorted list, which gives its pairs where it is grouped:
    no copies of it are joined. Larger ones are joined with themselves in blocks.
    """
    large = lines.groupBy("order_id").agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    lists = (
        lines.join(large.select("order_id"), "order_id", "left_anti")
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_list("product_id")).alias("_products"))
    )
    first = lists.select("_products", F.posexplode("_products").alias("_at", "_a"))
    listed = first.select("_a", F.explode(F.slice("_products", F.col("_at") + 2, F.lit(block))).alias("_b"))
    pairs = listed.unionByName(_pairs_in_blocks(lines.join(large, "order_id"), block))
    return pairs.groupBy(F.col("_a").alias("product_a"), F.col("_b").alias("product_b")).agg(F.count("*").alias("together"))


def _pairs_in_blocks(lines: DataFrame, block: int) -> DataFrame:
    """Pairs (_a < _b) of baskets with ``_n`` products.

    A basket is dealt into blocks of about ``block`` products; every pair of blocks is a join key of its
    own, so a basket with very many products is joined by as many tasks as it has block pairs.
    """
    dealt = lines.withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    own = F.pmod(F.xxhash64("product_id"), F.col("_blocks")).cast("int")
    other = dealt.withColumn("_own", own).withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
    placed = other.select(
        "order_id", "product_id", "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j")
    )
    keys = ["order_id", "_i", "_j"]
    left = placed.where(F.col("_own") == F.col("_i")).select(*keys, F.col("product_id").alias("_a"))
    right = placed.where(F.col("_own") == F.col("_j")).select(*keys, F.col("product_id").alias("_b"))
    apart = (F.col("_i") < F.col("_j")) | (F.col("_a") < F.col("_b"))
    return left.join(right, keys).where(apart).select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b"))


def co_purchases(
    prior: DataFrame,
    products: DataFrame,
    limit: int = 15,
    frequent: int = FREQUENT_PRODUCTS,
    block: int = BASKET_BLOCK,
    stage: Stage = unstaged,
) -> DataFrame:
    """Product pairs most often in one basket, over whole baskets.

    A pair is in no more baskets than its rarer product. The exact counts among the ``frequent`` most
    bought products give a lower bound for the last reported pair, and products in fewer baskets
    than that cannot be part of the report. The bound only saves work: ties stay.
    """
    lines = stage("basket_lines", prior.select("order_id", "product_id").distinct())
    support = stage("basket_support", lines.groupBy("product_id").agg(F.count("*").alias("_baskets")))
    ranking = [F.desc("together"), "product_a", "product_b"]
    # at most ``frequent`` rows
    head = F.broadcast(support.orderBy(F.desc("_baskets"), "product_id").limit(frequent).select("product_id"))
    known = stage("basket_head", pairs_in_baskets(lines.join(head, "product_id", "left_semi"), block).orderBy(*ranking).limit(limit))
    bound = known.agg(F.when(F.count("*") == limit, F.min("together")).otherwise(F.lit(1))).scalar()
    able = support.where(F.col("_baskets") >= bound).select("product_id")
    top = stage("basket_pairs", pairs_in_baskets(lines.join(able, "product_id", "left_semi"), block).orderBy(*ranking).limit(limit))
    names = products.select("product_id", "product_name")
    for side in ("a", "b"):
        named = names.withColumnsRenamed({"product_id": f"product_{side}", "product_name": f"name_{side}"})
        top = top.join(named, f"product_{side}", "left")
    return top


# --- features -----------------------------------------------------------------------------------
def _pair_correlations(df: DataFrame, named: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of the given column pairs over rows where both values are present.

    Every pair needs sums of x, y, xx, yy, xy and a count over its own complete rows. All of them
    are entries of one Gram matrix over (centred value or 0, its square, presence flag) of each
    column, so one distributed pass serves all pairs and the driver only sees a matrix whose size
    is the number of columns. A task multiplies its rows by Arrow batch. Values must be finite.
    """
    columns = list(dict.fromkeys(c for pair in named for c in pair))
    data = df.select(*[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    averages = data.agg(*[F.avg(c).alias(c) for c in data.columns]).first()
    means = np.asarray([averages[c] or 0.0 for c in data.columns])
    if not np.isfinite(means).all():
        raise ValueError(f"not finite: {[c for c, m in zip(columns, means) if not np.isfinite(m)]}")

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3 * len(means),) * 2)
        for batch in batches:
            known = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            values = [c.fill_null(m).to_numpy() - m for c, m in zip(batch.columns, means)]
            wide = np.column_stack([*values, *[v * v for v in values], *known]).astype(np.float64)
            total += wide.T @ wide
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["gram"])

    parts = data.mapInArrow(multiplied, "gram binary").rdd.map(lambda r: np.frombuffer(bytes(r.gram)))
    gram = parts.treeAggregate(np.zeros(9 * len(means) ** 2), np.add, np.add).reshape(3 * len(means), -1)

    width = len(columns)
    place = {c: i for i, c in enumerate(columns)}

    def correlation(a: str, b: str) -> float | None:
        value_a, value_b = place[a], place[b]
        square_a, square_b = value_a + width, value_b + width
        flag_a, flag_b = value_a + 2 * width, value_b + 2 * width
        n = gram[flag_a, flag_b]
        if n < 2:
            return None
        sum_a, sum_b = gram[value_a, flag_b], gram[value_b, flag_a]
        spread_a = gram[square_a, flag_b] - sum_a * sum_a / n
        spread_b = gram[square_b, flag_a] - sum_b * sum_b / n
        if spread_a <= 0 or spread_b <= 0:
            return None
        return float((gram[value_a, value_b] - sum_a * sum_b / n) / math.sqrt(spread_a * spread_b))

    return df.sparkSession.createDataFrame(
        [(a, b, correlation(a, b)) for a, b in named],
        "feature_a string, feature_b string, correlation double",
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, (feature_a, feature_b, correlation)."""
    return _pair_correlations(df, list(combinations(columns, 2)))


def high_correlations(pairwise: DataFrame, limit: float = HIGH_CORRELATION) -> DataFrame:
    """Pairs whose absolute correlation exceeds the limit."""
    return pairwise.where(F.abs("correlation") > limit)


def label_correlations(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of each feature with the label."""
    known = matrix.select(F.col("label").cast("double").alias("_label"), *[F.col(c).cast("double").alias(c) for c in columns])
    found = known.agg(*[F.nullif(F.corr(c, "_label"), F.lit(float("nan"))).alias(c) for c in columns])
    return found.unpivot([], list(columns), "feature", "correlation")


def label_rate_by_segment(matrix_pairs: DataFrame, user_orders: DataFrame, upper: int = 9999) -> DataFrame:
    """Mean label per user segment."""
    segments = user_orders.select(
        "user_key", segment_name(segment_code(F.col("n_orders"), upper)).alias("segment")
    )
    return (
        matrix_pairs.join(segments, "user_key")
        .groupBy("segment")
        .agg(F.avg("label").alias("label_rate"), F.count("*").alias("pairs"))
    )


def labelled_pairs(prior: DataFrame, train: DataFrame) -> DataFrame:
    """All (user, product) pairs of the star schema's prior rows with their label."""
    bought = prior.groupBy("user_key", "product_key").agg(F.count("*").alias("times"))
    again = train.select("user_key", "product_key").distinct().withColumn("label", F.lit(1))
    return bought.join(again, ["user_key", "product_key"], "left").withColumn(
        "label", F.coalesce("label", F.lit(0))
    )


def times_by_label(matrix_pairs: DataFrame, cap: int = 20) -> DataFrame:
    """Pairs per label and number of purchases, clipped at ``cap``."""
    return matrix_pairs.groupBy("label", F.least("times", F.lit(cap)).alias("times")).agg(
        F.count("*").alias("pairs")
    )


def popularity_stats(prior: DataFrame, min_purchases: int = MIN_PRODUCT_ORDERS) -> DataFrame:
    """Mean, median and p99 of purchases per product, raw and log1p, and the share above a threshold."""
    counts = purchases(prior)
    percentiles = exact_percentiles(counts, "purchases", [50, 99], small_domain=True).agg(
        F.struct(F.max("p50").alias("p50"), F.max("p99").alias("p99"))
    )
    return (
        counts.agg(
            F.count("*").alias("products"),
            (ratio(F.count_if(F.col("purchases") >= min_purchases), F.count("*")) * 100).alias("pct_min_purchases"),
            F.avg("purchases").alias("mean"),
            F.avg(F.log1p("purchases")).alias("mean_log1p"),
        )
        .withColumn("_p", percentiles.scalar())
        .select("*", F.col("_p.p50").alias("median"), F.col("_p.p99").alias("p99"))
        .drop("_p")
    )


def clipped_histograms(df: DataFrame, columns: Sequence[str], bins: int = 40) -> DataFrame:
    """Histogram of each column clipped at its own 99th percentile, all columns in one pass."""
    located = running_totals(value_counts(_long(df, columns), ["feature"], "value"), "value", ["n"], ["feature"])
    bounds = located.groupBy("feature").agg(
        F.min("value").alias("lo"),
        percentile_of(99, F.col("n_before"), F.col("n"), F.col("n_total"), F.col("value")).alias("hi"),
    )
    # one row per column
    placed = located.join(F.broadcast(bounds), "feature")
    value = F.least("value", "hi")
    bin_of = F.floor(F.try_divide((value - F.col("lo")) * bins, F.col("hi") - F.col("lo")))
    return (
        placed.withColumn("bin", F.least(F.coalesce(bin_of, F.lit(0)), F.lit(bins - 1)))
        .groupBy("feature", "bin", "lo", "hi")
        .agg(F.sum("n").alias("n"))
        .select(
            "feature",
            (F.col("bin") + 1).alias("bin"),
            (F.col("lo") + (F.col("hi") - F.col("lo")) / bins * F.col("bin")).alias("lower"),
            "n",
        )
    )


def executive_summary(prior: DataFrame, orders: DataFrame) -> DataFrame:
    """Headline numbers as (metric, value)."""
    base = prior.agg(F.count("*").alias("prior_items"), F.avg("reordered").alias("reorder_rate"))
    busy = (
        orders_by_day(orders).agg(F.min_by("dow", F.struct(-F.col("orders"), F.col("dow")))).scalar()
    )

    def median(df: DataFrame, column: str) -> Column:
        return exact_percentiles(df, column, [50], small_domain=True).agg(F.max("p50")).scalar()

    counts = base.select(
        _rows(orders.select("user_id").distinct(), "users"),
        _rows(prior.select("product_id").distinct(), "products_in_prior"),
        _rows(orders.where(F.col("eval_set") == "prior"), "prior_orders"),
        "prior_items",
        "reorder_rate",
        median(orders_per_user(orders), "total_orders").alias("median_orders_per_user"),
        median(cart_sizes(prior), "cart_size").alias("median_items_per_order"),
        median(orders, "days_since_prior_order").alias("median_days_between_orders"),
        peak_slots(orders).select("peak_hour").scalar().alias("peak_hour"),
        busy.alias("peak_dow"),
        sparsity(prior).select(F.col("sparsity") * 100).scalar().alias("sparsity_pct"),
        concentration(prior).select("top_10_pct_share").scalar().alias("top_10_pct_share"),
    )
    return as_rows(counts)
