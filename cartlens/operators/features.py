"""Leakage-free (user, product) feature matrix.

Everything derives from two grouped frames, one row per (user, order) and one per (user, product).
Both are combined map-side before their shuffle, so a user or product holding a large part of the
rows never lands in one task, and every distinct count becomes a plain count of grouped rows.

The matrix reads each grouped frame several times with different columns, which an optimiser
cannot share. ``stage`` is called with a name and such a frame and returns the frame to read on;
a job passes a function that writes it to shared storage, so the fact is scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartlens.functions.columns import narrow, ratio, segment_code
from cartlens.functions.ordering import running_totals
from cartlens.functions.staging import Stage, unstaged
from cartlens.schemas import (
    MATRIX,
    MATRIX_COLUMNS,
    MIN_PRODUCT_ORDERS,
    MIN_USER_ORDERS,
    NULLABLE_COLUMNS,
    SEGMENT_UPPER,
)

ORDER_CHUNK = 4096


class LeakageError(ValueError):
    """Raised when prior orders reach up to or past a user's evaluation order."""


def prior_rows(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("get_eval") == "prior")


def train_rows(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("get_eval") == "train")


# --- product dimension --------------------------------------------------------------------------
def name_codes(dim: DataFrame, name: str, code: str) -> DataFrame:
    """Alphabetical code of each distinct name.

    The code of a name is the number of names before it: names are counted in ranges, each in a task of its own, and
    range totals are added, so there may be any number of them.
    """
    names = dim.select(name).where(F.col(name).isNotNull()).distinct().withColumn("_n", F.lit(1))
    return running_totals(names, name, ["_n"]).select(name, F.col("_n_before").cast("int").alias(code))


def product_codes(dim_product: DataFrame) -> DataFrame:
    """Product dimension with integer ``department_key`` and ``aisle_key``.

    Keys already present are kept; otherwise they are alphabetical codes of the names (-1 for a
    missing name); ``aisle_id`` serves as aisle key when there is no name. A dimension without
    either stays without the key and its features are NULL.
    """
    dim = dim_product
    for level in ("department", "aisle"):
        key, name = f"{level}_key", f"{level}_name"
        if key in dim.columns:
            continue
        if name in dim.columns:
            dim = dim.join(name_codes(dim_product, name, key), name, "left").withColumn(
                key, F.coalesce(F.col(key), F.lit(-1))
            )
        elif level == "aisle" and "aisle_id" in dim.columns:
            dim = dim.withColumn(key, F.col("aisle_id"))
    return dim


# --- grouped frames -----------------------------------------------------------------------------
def basket_size(prior: DataFrame) -> DataFrame:
    """One row per (user, order) with its size and the order attributes."""
    return prior.groupBy("user_key", "order_key").agg(
        F.count("product_key").alias("basket_size"),
        F.sum("reordered").alias("reordered_items"),
        F.max("order_number").alias("order_number"),
        F.max("days_since_prior_order").alias("days_since_prior_order"),
    )


def pair_base(prior: DataFrame) -> DataFrame:
    """One row per (user, product) with the additive measures all pair features need."""
    return prior.groupBy("user_key", "product_key").agg(
        F.count("order_key").alias("up_times_purchased"),
        F.min("order_number").alias("up_first_order_number"),
        F.max("order_number").alias("up_last_order_number"),
        F.avg("add_to_cart_order").alias("up_avg_add_to_cart_order"),
        F.sum("add_to_cart_order").alias("cart_positions"),
        F.sum("reordered").alias("reordered_items"),
        F.coalesce(F.sum("days_since_prior_order"), F.lit(0.0)).alias("days_in_purchases"),
    )


# --- user features ------------------------------------------------------------------------------
def last_days(prior: DataFrame) -> DataFrame:
    """Last known gap in days per user, skipping orders without one."""
    return basket_size(prior).groupBy("user_key").agg(_last_known_days())


def _last_known_days():
    known = F.when(
        F.col("days_since_prior_order").isNotNull(), F.struct("order_number", "days_since_prior_order")
    )
    return F.max(known)["days_since_prior_order"].alias("user_days_since_last_order")


def user_features(
    baskets: DataFrame,
    pairs: DataFrame,
    min_user_orders: int = MIN_USER_ORDERS,
    segment_upper: int = SEGMENT_UPPER,
) -> DataFrame:
    """User-level features of users with at least ``min_user_orders`` prior orders."""
    per_user = (
        baskets.groupBy("user_key")
        .agg(
            F.count("*").alias("user_total_orders"),
            F.avg("basket_size").alias("user_avg_basket_size"),
            _last_known_days(),
            ratio(F.sum("reordered_items"), F.sum("basket_size")).alias("user_reorder_ratio"),
        )
        .where(F.col("user_total_orders") >= min_user_orders)
    )
    distinct_products = pairs.groupBy("user_key").agg(F.count("*").alias("user_distinct_products"))
    return per_user.join(distinct_products, "user_key", "left").withColumn(
        "user_segment_code", segment_code(F.col("user_total_orders"), segment_upper)
    )


# --- product features ---------------------------------------------------------------------------
def product_totals(pairs: DataFrame) -> DataFrame:
    """Per-product totals; unique users are the pair rows of the product."""
    return pairs.groupBy("product_key").agg(
        F.sum("up_times_purchased").alias("product_total_purchases"),
        F.sum("reordered_items").alias("reordered_items"),
        F.sum("cart_positions").alias("cart_positions"),
        F.count("*").alias("product_unique_users"),
    )


def level_rate(totals: DataFrame, coded: DataFrame, level: str) -> DataFrame:
    """Mean reorder rate of a department or aisle over all its prior lines."""
    key = f"{level}_key"
    return (
        totals.join(coded.select("product_key", key), "product_key")
        .groupBy(key)
        .agg(
            ratio(F.sum("reordered_items"), F.sum("product_total_purchases")).alias(f"p_{level}_reorder_rate")
        )
    )


def product_features(
    totals: DataFrame, coded: DataFrame, min_product_orders: int = MIN_PRODUCT_ORDERS
) -> DataFrame:
    """Product-level features of products with at least ``min_product_orders`` purchases.

    ``totals`` covers all products: department and aisle rates count lines of dropped ones too.
    """
    features = totals.where(F.col("product_total_purchases") >= min_product_orders).select(
        "product_key",
        "product_total_purchases",
        ratio(F.col("reordered_items"), F.col("product_total_purchases")).alias("product_reorder_rate"),
        ratio(F.col("cart_positions"), F.col("product_total_purchases")).alias("product_avg_add_to_cart"),
        "product_unique_users",
    )
    for level in ("department", "aisle"):
        key, rate = f"{level}_key", f"p_{level}_reorder_rate"
        if key in coded.columns:
            rates = coded.select("product_key", key).join(level_rate(totals, coded, level), key).select("product_key", rate)
            features = features.join(rates, "product_key", "left")
        else:
            features = features.withColumn(rate, F.lit(None).cast("double"))
    return features


# --- pair features ------------------------------------------------------------------------------
def days_after_order(baskets: DataFrame) -> DataFrame:
    """Per (user, order number): days the user let pass in later orders.

    A running sum from the latest order backwards. Orders are summed in chunks of
    ``ORDER_CHUNK`` consecutive numbers, so a user with very many orders is spread over tasks;
    users with a single chunk need no offset and drop out of the offset join.
    """
    orders = (
        baskets.groupBy("user_key", "order_number")
        .agg(F.max("days_since_prior_order").alias("days"))
        .withColumn("_chunk", F.floor(F.col("order_number") / ORDER_CHUNK))
    )
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("user_key", "_chunk").orderBy(F.desc("order_number")).rowsBetween(*before)
    chunks = orders.groupBy("user_key", "_chunk").agg(F.sum("days").alias("_days"))
    later = Window.partitionBy("user_key").orderBy(F.desc("_chunk")).rowsBetween(*before)
    offsets = (
        chunks.withColumn("_offset", F.sum("_days").over(later))
        .where(F.col("_offset") > 0)
        .select("user_key", "_chunk", "_offset")
    )
    return (
        orders.withColumn("_inside", F.coalesce(F.sum("days").over(inside), F.lit(0.0)))
        .join(offsets, ["user_key", "_chunk"], "left")
        .select(
            "user_key",
            "order_number",
            (F.col("_inside") + F.coalesce(F.col("_offset"), F.lit(0.0))).alias("later_days"),
        )
    )


def add_days_since_last(pairs: DataFrame, baskets: DataFrame) -> DataFrame:
    """Add ``up_days_since_last``: an equi join at each pair's last order, no order blow-up."""
    later = days_after_order(baskets).withColumnsRenamed(
        {"order_number": "up_last_order_number", "later_days": "up_days_since_last"}
    )
    return pairs.join(later, ["user_key", "up_last_order_number"])


def add_days_between(pairs: DataFrame) -> DataFrame:
    """Mean days between purchases; NULL for a product bought once."""
    return pairs.withColumn(
        "up_avg_days_between_orders",
        ratio(F.col("days_in_purchases"), F.col("up_times_purchased") - 1),
    )


def pair_features(baskets: DataFrame, pairs: DataFrame) -> DataFrame:
    """All (user, product) interaction features, and the label where the pairs carry one."""
    timed = add_days_between(add_days_since_last(pairs, baskets))
    return timed.select(
        "user_key",
        "product_key",
        "up_times_purchased",
        "up_first_order_number",
        "up_last_order_number",
        "up_avg_add_to_cart_order",
        "up_days_since_last",
        "up_avg_days_between_orders",
        (F.col("up_days_since_last") - F.col("up_avg_days_between_orders")).alias("up_delta_days"),
        *[c for c in ("label",) if c in pairs.columns],
    )


def favorite(pairs: DataFrame, coded: DataFrame, level: str) -> DataFrame:
    """Most bought department or aisle code per user; the smallest code wins a tie.

    A grouped maximum rather than a window: it is combined map-side for users with many rows.
    """
    key, target = f"{level}_key", f"u_favorite_{level}"
    if key not in coded.columns:
        return pairs.select("user_key").distinct().withColumn(target, F.lit(None).cast("int"))
    counts = (
        pairs.join(coded.select("product_key", key), "product_key")
        .groupBy("user_key", key)
        .agg(F.sum("up_times_purchased").alias("n"))
    )
    best = F.max(F.struct(F.col("n"), (-F.col(key)).alias("code")))["code"]
    return counts.groupBy("user_key").agg((-best).alias(target))


# --- label and leakage --------------------------------------------------------------------------
def label_pairs(train: DataFrame) -> DataFrame:
    """Distinct (user, product) pairs of the evaluation order, labelled 1."""
    return train.select("user_key", "product_key").distinct().withColumn("label", F.lit(1))


def leakage_violations(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Users whose last prior order does not precede their evaluation order."""
    last_prior = prior.groupBy("user_key").agg(F.max("order_number").alias("prior_max_order"))
    evaluated = train.groupBy("user_key").agg(F.max("order_number").alias("train_order"))
    return last_prior.join(evaluated, "user_key").where(F.col("prior_max_order") >= F.col("train_order"))


def multi_train_users(train: DataFrame) -> DataFrame:
    """Users with more than one evaluation order (a warning, not an error)."""
    orders = train.select("user_key", "order_number").distinct()
    return (
        orders.groupBy("user_key").agg(F.count("*").alias("train_orders")).where(F.col("train_orders") > 1)
    )


def check_leakage(prior: DataFrame, train: DataFrame) -> None:
    """Raise when any user violates the temporal order."""
    violations = leakage_violations(prior, train).count()
    if violations:
        raise LeakageError(f"{violations} users have prior orders at or after their train order")


# --- matrix -------------------------------------------------------------------------------------
def assemble(pairs: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Join pair, user and product features and add the derived ratios.

    The inner joins also keep only pairs whose user and product passed their filters.
    """
    joined = pairs.join(products, "product_key").join(users, "user_key")
    return joined.withColumns(
        {
            "up_reorder_rate": ratio(F.col("up_times_purchased"), F.col("user_total_orders")),
            "up_orders_since_last_purchase": F.greatest(
                F.col("user_total_orders") - F.col("up_last_order_number"), F.lit(0)
            ),
        }
    )


def with_favorites(users: DataFrame, pairs: DataFrame, coded: DataFrame) -> DataFrame:
    """User features with the favourite department and aisle."""
    for level in ("department", "aisle"):
        users = users.join(favorite(pairs, coded, level), "user_key", "left")
    return users


def feature_matrix(
    fact: DataFrame,
    dim_product: DataFrame,
    min_user_orders: int = MIN_USER_ORDERS,
    min_product_orders: int = MIN_PRODUCT_ORDERS,
    contract_types: bool = True,
    stage: Stage = unstaged,
) -> DataFrame:
    """The 26-column feature matrix, one row per (user, product) seen in prior.

    With ``contract_types`` the columns are narrowed to the contract schema (ANSI casts raise
    on overflow); without it integers stay BIGINT and fractions DOUBLE. Call
    :func:`check_leakage` first where a violation must stop the job.
    """
    prior, train = prior_rows(fact), train_rows(fact)
    baskets = stage("baskets", basket_size(prior))
    # the label joins on the grouping keys, so the pairs are not shuffled again for it
    labelled = pair_base(prior).join(label_pairs(train), ["user_key", "product_key"], "left")
    pairs = stage("pairs", labelled.withColumn("label", F.coalesce("label", F.lit(0))))
    totals = stage("product_totals", product_totals(pairs))
    coded = stage("product_codes", product_codes(dim_product))
    # written sides have known sizes, so the final joins build on the small side
    users = stage("user_features", with_favorites(user_features(baskets, pairs, min_user_orders), pairs, coded))
    products = stage("product_features", product_features(totals, coded, min_product_orders))
    matrix = assemble(pair_features(baskets, pairs), users, products).withColumns(
        {
            "up_days_since_last": F.coalesce("up_days_since_last", F.lit(0.0)),
            "user_segment_code": F.coalesce("user_segment_code", F.lit(0)),
        }
    )
    return narrow(matrix, MATRIX) if contract_types else matrix.select(*MATRIX_COLUMNS)


# --- matrix reports -----------------------------------------------------------------------------
def label_balance(matrix: DataFrame) -> DataFrame:
    """Positives, negatives and their ratio."""
    positives, negatives = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    return matrix.agg(
        positives.alias("n_pos"),
        negatives.alias("n_neg"),
        ratio(negatives, F.greatest(positives, F.lit(1))).alias("ratio"),
    )


def null_report(matrix: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null count and percent of the nullable columns, in one pass."""
    columns = NULLABLE_COLUMNS if columns is None else columns
    counted = matrix.agg(
        F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot("rows", columns, "column_name", "null_count").select(
        "column_name", "null_count", (ratio(F.col("null_count"), F.col("rows")) * 100).alias("null_pct")
    )


def matrix_summary(matrix: DataFrame) -> DataFrame:
    """Rows, distinct users and distinct products.

    Distinct keys are counted after grouping, so nothing is expanded.
    """
    per_user = matrix.groupBy("user_key").agg(F.count("*").alias("n"))
    users = per_user.agg(F.sum("n").alias("rows"), F.count("*").alias("users"))
    products = matrix.select("product_key").distinct().agg(F.count("*").alias("products"))
    return users.withColumn("products", products.scalar())


# --- preview features ---------------------------------------------------------------------------
def preview_pair(prior: DataFrame) -> DataFrame:
    """Pair preview on distinct orders."""
    return prior.groupBy("user_id", "product_id").agg(
        F.count("order_id").alias("up_orders"),
        F.avg("reordered").alias("up_reorder_rate"),
        F.avg("add_to_cart_order").alias("up_avg_cart_pos"),
        F.max("order_number").alias("up_last_order"),
    )


def preview_user(prior: DataFrame, orders: DataFrame) -> DataFrame:
    """User preview: order cadence from orders, reorder behaviour from lines."""
    cadence = (
        orders.where(F.col("eval_set") == "prior")
        .groupBy("user_id")
        .agg(F.count("order_id").alias("u_n_orders"), F.avg("days_since_prior_order").alias("u_avg_days"))
    )
    pairs = prior.groupBy("user_id", "product_id").agg(
        F.count("*").alias("n"), F.sum("reordered").alias("reordered_items")
    )
    behaviour = pairs.groupBy("user_id").agg(
        ratio(F.sum("reordered_items"), F.sum("n")).alias("u_reorder_rate"),
        F.count("*").alias("u_unique_prods"),
    )
    return cadence.join(behaviour, "user_id")


def preview_product(prior: DataFrame) -> DataFrame:
    """Product preview on distinct orders and users."""
    pairs = prior.groupBy("user_id", "product_id").agg(
        F.count("*").alias("n"),
        F.sum("reordered").alias("reordered_items"),
        F.sum("add_to_cart_order").alias("positions"),
    )
    return pairs.groupBy("product_id").agg(
        F.sum("n").alias("p_n_orders"),
        ratio(F.sum("reordered_items"), F.sum("n")).alias("p_reorder_rate"),
        ratio(F.sum("positions"), F.sum("n")).alias("p_avg_cart_pos"),
        F.count("*").alias("p_n_unique_users"),
    )


def proxy_matrix(prior: DataFrame, orders: DataFrame) -> DataFrame:
    """Candidate features used to look for redundancy before the matrix is built."""
    prior_orders = orders.where(F.col("eval_set") == "prior")
    users = prior_orders.groupBy("user_id").agg(
        F.count("order_id").alias("user_total_orders"),
        F.avg("days_since_prior_order").alias("user_days_since_last"),
        F.max("order_number").alias("_user_max_order"),
    )
    baskets = (
        prior.groupBy("user_id", "order_id")
        .agg(F.count("*").alias("n"))
        .groupBy("user_id")
        .agg(F.avg("n").alias("user_avg_basket_size"))
    )
    products = prior.groupBy("product_id").agg(
        F.count("order_id").alias("product_total_purchases"),
        F.avg("reordered").alias("product_reorder_rate"),
    )
    pairs = prior.groupBy("user_id", "product_id").agg(
        F.count("order_id").alias("up_times_purchased"),
        F.avg("reordered").alias("up_reorder_rate"),
        F.max("order_number").alias("up_last_order_number"),
        F.min("order_number").alias("up_first_order_number"),
        F.avg("add_to_cart_order").alias("up_avg_add_to_cart_order"),
    )
    return (
        pairs.join(users.join(baskets, "user_id"), "user_id")
        .join(products, "product_id")
        .withColumns(
            {
                "up_orders_since_last_purchase": F.col("_user_max_order") - F.col("up_last_order_number"),
                "up_purchase_frequency": ratio(F.col("up_times_purchased"), F.col("user_total_orders")),
            }
        )
        .drop("_user_max_order")
    )
