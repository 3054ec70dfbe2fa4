"""Registry: every query name bound to its operator over a workspace."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlens.functions.columns import comparable, narrow
from cartlens.functions.ordering import seeded_sample
from cartlens.operators import (
    cluster,
    constraints,
    drift,
    eda,
    etl,
    features as fe,
    integrity,
    metrics,
    quality,
    recommend,
    split,
    train,
    validate,
)
from cartlens.plans import jobs, load
from cartlens.plans.workspace import AS_OF, Workspace
from cartlens.schemas import (
    SEGMENT_NAMES,
    FEATURE_COLUMNS,
    MATRIX,
    PRODUCT_CLUSTER_FEATURES,
    SOURCE_SCHEMAS,
    USER_CLUSTER_FEATURES,
)
from cartlens.sources import sinks, tables
from cartlens.sources.adapter import raw_lines

Query = Callable[[SparkSession, str], DataFrame]


def _over_workspace(operator: Callable[[Workspace], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(operator(Workspace.open(spark, sf_dir)))

    return query


def _prior(ws: Workspace) -> DataFrame:
    return fe.prior_rows(ws.fact)


def _train(ws: Workspace) -> DataFrame:
    return fe.train_rows(ws.fact)


def _prior_full(ws: Workspace, folded: bool = True) -> DataFrame:
    src = ws.sources(folded)
    return etl.prior_full(src.history, src.products)


FEATURES = {
    "fe_prior": _prior,
    "fe_train": _train,
    "fe_product_codes": lambda ws: fe.product_codes(ws.dim_product).select(
        "product_key", "department_name", "aisle_name", "department_key", "aisle_key"
    ),
    "fe_basket_size": lambda ws: fe.basket_size(_prior(ws)).select("user_key", "order_key", "basket_size"),
    "fe_last_days": lambda ws: fe.last_days(_prior(ws)),
    "fe_user_segment": lambda ws: fe.user_features(fe.basket_size(_prior(ws)), fe.pair_base(_prior(ws)))
    .groupBy("user_segment_code")
    .agg(F.count("*").alias("users")),
    "fe_user_features": lambda ws: fe.user_features(fe.basket_size(_prior(ws)), fe.pair_base(_prior(ws))),
    "fe_dept_rate": lambda ws: fe.level_rate(
        fe.product_totals(fe.pair_base(_prior(ws))), fe.product_codes(ws.dim_product), "department"
    ),
    "fe_aisle_rate": lambda ws: fe.level_rate(
        fe.product_totals(fe.pair_base(_prior(ws))), fe.product_codes(ws.dim_product), "aisle"
    ),
    "fe_product_features": lambda ws: fe.product_features(
        fe.product_totals(fe.pair_base(_prior(ws))), fe.product_codes(ws.dim_product)
    ),
    "fe_pair_base": lambda ws: fe.pair_base(_prior(ws)).drop(
        "cart_positions", "reordered_items", "days_in_purchases"
    ),
    "fe_days_since_last": lambda ws: fe.add_days_since_last(fe.pair_base(_prior(ws)), fe.basket_size(_prior(ws))).select(
        "user_key", "product_key", "up_days_since_last"
    ),
    "fe_avg_days_between": lambda ws: fe.add_days_between(fe.pair_base(_prior(ws))).select(
        "user_key", "product_key", "up_avg_days_between_orders"
    ),
    "fe_pair_features": lambda ws: fe.pair_features(fe.basket_size(_prior(ws)), fe.pair_base(_prior(ws))),
    "fe_favorite_department": lambda ws: fe.favorite(
        fe.pair_base(_prior(ws)), fe.product_codes(ws.dim_product), "department"
    ),
    "fe_favorite_aisle": lambda ws: fe.favorite(
        fe.pair_base(_prior(ws)), fe.product_codes(ws.dim_product), "aisle"
    ),
    "fe_label": lambda ws: fe.label_pairs(_train(ws)),
    "fe_leakage_violations": lambda ws: fe.leakage_violations(_prior(ws), _train(ws)),
    "fe_multi_train_users": lambda ws: fe.multi_train_users(_train(ws)),
    "fe_feature_matrix": lambda ws: fe.feature_matrix(
        ws.fact, ws.dim_product, contract_types=False, stage=ws.stage
    ),
    "fe_label_balance": lambda ws: fe.label_balance(ws.matrix),
    "fe_null_report": lambda ws: fe.null_report(ws.matrix),
    "fe_matrix_summary": lambda ws: fe.matrix_summary(ws.matrix),
    "eda_preview_user": lambda ws: fe.preview_user(_prior_full(ws), ws.sources().orders),
    "eda_preview_product": lambda ws: fe.preview_product(_prior_full(ws)),
    "eda_preview_pair": lambda ws: fe.preview_pair(_prior_full(ws)),
    "eda_proxy_matrix": lambda ws: fe.proxy_matrix(_prior_full(ws), ws.sources().orders),
}


SAMPLE_USERS = 1000
SCORING_COLUMNS = [c for c in MATRIX.names if c != "label"]
DATE_RANGE = ("2017-04-01", "2017-09-30")


def _star(ws: Workspace) -> dict[str, DataFrame]:
    return {"dim_user": ws.dim_user, "dim_product": ws.dim_product, "fact_order_products": ws.fact}


def _csv_scan(ws: Workspace) -> DataFrame:
    path = f"{ws.path}/csv/orders.csv"
    ws.sources().orders.write.mode("overwrite").option("header", True).csv(path)
    return tables.read_csv(ws.spark, path, SOURCE_SCHEMAS["orders"])


def _sample_propagate(ws: Workspace) -> DataFrame:
    src = ws.sources()
    frames = tables.sample_sources(src.orders, src.prior_items, src.train_items, SAMPLE_USERS)
    parts = [
        frame.agg(F.count("*").alias("rows"), F.sum("order_id").alias("id_sum")).withColumn("table", F.lit(name))
        for name, frame in zip(("orders", "prior", "train"), frames, strict=True)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _roundtrip(ws: Workspace) -> DataFrame:
    sinks.save_tables({"fact_order_products": ws.fact}, f"{ws.path}/roundtrip")
    return tables.read_parquet(ws.spark, f"{ws.path}/roundtrip/fact_order_products")


def _insert_ignore(ws: Workspace) -> DataFrame:
    keys = ["order_key", "product_key"]
    target = _train(ws).select(*keys, "get_eval")
    incoming = ws.fact.select(*keys, "get_eval").unionByName(target)
    return target.unionByName(etl.insert_ignore(target, incoming, keys))


def _backfill(ws: Workspace) -> DataFrame:
    unnamed = F.col("user_birthdate") < F.lit("1960-01-01").cast("date")
    loaded = ws.dim_user.withColumn("user_name", F.when(~unnamed, F.col("user_name")))
    incoming = ws.sources().users.select(
        F.col("user_id").alias("user_key"),
        F.concat(F.lit("New "), "user_name").alias("user_name"),
        F.concat(F.lit("Moved\n"), "user_address").alias("user_address"),
    )
    return etl.backfill_dim_user(loaded, incoming)


def _etl_steps(ws: Workspace) -> dict[str, Callable[[], DataFrame]]:
    src = ws.sources()
    dim_user = etl.build_dim_user(src.users, src.orders, AS_OF)
    dim_product = etl.build_dim_product(_denormalised(ws), etl.eligible_products(src.prior_items))
    items = etl.union_items(src.prior_items, src.train_items)
    history = etl.consolidate(items, src.orders)
    return {
        "dim_user": lambda: dim_user,
        "dim_product": lambda: dim_product,
        "fact_order_products": lambda: etl.build_fact(history, dim_user, dim_product),
    }


def _denormalised(ws: Workspace) -> DataFrame:
    """Products through separate aisle and department tables, as the source schema keeps them."""
    products = ws.sources().products
    aisles = fe.name_codes(products, "aisle", "aisle_id")
    departments = fe.name_codes(products, "department", "department_id")
    normalised = (
        products.join(aisles, "aisle").join(departments, "department").drop("aisle", "department")
    )
    return etl.denormalise_products(normalised, aisles, departments)


def _load_report(ws: Workspace) -> DataFrame:
    return sinks.load_with_report(ws.spark, _etl_steps(ws), f"{ws.path}/etl")


def _star_tables(ws: Workspace) -> dict[str, DataFrame]:
    return {"dim_user": ws.dim_user, "dim_product": ws.dim_product, "fact_order_products": ws.fact}


def _incoming(ws: Workspace) -> load.Incoming:
    src = ws.sources()
    return load.Incoming(src.users, _denormalised(ws), src.orders, src.prior_items, src.train_items, AS_OF)


def _etl_counts(ws: Workspace) -> DataFrame:
    """Rows of each table after the load has run, run again, and run once more as another load of the same rows."""
    root = f"{ws.path}/star_{uuid.uuid4().hex[:8]}"
    for run in ("first", "first", "second"):
        report = load.etl_job(ws.spark, root, run, _incoming(ws))
    return load.counts(report)


def _orphans(ws: Workspace) -> DataFrame:
    history = ws.sources().history.select(
        F.col("user_id").alias("user_key"), F.col("product_id").alias("product_key")
    )
    return (
        integrity.orphans(ws.fact, ws.dim_user, ws.dim_product)
        .withColumn("source", F.lit("fact"))
        .unionByName(
            integrity.orphans(history, ws.dim_user, ws.dim_product).withColumn("source", F.lit("history"))
        )
    )


def _expectations(ws: Workspace) -> DataFrame:
    src = ws.sources()
    users = etl.eligible_users(src.orders).select("user_id")
    products = etl.eligible_products(src.prior_items).select("product_id")
    evaluated = F.col("eval_set").isin("prior", "train")

    def count(frame: DataFrame):
        return frame.agg(F.count("*")).scalar()

    facts = (
        src.history.where(evaluated).join(users, "user_id", "left_semi").join(products, "product_id", "left_semi")
    )
    orders = src.orders.where(evaluated).join(users, "user_id", "left_semi")
    expected = users.agg(F.count("*").alias("users")).select(
        "users",
        count(products).alias("products"),
        count(facts).alias("facts"),
        (F.col("users") * 0.95).alias("users_in_both"),
        count(orders).alias("orders"),
    )
    return integrity.star_expectations(ws.fact, ws.dim_user, ws.dim_product, expected)


SOURCES = {
    "scan_csv_typed": lambda ws: _csv_scan(ws).withColumn(
        "order_hour_of_day", F.col("order_hour_of_day").cast("int")
    ),
    "scan_parquet": lambda ws: tables.read_parquet(ws.spark, ws.written_path("matrix", lambda: ws.matrix)),
    "load_projection_cast": lambda ws: tables.load_tables(_star(ws), ["fact_order_products"])[
        "fact_order_products"
    ],
    "load_filter_users": lambda ws: tables.load_tables(
        _star(ws), ["dim_user", "fact_order_products"], n_users=SAMPLE_USERS
    )["fact_order_products"],
    "sample_users": lambda ws: seeded_sample(ws.dim_user, "user_key", SAMPLE_USERS, 42),
    "sample_propagate": _sample_propagate,
    "date_range_order_proxy": lambda ws: tables.order_range(ws.fact, *DATE_RANGE),
    "date_range_dim_user": lambda ws: tables.active_users(ws.dim_user, tables.order_range(ws.fact, *DATE_RANGE)),
    "sink_parquet_roundtrip": _roundtrip,
    "publish_snapshot": lambda ws: tables.read_parquet(
        ws.spark, sinks.publish(narrow(ws.matrix, MATRIX), f"{ws.path}/published", "actual")
    ),
    "sink_insert_ignore": _insert_ignore,
    "dim_user_backfill": _backfill,
    "load_report": lambda ws: _load_report(ws).drop("seconds"),
    "table_counts": lambda ws: sinks.table_counts(
        {
            "users": ws.sources().users,
            "products": ws.sources().products,
            "orders": ws.sources().orders,
            "order_products_prior": ws.sources().prior_items,
            "order_products_train": ws.sources().train_items,
        }
    ),
}

ETL = {
    "etl_eligible_users": lambda ws: etl.eligible_users(ws.sources().orders),
    "etl_dim_user": lambda ws: etl.build_dim_user(ws.sources().users, ws.sources().orders, AS_OF),
    "etl_eligible_products": lambda ws: etl.eligible_products(ws.sources().prior_items),
    "etl_dim_product": lambda ws: _etl_steps(ws)["dim_product"](),
    "etl_union_items": lambda ws: etl.union_items(ws.sources().prior_items, ws.sources().train_items),
    "etl_fact": lambda ws: _etl_steps(ws)["fact_order_products"](),
    "prior_full": lambda ws: _prior_full(ws).drop("eval_set"),
    "etl_full_counts": _etl_counts,
}

INTEGRITY = {
    "star_constraints": lambda ws: constraints.violations(_star_tables(ws)),
    "v1_volume": lambda ws: integrity.volume(_star(ws)),
    "v2_eval_distribution": lambda ws: integrity.eval_distribution(ws.fact),
    "v3_eligible_users": lambda ws: integrity.eligible_users(ws.fact),
    "v4_eligible_products": lambda ws: integrity.eligible_products(ws.fact),
    "v5_eligible_rows": lambda ws: integrity.eligible_rows(ws.fact),
    "v6_null_days": lambda ws: integrity.null_days(ws.fact),
    "v7_orphans": _orphans,
    "v8_summary": lambda ws: integrity.summary(ws.fact, ws.dim_user, ws.dim_product),
    "users_prior_and_train": lambda ws: integrity.users_in_both(ws.fact).agg(
        F.count("*").alias("users_in_both")
    ),
    "star_expectations": _expectations,
    "duplicate_pairs": lambda ws: ws.stage(
        "duplicate_pairs", integrity.duplicate_pairs(raw_lines(ws.spark, ws.sf_dir, ws.sources().orders))
    ),
    "order_stats": lambda ws: integrity.order_stats(ws.sources().orders),
    "catalog_listing": lambda ws: integrity.catalog_listing(ws.dim_product),
    "risk_temporal_leakage": lambda ws: integrity.temporal_leakage(ws.sources().orders),
}


def _splits(ws: Workspace) -> DataFrame:
    """Matrix rows with their split, written once in a folder per split: readers of one split read its files alone."""

    def build() -> DataFrame:
        return split.with_split(ws.matrix, ws.written("split", lambda: split.split_users(ws.matrix)))

    return ws.written("matrix_by_split", build, "split")


def _part(ws: Workspace, name: str) -> DataFrame:
    """Rows of one split, scored by the rule score (share of the user's orders with the product)."""
    return _splits(ws).where(F.col("split") == name).withColumn("score", F.col("up_reorder_rate"))


def _snapshots(ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """Reference and current matrices: the train users against all held-out users."""
    rows = _splits(ws)
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") != "train")


def _by_feature(ws: Workspace) -> DataFrame:
    return drift.drift_by_feature(*_snapshots(ws), stage=ws.stage)


def _scaled(ws: Workspace) -> DataFrame:
    train = _part(ws, "train")
    parts = []
    for entity, features in (("user", USER_CLUSTER_FEATURES), ("product", PRODUCT_CLUSTER_FEATURES)):
        key = f"{entity}_key"
        profile = split.profiles(train, key, features)
        scaled = split.scaled_profiles(profile, key, features, split.profile_stats(profile, features))
        parts.append(
            scaled.unpivot(key, list(features), "feature", "value").select(
                F.lit(entity).alias("entity"), F.col(key).alias("entity_key"), "feature", "value"
            )
        )
    return parts[0].unionByName(parts[1])


def _rec_history(ws: Workspace) -> DataFrame:
    """Prior history of all users, not only those loaded into the star schema."""
    return ws.sources().history.where(F.col("eval_set") == "prior").withColumnsRenamed(
        {"order_id": "order_key", "user_id": "user_key", "product_id": "product_key"}
    )


def _known_users(ws: Workspace) -> DataFrame:
    return ws.sources().users.select(F.col("user_id").alias("user_key"))


def _requests(ws: Workspace) -> DataFrame:
    """Every known user and one id nobody has."""
    users = _known_users(ws)
    return users.unionByName(users.agg((F.max("user_key") + 1).alias("user_key")))


def _routed(ws: Workspace) -> DataFrame:
    return ws.written("routed", lambda: recommend.routes(_requests(ws), _rec_history(ws), _known_users(ws)))


def _scoring(ws: Workspace) -> DataFrame:
    return ws.written(
        "scoring", lambda: recommend.scoring_matrix(_routed(ws), _rec_history(ws), ws.dim_product, stage=ws.stage)
    )


def _cold_personal(ws: Workspace) -> DataFrame:
    return recommend.with_names(recommend.personal_top(_routed(ws), _rec_history(ws)), ws.dim_product)


def _rec_batch(ws: Workspace) -> DataFrame:
    flat = ws.written(
        "rec_batch", lambda: recommend.batch(_routed(ws), _rec_history(ws), ws.dim_product, _scoring(ws), score="up_reorder_rate")
    )
    return flat.na.fill({"rank": 0, "product_key": -1, "probability": 0.0, "product_name": "", "error": ""})


VALIDATION = {
    "validate_nulls": lambda ws: validate.null_counts(ws.matrix),
    "validate_matrix": lambda ws: validate.validate(ws.matrix),
    "validate_extended": lambda ws: validate.validate_extended(ws.matrix),
}

DRIFT = {
    "drift_psi": lambda ws: drift.psi(*_snapshots(ws), stage=ws.stage),
    "drift_ks": lambda ws: drift.ks(*_snapshots(ws), stage=ws.stage),
    "drift_by_feature": _by_feature,
    "drift_report": lambda ws: drift.drift_report(_by_feature(ws)),
    "drift_class": lambda ws: _by_feature(ws).select("feature", drift.stability(F.col("psi")).alias("stability")),
}

MODELLING = {
    "split_users": lambda ws: split.split_users(ws.matrix),
    "split_sizes": lambda ws: split.split_sizes(ws.matrix, split.split_users(ws.matrix)),
    "profile_user": lambda ws: split.profiles(_part(ws, "train"), "user_key", USER_CLUSTER_FEATURES),
    "profile_product": lambda ws: split.profiles(_part(ws, "train"), "product_key", PRODUCT_CLUSTER_FEATURES),
    "profile_scaled": _scaled,
    "class_weight": lambda ws: split.class_weight(ws.matrix),
    "eval_confusion": lambda ws: metrics.confusion(_part(ws, "test"), F.col("score") >= 0.5),
    "eval_auc": lambda ws: metrics.auc(_part(ws, "test")),
    "baseline_popularity": lambda ws: metrics.popularity_baseline(_part(ws, "train")),
    "baseline_metrics": lambda ws: metrics.baseline_metrics(
        _part(ws, "test"), metrics.popularity_baseline(_part(ws, "train"))
    ),
    "topk_per_user": lambda ws: metrics.top_k_per_user(_part(ws, "test")).select(
        "user_key", "product_key", "rank", "score"
    ),
    "uplift_topk": lambda ws: metrics.uplift(
        _part(ws, "test"), metrics.popularity_baseline(_part(ws, "train"))
    ),
    "ndcg_at_10": lambda ws: metrics.ndcg(_part(ws, "test")),
}

RECOMMENDATION = {
    "rec_order_counts": lambda ws: recommend.order_counts(_requests(ws), _rec_history(ws)),
    "rec_routing": _routed,
    "rec_cold_personal": lambda ws: ws.written("cold_personal", lambda: _cold_personal(ws)),
    "rec_global_top": lambda ws: recommend.with_names(recommend.global_top(_rec_history(ws)), ws.dim_product),
    "rec_product_features": lambda ws: recommend.catalogue_features(
        fe.product_totals(fe.pair_base(_rec_history(ws))), ws.dim_product
    ),
    "rec_scoring_matrix": lambda ws: _scoring(ws).drop("label").select(*SCORING_COLUMNS),
    "rec_rule_topk": lambda ws: recommend.scored_top(_scoring(ws), score="up_reorder_rate"),
    "rec_batch": _rec_batch,
}


def _orders(ws: Workspace) -> DataFrame:
    return ws.sources().orders


def _profiles(ws: Workspace) -> DataFrame:
    src = ws.sources()
    frames = {
        "orders": src.orders,
        "order_products_prior": src.prior_items,
        "order_products_train": src.train_items,
        "products": src.products,
    }
    result = None
    for name, frame in frames.items():
        one = eda.profile_columns(frame, name).drop("sample", "dtype")
        result = one if result is None else result.unionByName(one)
    return result


def _labelled(ws: Workspace) -> DataFrame:
    return eda.labelled_pairs(_prior(ws), _train(ws))


def _star_user_orders(ws: Workspace) -> DataFrame:
    orders = _prior(ws).select("user_key", "order_key").distinct()
    return orders.groupBy("user_key").agg(F.count("*").alias("n_orders"))


def _user_products(ws: Workspace) -> DataFrame:
    return eda.pairs(_prior_full(ws)).groupBy("user_id").agg(F.count("*").alias("products"))


def _baskets(ws: Workspace) -> DataFrame:
    """Basket sizes per order and their mean per user, described together."""
    carts = eda.cart_sizes(_prior_full(ws))
    means = carts.groupBy("user_id").agg(F.avg("cart_size").alias("mean_cart_per_user"))
    return eda.describe(carts, ["cart_size"], (50, 95), small_domain=True).unionByName(
        eda.describe(means, ["mean_cart_per_user"], (50, 95))
    )


PROXY_FEATURES = [
    "user_total_orders",
    "user_avg_basket_size",
    "user_days_since_last",
    "product_total_purchases",
    "product_reorder_rate",
    "up_times_purchased",
    "up_reorder_rate",
    "up_orders_since_last_purchase",
    "up_first_order_number",
    "up_last_order_number",
    "up_purchase_frequency",
    "up_avg_add_to_cart_order",
]
PAIR_HISTOGRAMS = [
    "up_times_purchased",
    "up_avg_add_to_cart_order",
    "up_days_since_last",
    "up_avg_days_between_orders",
    "up_delta_days",
    "up_last_order_number",
]


def _proxy_correlations(ws: Workspace) -> DataFrame:
    proxy = ws.written("proxy", lambda: fe.proxy_matrix(_prior_full(ws), _orders(ws)))
    return eda.correlations(proxy, PROXY_FEATURES)


EDA = {
    "profile_columns": _profiles,
    "eda_structure": lambda ws: eda.structure(
        _orders(ws), ws.sources().prior_items, ws.sources().train_items, ws.sources().products
    ),
    "orders_per_user_stats": lambda ws: eda.describe(
        eda.orders_per_user(_orders(ws)), ["total_orders"], small_domain=True
    ),
    "basket_stats": _baskets,
    "hist_basket_clipped": lambda ws: eda.histogram(eda.cart_sizes(_prior_full(ws)), "cart_size", 49, 50),
    "hist_orders_per_user": lambda ws: eda.histogram(eda.orders_per_user(_orders(ws)), "total_orders", 50),
    "hist_days_between": lambda ws: eda.histogram(_orders(ws), "days_since_prior_order", 30),
    "hist_prior_orders_clipped": lambda ws: eda.histogram(
        eda.prior_orders_per_user(_orders(ws)), "prior_orders", 29, 30
    ),
    "hist_product_purchases_clipped": lambda ws: eda.histogram(
        eda.purchases(_prior_full(ws, False)), "purchases", 80, 200
    ),
    "hist_user_products_clipped": lambda ws: eda.histogram(_user_products(ws), "products", 50, 300),
    "hist_pair_features": lambda ws: eda.clipped_histograms(ws.matrix, PAIR_HISTOGRAMS),
    "orders_by_dow": lambda ws: eda.orders_by_day(_orders(ws)),
    "orders_by_hour": lambda ws: eda.orders_by_hour(_orders(ws)),
    "peak_slots": lambda ws: eda.peak_slots(_orders(ws)),
    "dow_hour_pivot": lambda ws: eda.day_hour_pivot(_orders(ws)),
    "days_between_distribution": lambda ws: eda.gap_distribution(_orders(ws)),
    "days_last_stats": lambda ws: eda.describe(
        fe.last_days(_prior(ws)), ["user_days_since_last_order"], (50, 95), small_domain=True
    ),
    "reorder_global": lambda ws: eda.reorder_rate(_prior_full(ws)),
    "reorder_class_balance": lambda ws: eda.class_balance(
        ws.sources().history.where(F.col("eval_set") != "test")
    ),
    "reorder_by_cart_position": lambda ws: eda.reorder_by_position(_prior_full(ws)),
    "reorder_by_department": lambda ws: eda.reorder_by_department(_prior_full(ws)),
    "catalog_thresholds": lambda ws: eda.threshold_counts(
        eda.purchases(_prior_full(ws)), "purchases", eda.CATALOG_THRESHOLDS, False, "products"
    ),
    "top_reordered_products": lambda ws: eda.top_reordered(_prior_full(ws)),
    "product_rate_filter_effect": lambda ws: eda.rate_filter_effect(_prior_full(ws)),
    "user_volume_vs_reorder": lambda ws: eda.user_volume(_prior_full(ws), _orders(ws)),
    "corr_orders_reorder": lambda ws: eda.volume_correlation(_prior_full(ws), _orders(ws)),
    "top_products": lambda ws: eda.top_products(_prior_full(ws)),
    "lorenz_curve": lambda ws: eda.lorenz_curve(_prior_full(ws, False)),
    "concentration_top_pct": lambda ws: eda.concentration(_prior_full(ws, False)),
    "department_share_top8": lambda ws: eda.department_share(_prior_full(ws)),
    "top_aisles": lambda ws: eda.top_aisles(_prior_full(ws)),
    "catalog_by_department": lambda ws: eda.catalog_by_department(ws.sources(False).products),
    "segment_summary": lambda ws: eda.segment_summary(_prior_full(ws), _orders(ws)),
    "cohort_basket": lambda ws: eda.cohort_basket(_prior_full(ws)),
    "sample_fraction": lambda ws: eda.volume_sample(_prior_full(ws), _orders(ws)),
    "matrix_sparsity": lambda ws: eda.sparsity(_prior_full(ws, False)),
    "cold_start_users": lambda ws: eda.threshold_counts(
        eda.prior_orders_per_user(_orders(ws)), "prior_orders", eda.COLD_USER_THRESHOLDS, True, "users"
    ),
    "cold_start_products": lambda ws: eda.threshold_counts(
        eda.purchases(_prior_full(ws, False)), "purchases", eda.COLD_PRODUCT_THRESHOLDS, True, "products"
    ),
    "catalog_coverage": lambda ws: eda.catalog_coverage(
        ws.sources(False).products, ws.sources(False).prior_items, ws.sources(False).train_items
    ),
    "co_purchase_pairs": lambda ws: eda.co_purchases(
        _prior_full(ws, False), ws.sources(False).products, stage=ws.stage
    ),
    "feature_correlations": _proxy_correlations,
    "high_correlations": lambda ws: eda.high_correlations(_proxy_correlations(ws)),
    "matrix_correlations": lambda ws: eda.correlations(ws.matrix, FEATURE_COLUMNS),
    "label_correlations": lambda ws: eda.label_correlations(ws.matrix, FEATURE_COLUMNS),
    "eval_set_distribution": lambda ws: eda.eval_set_distribution(_orders(ws)),
    "user_coverage": lambda ws: eda.user_coverage(_orders(ws)),
    "eda_summary": lambda ws: eda.executive_summary(_prior_full(ws), _orders(ws)),
    "label_rate_by_segment": lambda ws: eda.label_rate_by_segment(_labelled(ws), _star_user_orders(ws)),
    "times_purchased_by_label": lambda ws: eda.times_by_label(_labelled(ws)),
    "popularity_stats": lambda ws: eda.popularity_stats(_prior_full(ws, False)),
    "feature_describe": lambda ws: eda.describe(
        ws.matrix, FEATURE_COLUMNS, (25, 50, 75, 99), stage=ws.stage_under("feature_describe")
    ),
    "cart_position_stats": lambda ws: eda.describe(
        _prior(ws), ["add_to_cart_order"], (50,), small_domain=True
    ),
}

QUALITY = {
    "risk_class_imbalance": lambda ws: quality.class_imbalance(ws.sources().prior_items),
    "risk_cardinality": lambda ws: quality.cardinality(ws.sources(False).products, ws.sources(False).prior_items),
    "risk_long_tail": lambda ws: quality.long_tail(ws.sources(False).prior_items),
    "risk_pareto80": lambda ws: quality.pareto(ws.sources(False).prior_items),
    "risk_user_sparsity": lambda ws: quality.user_sparsity(_orders(ws)),
    "risk_mean_sparsity": lambda ws: quality.mean_sparsity(_prior_full(ws, False), ws.sources(False).products),
    "risk_popularity_bias": lambda ws: quality.popularity_bias(ws.sources(False).prior_items),
    "risk_popularity_bins": lambda ws: quality.popularity_bins(ws.sources(False).prior_items),
    "risk_report": lambda ws: quality.risk_report(
        _orders(ws), ws.sources(False).history, ws.sources(False).products
    ),
}


# The whole training and the whole search, as the surveyed pipeline runs them.
TRAINING = jobs.TrainingConfig()
SEARCH_TRIALS = 50
_STEPS: dict[tuple[str, str], object] = {}
_STEP_LOCKS: dict[tuple[str, str], threading.Lock] = {}
_STEPS_LOCK = threading.Lock()


def _step(ws: Workspace, name: str, build: Callable[[], object]):
    """A step of the training, done once per workspace; other steps and workspaces do not wait for it."""
    key = (ws.path, name)
    with _STEPS_LOCK:
        lock = _STEP_LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _STEPS:
            _STEPS[key] = build()
        return _STEPS[key]


def _one_hot(ws: Workspace) -> DataFrame:
    encoded = train.one_hot(ws.matrix, {"user_segment_code": list(SEGMENT_NAMES)})
    return encoded.select("user_key", "product_key", *[f"user_segment_code_{c}" for c in SEGMENT_NAMES])


def _clustered(ws: Workspace) -> jobs.Clustered:
    return _step(ws, "clusters", lambda: jobs.fit_clusters(ws.matrix, TRAINING, ws.stage))


def _ready(ws: Workspace) -> jobs.Prepared:
    return _step(ws, "prepared", lambda: jobs.prepare(ws.matrix, _clustered(ws), ws.stage))


def _trained(ws: Workspace) -> jobs.Trained:
    return _step(ws, "trees", lambda: jobs.fit_model(ws.matrix, TRAINING, ws.stage, _clustered(ws), _ready(ws)))


def _preprocessed(ws: Workspace) -> DataFrame:
    rows = train.preprocess(ws.matrix, train.medians(_part(ws, "train")))
    return rows.select(
        "user_key",
        "product_key",
        "up_avg_days_between_orders",
        "up_delta_days",
        "up_avg_days_between_orders_missing",
    )


def _assigned(ws: Workspace) -> DataFrame:
    """Clusters per pair and split, -1 for users and products outside the train profiles."""
    return _clustered(ws).assigned.select("user_key", "product_key", "split", "user_cluster", "product_cluster")


def _tuned(ws: Workspace) -> DataFrame:
    ready = _ready(ws)
    _, trials = train.search(ready.rows, ready.coded, SEARCH_TRIALS, TRAINING.params)
    return trials


def _comparison(ws: Workspace) -> DataFrame:
    columns = ["model", "precision", "recall", "f1"]
    popular = metrics.popularity_baseline(_part(ws, "train"))
    candidates = {
        "popularity": metrics.baseline_metrics(_part(ws, "test"), popular),
        "reorder rate rule": metrics.confusion(_part(ws, "test"), F.col("score") >= 0.5),
        "gradient boosted trees": _trained(ws).test_metrics,
    }
    rows = None
    for name, metric in candidates.items():
        one = metric.withColumn("model", F.lit(name)).select(*columns)
        rows = one if rows is None else rows.unionByName(one)
    return metrics.compare_models(ws.stage("model_comparison", rows))


def _model_batch(ws: Workspace) -> DataFrame:
    return recommend.scored_top(jobs.score_requests(_scoring(ws), _trained(ws)))


def _published_batch(ws: Workspace) -> DataFrame:
    """Users and rows of each outcome of a batch scored with a model that was published and read back."""
    root = f"{ws.path}/published_model"
    trained = _trained(ws)
    jobs.publish_model(trained, ws.stage("model_record", trained.record), root)
    flat = jobs.recommend_job(
        _requests(ws), _rec_history(ws), _known_users(ws), ws.dim_product, root, stage=ws.stage_under("published_batch")
    )
    outcome = flat.groupBy("cold_start", F.coalesce("error", F.lit("")).alias("error"), "user_key").agg(F.count("*").alias("n"))
    return outcome.groupBy("cold_start", "error").agg(F.count("*").alias("users"), F.sum("n").alias("rows"))


def _flat_record(ws: Workspace) -> DataFrame:
    return ws.stage("model_record", _trained(ws).record).select(
        "model_name", "n_features", "scale_pos_weight", "metrics_test.*", F.size("importance_top10").alias("top")
    )


def _kpis(ws: Workspace) -> DataFrame:
    record = ws.stage("model_record", _trained(ws).record)
    return train.kpis(record).select(
        "precision_pct", "total_users", "active_features", F.explode("importance_shares").alias("s")
    ).select("precision_pct", "total_users", "active_features", "s.feature", "s.share_of_max")


def _training_job(ws: Workspace) -> DataFrame:
    run = ws.stage_under("training_job")
    return jobs.training_job(ws.fact, ws.dim_product, f"{ws.path}/training", TRAINING, run)


MODELS = {
    "fe_preprocess": _preprocessed,
    "fe_one_hot": _one_hot,
    "kmeans_user_clusters": lambda ws: cluster.clustered(_clustered(ws).clusters[0]),
    "kmeans_product_clusters": lambda ws: cluster.clustered(_clustered(ws).clusters[1]),
    "cluster_assign": _assigned,
    "train_gbt_metrics": lambda ws: _trained(ws).test_metrics,
    "best_threshold": lambda ws: train.best_threshold(_trained(ws).scored("val")),
    "tune_gbt": _tuned,
    "feature_importance": lambda ws: _trained(ws).importance,
    "compare_models": _comparison,
    "model_log": _flat_record,
    "model_kpis": _kpis,
    "rec_model_topk": _model_batch,
    "rec_model_batch": _published_batch,
    "snapshot_job": lambda ws: jobs.snapshot_job(
        ws.fact, ws.dim_product, f"{ws.path}/snapshots", stage=ws.stage_under("snapshot_job")
    ),
    "training_job": _training_job,
}


def registered() -> dict[str, Query]:
    """Every registered query by name."""
    groups = [SOURCES, ETL, INTEGRITY, FEATURES, VALIDATION, DRIFT, MODELLING, RECOMMENDATION, EDA, QUALITY, MODELS]
    return {name: _over_workspace(op) for group in groups for name, op in group.items()}
