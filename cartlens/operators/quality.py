"""Data-quality risks of the source data, each with a severity, and their consolidated report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartlens.functions.columns import ratio
from cartlens.functions.ordering import exact_percentiles
from cartlens.operators import eda, integrity

LONG_TAIL = (1, 5, 10, 50, 100)
SPARSE_ORDERS = (3, 5, 10)
POPULARITY_PERCENTS = (50, 75, 90, 95, 99)
POPULARITY_BINS = 19


def class_imbalance(prior_items: DataFrame) -> DataFrame:
    """Ratio of new to reordered items and its severity."""
    counted = prior_items.agg(
        F.count_if(F.col("reordered") == 0).alias("class_0"), F.count_if(F.col("reordered") == 1).alias("class_1")
    )
    total = F.col("class_0") + F.col("class_1")
    imbalance = ratio(F.col("class_0"), F.col("class_1"))
    return counted.select(
        "*",
        F.round(ratio(F.col("class_0"), total), 4).alias("class_0_pct"),
        F.round(ratio(F.col("class_1"), total), 4).alias("class_1_pct"),
        F.round(imbalance, 2).alias("ratio_0_1"),
        F.when(imbalance > 3, "ALTA").when(imbalance > 1.5, "MEDIA").otherwise("BAJA").alias("severity"),
    )


def long_tail(prior_items: DataFrame) -> DataFrame:
    """Products bought at most N times."""
    counts = prior_items.groupBy("product_id").agg(F.count("*").alias("purchases"))
    return eda.threshold_counts(counts, "purchases", LONG_TAIL, True, "products").withColumn(
        "pct", F.round("pct", 2)
    )


def cardinality(products: DataFrame, prior_items: DataFrame) -> DataFrame:
    """Catalogue size, products bought and never bought."""
    bought = prior_items.select("product_id").distinct().agg(F.count("*")).scalar()
    return (
        products.select("product_id")
        .distinct()
        .agg(F.count("*").alias("products"))
        .withColumn("bought", bought)
        .withColumn("never_bought", F.col("products") - F.col("bought"))
    )


def pareto(prior_items: DataFrame, target: float = 80.0) -> DataFrame:
    """Percent of products, best first, that reach ``target`` percent of purchases."""
    ranked = eda.ranked_products(prior_items)
    reached = ratio(F.col("cumulative"), F.col("total")) * 100 >= target
    first = F.min(F.when(reached, F.col("product_rank")))
    return ranked.agg(
        F.count("*").alias("products"),
        first.alias("products_needed"),
        (ratio(first, F.count("*")) * 100).alias("products_pct"),
    )


def user_sparsity(orders: DataFrame) -> DataFrame:
    """Users with fewer than N prior orders, with a severity per threshold."""
    users = eda.prior_orders_per_user(orders)
    counted = users.agg(
        F.count("*").alias("all"), *[F.count_if(F.col("prior_orders") < t).alias(f"t{t}") for t in SPARSE_ORDERS]
    )

    def severity(pct: Column) -> Column:
        return F.when(pct > 0.2, "ALTA").when(pct > 0.1, "MEDIA").otherwise("BAJA")

    shares = {t: ratio(F.col(f"t{t}"), F.col("all")) for t in SPARSE_ORDERS}
    entries = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.col(f"t{t}").alias("users"),
            F.round(pct, 4).alias("share"),
            severity(pct).alias("severity"),
        )
        for t, pct in shares.items()
    ]
    return counted.select(F.inline(F.array(*entries)))


def mean_sparsity(history: DataFrame, products: DataFrame) -> DataFrame:
    """Mean share of the catalogue a user has never bought."""
    per_user = eda.pairs(history).groupBy("user_id").agg(F.count("*").alias("n"))
    catalogue = products.select("product_id").distinct().agg(F.count("*")).scalar()
    return per_user.withColumn("catalogue", catalogue).agg(
        F.avg(F.lit(1.0) - ratio(F.col("n"), F.col("catalogue"))).alias("mean_sparsity")
    )


def popularity_bias(prior_items: DataFrame) -> DataFrame:
    """Percentiles of product popularity, share of the top 1%, correlation with reordering."""
    counts = eda.purchases(prior_items)
    names = [f"p{p}" for p in POPULARITY_PERCENTS]
    marks = exact_percentiles(counts, "purchases", POPULARITY_PERCENTS, small_domain=True).agg(
        F.struct(*[F.max(n).alias(n) for n in names])
    )
    located = counts.withColumn("_marks", marks.scalar())
    top = F.col("purchases") >= F.col("_marks.p99")
    return located.agg(
        *[F.max(f"_marks.{n}").alias(n) for n in names],
        F.count_if(top).alias("top_products"),
        ratio(F.sum(F.when(top, F.col("purchases")).otherwise(0)), F.sum("purchases")).alias("top_share"),
        F.corr("purchases", "reorder_rate").alias("correlation"),
    )


def popularity_bins(prior_items: DataFrame, bins: int = POPULARITY_BINS) -> DataFrame:
    """Mean reorder rate per equal-width bin of log popularity.

    Bins are open on the left, so products at the minimum fall in none.
    """
    counts = eda.purchases(prior_items).withColumn("log_orders", F.log1p("purchases"))
    bounds = counts.agg(F.struct(F.min("log_orders").alias("lo"), F.max("log_orders").alias("hi")))
    position = F.try_divide(
        (F.col("log_orders") - F.col("_b.lo")) * bins, F.col("_b.hi") - F.col("_b.lo")
    )
    placed = counts.withColumn("_b", bounds.scalar()).withColumn(
        "bin", F.least(F.ceil(position), F.lit(bins))
    )
    return (
        placed.where(F.col("bin") > 0)
        .groupBy("bin")
        .agg(F.avg("reorder_rate").alias("reorder_rate"), F.count("*").alias("products"))
    )


def risk_report(
    orders: DataFrame, history: DataFrame, products: DataFrame
) -> DataFrame:
    """Five risks as (risk, metric, severity, action); texts are fixed values of the report."""
    prior = history.where(F.col("eval_set") == "prior")
    balance = class_imbalance(prior).select(F.struct("ratio_0_1", "severity")).scalar()
    catalogue = products.select("product_id").distinct().agg(F.count("*")).scalar()
    sparse = mean_sparsity(prior, products).select("mean_sparsity").scalar()
    top = popularity_bias(prior).select("top_share").scalar()
    leaks = integrity.temporal_leakage(orders).agg(F.sum("violations").alias("leaks"))
    facts = leaks.select(
        "leaks",
        balance.alias("balance"),
        catalogue.alias("catalogue"),
        (sparse * 100).alias("sparse"),
        (top * 100).alias("top"),
    )
    clean = F.col("leaks") == 0

    def row(risk: str, metric: Column, severity: Column, action: Column) -> Column:
        return F.struct(
            F.lit(risk).alias("risk"), metric.alias("metric"), severity.alias("severity"), action.alias("action")
        )

    rows = [
        row(
            "Desbalance de clases",
            F.concat(F.lit("Ratio 0:1 = "), F.col("balance.ratio_0_1").cast("string")),
            F.col("balance.severity"),
            F.lit("class_weight / scale_pos_weight en el modelo"),
        ),
        row(
            "Alta cardinalidad",
            F.concat(F.format_number("catalogue", 0), F.lit(" productos")),
            F.lit("ALTA"),
            F.lit("Filtrar productos con < 50 apariciones para el MVP"),
        ),
        row(
            "Sparsity de usuarios",
            F.concat(F.lit("Sparsity media = "), F.format_string("%.4f%%", F.col("sparse"))),
            F.lit("ALTA"),
            F.lit("Filtrar usuarios con < 5 órdenes / popularidad como fallback"),
        ),
        row(
            "Data leakage temporal",
            F.concat(F.lit("Resultado: "), F.when(clean, "OK").otherwise("PROBLEMA DETECTADO")),
            F.when(clean, "OK").otherwise("CRÍTICO"),
            F.when(clean, "Estructura prior/train/test respetada ✅").otherwise("Revisar split temporal"),
        ),
        row(
            "Sesgo hacia productos populares",
            F.concat(F.lit("Top 1% = "), F.format_string("%.1f%%", F.col("top")), F.lit(" compras")),
            F.lit("MEDIA"),
            F.lit("Incluir features de popularidad relativa al usuario"),
        ),
    ]
    return facts.select(F.inline(F.array(*rows)))
