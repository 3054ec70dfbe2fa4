"""Classification and ranking metrics over any (user_key, product_key, label, score) frame."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartlens.functions.columns import ratio
from cartlens.functions.ordering import running_totals

TOP_K = 10


def confusion(scored: DataFrame, predicted: Column) -> DataFrame:
    """Confusion counts with precision, recall and F1 (0 on a zero denominator)."""
    actual = F.col("label") == 1
    counts = scored.agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "*",
        F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), F.lit(0.0)).alias("recall"),
        F.coalesce(ratio(tp * 2, tp * 2 + fp + fn), F.lit(0.0)).alias("f1"),
    )


def auc(scored: DataFrame, score: str = "score") -> DataFrame:
    """Area under the ROC curve as the Mann-Whitney statistic, ties counted half.

    Equal scores are grouped first; ranks come from the distributed running totals.
    """
    groups = scored.groupBy(score).agg(
        F.count("*").alias("n"), F.sum(F.col("label").cast("bigint")).alias("pos")
    )
    located = running_totals(groups, score, ["n", "pos"])
    negatives_before = F.col("n_before") - F.col("pos_before")
    wins = F.sum(F.col("pos") * (negatives_before + (F.col("n") - F.col("pos")) / 2))
    pairs = F.max(F.col("pos_total").cast("double") * (F.col("n_total") - F.col("pos_total")))
    return located.agg(F.try_divide(wins, pairs).alias("auc"))


def evaluate(scored: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """One-row metrics at a threshold, with AUC."""
    return confusion(scored, F.col(score) >= threshold).withColumn("auc", auc(scored, score).scalar())


def top_k_per_user(scored: DataFrame, k: int = TOP_K, score: str = "score") -> DataFrame:
    """Best ``k`` products per user; the rank filter prunes map-side before the shuffle."""
    best = Window.partitionBy("user_key").orderBy(F.desc(score), "product_key")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def popularity_baseline(train: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top ``k`` products by mean total purchases over the train rows."""
    means = train.groupBy("product_key").agg(F.avg("product_total_purchases").alias("popularity"))
    return means.orderBy(F.desc("popularity"), "product_key").limit(k)


def flag_members(scored: DataFrame, products: DataFrame) -> DataFrame:
    """Add ``recommended``: whether the product is in the list (at most ``k`` keys)."""
    keys = products.agg(F.collect_set("product_key")).scalar()
    return scored.withColumn("_keys", keys).withColumn(
        "recommended", F.array_contains("_keys", F.col("product_key"))
    ).drop("_keys")


def baseline_metrics(test: DataFrame, products: DataFrame) -> DataFrame:
    """Metrics of predicting a purchase for every popular product."""
    return confusion(flag_members(test, products), F.col("recommended"))


def uplift(scored: DataFrame, baseline: DataFrame, k: int = TOP_K, score: str = "score") -> DataFrame:
    """Mean hits per user of the model and of the popularity list, and the gain.

    The model averages over all users with recommendations, the baseline over users with a
    purchase; ``baseline_hits_all_users`` puts the baseline on the model's denominator.
    """
    hits = (
        top_k_per_user(scored, k, score).groupBy("user_key").agg(F.sum(F.col("label").cast("bigint")).alias("hits"))
    )
    model = hits.agg(F.avg("hits").alias("model_hits"), F.count("*").alias("users"))
    bought = flag_members(scored.where(F.col("label") == 1), baseline)
    base = bought.groupBy("user_key").agg(F.count_if(F.col("recommended")).alias("hits"))
    base = base.agg(F.struct(F.avg("hits").alias("mean"), F.sum("hits").alias("sum"))).scalar()
    joined = model.withColumn("_base", base).select(
        "model_hits",
        F.coalesce(F.col("_base")["mean"], F.lit(0.0)).alias("baseline_hits"),
        ratio(F.coalesce(F.col("_base")["sum"], F.lit(0)), F.col("users")).alias("baseline_hits_all_users"),
    )
    gain = F.col("model_hits") - F.col("baseline_hits")
    return joined.withColumns(
        {
            "uplift": gain,
            "uplift_pct": F.coalesce(F.try_divide(gain * 100, F.col("baseline_hits")), F.lit(0.0)),
        }
    )


def _discounts(k: int) -> Column:
    """Cumulative rank discounts D(0..k), D(i) = sum of 1/log2(r+1) for r <= i."""
    totals = [0.0]
    for rank in range(1, k + 1):
        totals.append(totals[-1] + 1.0 / math.log2(rank + 1))
    return F.array(*[F.lit(t) for t in totals])


def ndcg_per_user(scored: DataFrame, k: int = TOP_K, score: str = "score") -> DataFrame:
    """NDCG at ``k`` per user with at least two rows; tied scores share their average discount.

    Rows are grouped to (user, score) first. Only the ``k`` best distinct scores of a user can
    reach rank ``k``, so the window over them is bounded however many rows a user has.
    """
    gained = F.sum(F.col("label").cast("bigint"))
    groups = scored.groupBy("user_key", score).agg(F.count("*").alias("n"), gained.alias("gain"))
    best = Window.partitionBy("user_key").orderBy(F.desc(score))
    top = groups.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k)
    earlier = best.rowsBetween(Window.unboundedPreceding, -1)
    top = top.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    discounts = _discounts(k)

    def discount_to(rank: Column) -> Column:
        return F.element_at(discounts, (F.least(rank, F.lit(k)) + 1).cast("int"))

    shared = (discount_to(F.col("_before") + F.col("n")) - discount_to(F.col("_before"))) / F.col("n")
    dcg = top.groupBy("user_key").agg(F.sum(F.col("gain") * shared).alias("dcg"))
    ideal = groups.groupBy("user_key").agg(F.sum("n").alias("rows"), F.sum("gain").alias("positives"))
    return (
        ideal.where(F.col("rows") >= 2)
        .join(dcg, "user_key")
        .select(
            "user_key",
            F.coalesce(F.try_divide(F.col("dcg"), discount_to(F.col("positives"))), F.lit(0.0)).alias("ndcg"),
        )
    )


def ndcg(scored: DataFrame, k: int = TOP_K, score: str = "score") -> DataFrame:
    """Mean NDCG at ``k`` over users."""
    return ndcg_per_user(scored, k, score).agg(F.avg("ndcg").alias("ndcg"), F.count("*").alias("users"))


def compare_models(rows: DataFrame) -> DataFrame:
    """Metric rows with a flag on the best F1 (the first name wins a tie)."""
    best = rows.orderBy(F.desc("f1"), "model").limit(1).select("model").scalar()
    return rows.withColumn("best", F.col("model") == best)
