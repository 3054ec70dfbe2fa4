"""Drift between a reference and a current feature matrix: PSI and Kolmogorov-Smirnov."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cartlens.functions.ordering import percentile_of, running_totals
from cartlens.functions.staging import Stage, unstaged
from cartlens.schemas import MONITORED_FEATURES

PSI_LIMIT, KS_LIMIT = 0.25, 0.3
EPSILON = 1e-6
DECILES = range(0, 101, 10)


def counted_values(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per (feature, value) on either side, missing values dropped.

    Both sides are unpivoted and counted together, so the shuffle carries distinct values only.
    """

    def long(frame: DataFrame, side: int) -> DataFrame:
        cast = frame.select(*[F.col(f).cast("double").alias(f) for f in features])
        return cast.unpivot([], list(features), "feature", "value").withColumn("side", F.lit(side))

    both = long(reference, 0).unionByName(long(current, 1))
    return (
        both.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))
    )


def _located(
    reference: DataFrame, current: DataFrame, features: Sequence[str] | None, stage: Stage
) -> DataFrame:
    wanted = MONITORED_FEATURES if features is None else features
    usable = [f for f in wanted if f in reference.columns and f in current.columns]
    if not usable:
        raise ValueError(f"no monitored feature in the data: {list(wanted)}")
    counts = stage("drift_values", counted_values(reference, current, usable))
    located = running_totals(counts, "value", ["n_ref", "n_cur"], ["feature"])
    # a feature without values on one side is skipped
    return located.where((F.col("n_ref_total") > 0) & (F.col("n_cur_total") > 0))


def _summary(located: DataFrame) -> DataFrame:
    """Per feature: the KS distance, the distinct reference deciles and both sizes."""

    def cdf(n: str) -> Column:
        return (F.col(f"{n}_before") + F.col(n)) / F.col(f"{n}_total")

    edges = [
        percentile_of(p, F.col("n_ref_before"), F.col("n_ref"), F.col("n_ref_total"), F.col("value"))
        for p in DECILES
    ]
    return located.groupBy("feature").agg(
        F.max(F.abs(cdf("n_ref") - cdf("n_cur"))).alias("ks"),
        F.array_distinct(F.array(*edges)).alias("edges"),
        F.max("n_ref_total").alias("n_ref_total"),
        F.max("n_cur_total").alias("n_cur_total"),
    )


def _scores(reference: DataFrame, current: DataFrame, features: Sequence[str] | None, stage: Stage) -> DataFrame:
    """(feature, psi, ks), unrounded."""
    located = _located(reference, current, features, stage)
    summary = _summary(located)
    # one row with at most eleven edges per monitored feature
    binned = located.join(F.broadcast(summary.select("feature", "edges")), "feature")
    value, last = F.col("value"), F.element_at("edges", -1)
    bin_of = F.when(value == last, F.size("edges") - 1).when(
        value < last, F.size(F.filter("edges", lambda e: e <= value))
    )
    counts = (
        binned.withColumn("bin", bin_of)
        .groupBy("feature", "bin")
        .agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    )
    bins = summary.withColumn(
        "bin", F.explode_outer(F.when(F.size("edges") > 1, F.sequence(F.lit(1), F.size("edges") - 1)))
    )

    def pct(side: str) -> Column:
        return (F.coalesce(f"n_{side}", F.lit(0)) + EPSILON) / F.col(f"n_{side}_total")

    term = (pct("cur") - pct("ref")) * F.ln(pct("cur") / pct("ref"))
    return (
        bins.join(counts, ["feature", "bin"], "left")
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.size("edges") > 1, term).otherwise(F.lit(0.0))).alias("psi"),
            F.max("ks").alias("ks"),
        )
    )


def psi(
    reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None, stage: Stage = unstaged
) -> DataFrame:
    """Population stability index per feature over the reference deciles.

    Values outside the reference range fall in no bin but stay in the denominator; a feature with
    a single distinct decile scores 0.
    """
    return _scores(reference, current, features, stage).select("feature", "psi")


def ks(
    reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None, stage: Stage = unstaged
) -> DataFrame:
    """Largest distance of the two empirical distribution functions per feature."""
    return _summary(_located(reference, current, features, stage)).select("feature", "ks")


def stability(value: Column) -> Column:
    """Stability class of a PSI value."""
    return F.when(value < 0.10, "stable").when(value < 0.25, "moderate").otherwise("significant")


def drift_by_feature(
    reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None, stage: Stage = unstaged
) -> DataFrame:
    """PSI and KS per feature, four decimals."""
    return _scores(reference, current, features, stage).select(
        "feature", F.round("psi", 4).alias("psi"), F.round("ks", 4).alias("ks")
    )


def drift_report(by_feature: DataFrame) -> DataFrame:
    """Mean PSI and KS, three decimals, and the drift flag."""
    means = by_feature.agg(
        F.round(F.avg("psi"), 3).alias("psi"),
        F.round(F.avg("ks"), 3).alias("ks"),
        F.count("*").alias("features"),
    )
    return means.withColumn("drift_detected", (F.col("psi") > PSI_LIMIT) | (F.col("ks") > KS_LIMIT))
