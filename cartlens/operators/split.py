"""User-wise split, entity profiles and their standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cartlens.functions.columns import ratio
from cartlens.functions.ordering import exact_percentiles, seeded_digest, seeded_positions


def split_users(matrix: DataFrame, seed: int = 42) -> DataFrame:
    """Assign every user to train, val or test (70/15/15); all pairs of a user stay together.

    Sizes follow two successive ceil splits: 30% held out, half of it test.
    """
    placed = seeded_positions(matrix, "user_key", seed)
    held_out = F.floor((F.col("size") * 3 + 9) / 10)
    test = F.floor((held_out + 1) / 2)
    return placed.select(
        "user_key",
        F.when(F.col("position") < F.col("size") - held_out, "train")
        .when(F.col("position") < F.col("size") - test, "val")
        .otherwise("test")
        .alias("split"),
    )


def with_split(matrix: DataFrame, users: DataFrame, seed: int = 42) -> DataFrame:
    """Matrix rows with the split of their user.

    Splits are ranges of the users' seeded digests, so two borders place every row: no join, and a
    user with very many rows stays where they are read. ``seed`` is the one ``users`` was split with.
    """
    place = F.struct(seeded_digest("user_key", seed).alias("digest"), F.col("user_key").alias("user_key"))
    low = users.agg(
        F.min(F.when(F.col("split") == "val", place)).alias("val"), F.min(F.when(F.col("split") == "test", place)).alias("test")
    )
    val, test = low.select("val").scalar(), low.select("test").scalar()
    named = (
        F.when(place >= test, "test").when(place >= val, "val").otherwise("train")  # a missing border compares as null
    )
    return matrix.withColumn("split", named)


def split_sizes(matrix: DataFrame, users: DataFrame, seed: int = 42) -> DataFrame:
    """Actual users and pairs per split."""
    per_user = with_split(matrix, users, seed).groupBy("split", "user_key").agg(F.count("*").alias("n"))
    return per_user.groupBy("split").agg(F.count("*").alias("users"), F.sum("n").alias("pairs"))


def profiles(train: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Mean of the clustering features per user or product."""
    return train.groupBy(key).agg(*[F.avg(f).alias(f) for f in features])


def profile_stats(profile: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature: mean and population deviation after filling gaps with the median, and that
    median.

    The fill does not need a second pass: the filled moments follow from counts, sums and the
    median.
    """
    long = profile.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [], list(features), "feature", "value"
    )
    medians = exact_percentiles(long, "value", [50], ["feature"])
    # one row per clustering feature
    filled = long.join(F.broadcast(medians), "feature", "left").withColumn(
        "value", F.coalesce("value", "p50")
    )
    return filled.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("deviation"), F.max("p50").alias("median")
    )


def scaled_profiles(profile: DataFrame, key: str, features: Sequence[str], stats: DataFrame) -> DataFrame:
    """Profiles with gaps filled by the median and standardised by population deviation.

    A constant feature keeps its centred value, as a zero deviation scales by one.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "deviation", "median"))))
    lookup = stats.agg(entries).scalar()
    located = profile.withColumn("_stats", lookup)

    def scaled(feature: str):
        stat = F.col("_stats")[feature]
        value = F.coalesce(F.col(feature).cast("double"), stat["median"])
        spread = F.when(stat["deviation"] == 0, F.lit(1.0)).otherwise(stat["deviation"])
        return ((value - stat["mean"]) / spread).alias(feature)

    return located.select(key, *[scaled(f) for f in features])


def class_weight(matrix: DataFrame) -> DataFrame:
    """Weight of the positive class: negatives over positives."""
    positives, negatives = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    return matrix.agg(ratio(negatives, F.greatest(positives, F.lit(1))).alias("scale_pos_weight"))
