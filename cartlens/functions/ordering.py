"""Exact order statistics that never sort a whole column in one task.

A global window (``Window.orderBy`` without a partition) moves every row into a single task. The
helpers here split the value range at hash-picked pivots, sort each range in its own task and add
the totals of the lower ranges: a two-level prefix sum. The pivots are the values with the
smallest hashes, so they are the same on every recomputation (a lost executor cannot shift a
range border). Their number follows the shuffle partitions, between ``PIVOTS`` and ``MOST_PIVOTS``, so ranges
keep up with the cluster and broadcasting pivots and range totals stays bounded whatever the data
volume. A value finds its range by binary search. Results do not depend on the pivots, only the balance does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

PIVOTS = 128
MOST_PIVOTS = 4096
#: Ranges for each shuffle partition.
RANGES_EACH = 4


def value_counts(df: DataFrame, keys: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """Count equal non-null values; the map-side combine absorbs frequent values."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias(n))


def _pivots(df: DataFrame, keys: Sequence[str], value: str, pivots: int) -> DataFrame:
    hashed = df.select(*keys, value, F.xxhash64(value).alias("_h"))
    if keys:
        order = Window.partitionBy(*keys).orderBy("_h", value)
        picked = hashed.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= pivots)
    else:
        picked = hashed.orderBy("_h", value).limit(pivots)
    return picked.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("_pivots"))


def default_pivots(df: DataFrame) -> int:
    """Pivots in proportion to the shuffle partitions of the session."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(MOST_PIVOTS, max(PIVOTS, RANGES_EACH * partitions))


def _with_range(df: DataFrame, value: str, pivots: int) -> DataFrame:
    """Add ``_range``, the number of ``_pivots`` (sorted) that are not above the value, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(pivots.bit_length()))])

    def narrowed(low, step):
        return F.when(F.get("_pivots", low + step - 1) <= F.col(value), low + step).otherwise(low)

    return df.withColumn("_range", F.aggregate(steps, F.lit(0), narrowed))


def running_totals(
    df: DataFrame,
    value: str,
    measures: Sequence[str],
    keys: Sequence[str] = (),
    pivots: int | None = None,
) -> DataFrame:
    """Add ``<m>_before`` (sum over strictly smaller values) and ``<m>_total`` per measure.

    ``df`` holds one row per (keys, value); ``value`` may be a struct to order by several columns.
    ``keys`` is a small set (for example monitored feature names): pivots and range totals are
    broadcast, at most ``pivots + 1`` entries per key.
    """
    keys = list(keys)
    pivots = pivots or default_pivots(df)
    split_at = _pivots(df, keys, value, pivots)
    if keys:
        # bounded: one array of at most `pivots` values per key
        ranged = df.join(F.broadcast(split_at), keys, "left")
    else:
        ranged = df.withColumn("_pivots", split_at.select("_pivots").scalar())
    ranged = _with_range(ranged, value, pivots).drop("_pivots")

    # at most `pivots + 1` ranges per key, so these windows and the broadcast stay small
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    lower = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(m).over(lower), F.lit(0)).alias(f"_{m}_offset") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    located = ranged
    for m in measures:
        located = located.withColumn(f"_{m}_inside", F.coalesce(F.sum(m).over(inside), F.lit(0)))
    result = located.join(F.broadcast(offsets), [*keys, "_range"])
    return result.select(
        *df.columns,
        *[(F.col(f"_{m}_offset") + F.col(f"_{m}_inside")).alias(f"{m}_before") for m in measures],
        *[F.col(f"{m}_total") for m in measures],
    )


def percentile_of(position: int, before: Column, n: Column, total: Column, value: Column) -> Column:
    """Aggregate expression: the given percent (0..100) by linear interpolation.

    Works on counted values carrying running totals. The rank is computed in integers, so it is
    exact for any row count.
    """
    scaled = F.lit(position) * (total - 1)
    rank = F.floor(scaled / 100)
    fraction = F.max(scaled % 100) / F.lit(100.0)
    low = F.max(F.when((before <= rank) & (rank < before + n), value)).cast("double")
    high = F.max(
        F.when((before <= F.least(rank + 1, total - 1)) & (F.least(rank + 1, total - 1) < before + n), value)
    ).cast("double")
    return low + (high - low) * fraction


def exact_percentiles(
    df: DataFrame, value: str, percents: Sequence[int], keys: Sequence[str] = (), small_domain: bool = False
) -> DataFrame:
    """Exact percentiles ``p<percent>`` of a column per (small set of) keys.

    ``small_domain`` states that the column has few distinct values whatever the row count, and
    lets one aggregate over the counted values do the work. It holds for small integers such as
    days or cart positions, and for group sizes: ``d`` different sizes need at least
    ``d * (d + 1) / 2`` rows, so a trillion rows give under 1.5 million of them.
    """
    return counted_percentiles(value_counts(df, keys, value), value, percents, keys, small_domain)


def counted_percentiles(
    counted: DataFrame, value: str, percents: Sequence[int], keys: Sequence[str] = (), small_domain: bool = False
) -> DataFrame:
    """:func:`exact_percentiles` over non-null values with their counts ``n``."""
    if small_domain:
        shares = F.array(*[F.lit(p / 100) for p in percents])
        found = counted.groupBy(*keys).agg(F.percentile(value, shares, F.col("n")).alias("_found"))
        return found.select(*keys, *[F.col("_found")[i].alias(f"p{p}") for i, p in enumerate(percents)])
    located = running_totals(counted, value, ["n"], keys)
    return located.groupBy(*keys).agg(
        *[
            percentile_of(p, F.col("n_before"), F.col("n"), F.col("n_total"), F.col(value)).alias(f"p{p}")
            for p in percents
        ]
    )


def seeded_digest(key: str, seed: int) -> Column:
    """Digest that orders keys pseudo-randomly, the same way on every engine and run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def seeded_positions(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Zero-based position of each distinct key in the seeded order, with the number of keys."""
    ordered = df.select(key).distinct().withColumn("_d", F.struct(seeded_digest(key, seed), F.col(key)))
    located = running_totals(ordered.withColumn("n", F.lit(1)), "_d", ["n"])
    return located.select(key, F.col("n_before").alias("position"), F.col("n_total").alias("size"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` distinct keys (all when fewer) chosen by the seeded order."""
    return seeded_positions(df, key, seed).where(F.col("position") < n).select(key)


def seeded_fraction(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """The first ``round(fraction * size)`` keys of the seeded order."""
    return (
        seeded_positions(df, key, seed)
        .where(F.col("position") < F.rint(F.col("size") * F.lit(fraction)))
        .select(key)
    )
