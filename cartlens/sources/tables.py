"""Readers: typed CSV, parquet and table scans with projection, user and range filters."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cartlens.functions.columns import narrow
from cartlens.functions.ordering import seeded_sample
from cartlens.schemas import LOAD_ORDER, SOURCE_SCHEMAS, STAR_SCHEMAS

# Assumed calendar of the order numbers (fixed values).
RANGE_START, RANGE_END = date(2017, 1, 1), date(2017, 12, 31)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system; a file system that fails is an error, not "no"."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV scan with a header; no inference pass, malformed rows fail the read."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; a missing path raises ``FileNotFoundError``."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(path) from error


def load_csv_folder(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Typed frames of the operational files in load order, and the names of missing files."""
    tables, missing = {}, []
    for name, schema in LOAD_ORDER:
        path = f"{folder}/{name}.csv"
        if path_exists(spark, path):
            tables[name] = read_csv(spark, path, SOURCE_SCHEMAS[schema])
        else:
            missing.append(name)
    return tables, missing


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_column: str, lower: int, upper: int, splits: int = 64, **options
) -> DataFrame:
    """Database scan split into ranges of a numeric key, so executors read in parallel."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=split_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=splits,
            **options,
        )
        .load()
    )


def project(table: str, frame: DataFrame) -> DataFrame:
    """Fixed projection and down-cast of a star-schema table."""
    return narrow(frame, STAR_SCHEMAS[table])


def keep_users(tables: dict[str, DataFrame], users: DataFrame) -> dict[str, DataFrame]:
    """Filter every table that has a ``user_key`` to the given users; others stay whole."""
    return {
        name: frame.join(users, "user_key", "left_semi") if "user_key" in frame.columns else frame
        for name, frame in tables.items()
    }


def load_tables(
    tables: dict[str, DataFrame],
    names: Iterable[str],
    n_users: int | None = None,
    seed: int = 42,
    date_range: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Load star tables: projection, optional seeded user sample and optional date range."""
    names = list(names)
    unknown = [n for n in names if n not in STAR_SCHEMAS]
    if unknown:
        raise ValueError(f"unknown tables: {unknown}")
    loaded = {n: project(n, tables[n]) for n in names}
    if n_users is not None:
        loaded = keep_users(loaded, seeded_sample(tables["dim_user"], "user_key", n_users, seed))
    if date_range is not None and "fact_order_products" in loaded:
        loaded["fact_order_products"] = order_range(loaded["fact_order_products"], *date_range)
        if "dim_user" in loaded:
            loaded["dim_user"] = active_users(loaded["dim_user"], loaded["fact_order_products"])
    return loaded


def order_range(fact: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose order number falls in the share of the calendar covered by the dates.

    There is no order date: the range maps linearly onto 0..max(order_number), both ends included.
    """
    span = (RANGE_END - RANGE_START).days
    low = max(0.0, (date.fromisoformat(start) - RANGE_START).days / span)
    high = min(1.0, (date.fromisoformat(end) - RANGE_START).days / span)
    last = fact.agg(F.max("order_number")).scalar()
    return fact.where(
        F.col("order_number").between(
            F.floor(F.lit(low) * last).cast("bigint"), F.floor(F.lit(high) * last).cast("bigint")
        )
    )


def active_users(dim_user: DataFrame, fact: DataFrame) -> DataFrame:
    """Users with at least one row left in the fact."""
    return dim_user.join(fact.select("user_key").distinct(), "user_key", "left_semi")


def sample_sources(
    orders: DataFrame, prior_items: DataFrame, train_items: DataFrame, n_users: int, seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sample users and carry the sample through orders to both item files."""
    users = seeded_sample(orders, "user_id", n_users, seed)
    kept = orders.join(users, "user_id", "left_semi")
    order_ids = kept.select("order_id")
    return (
        kept,
        prior_items.join(order_ids, "order_id", "left_semi"),
        train_items.join(order_ids, "order_id", "left_semi"),
    )
