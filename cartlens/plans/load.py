"""Load of the star schema as one job that can be resumed and repeated.

A load writes every table to a folder of its own run and moves it into place when complete, so a table that is there is whole.
``<root>/current`` names the run whose tables are the star schema; it moves once, after the last table has passed
the constraints, so readers see the old star or the new one. A load that was stopped goes on after the last
complete table; a run that is current already is skipped.

New rows are added to those of the current run and never replace them (insert-ignore by primary key; of several
new rows of a key the smallest counts). Then users without a name are filled in from a list.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlens.operators import constraints, etl
from cartlens.schemas import STAR_KEYS
from cartlens.sources import sinks, tables

REPORT = sinks.REPORT_SCHEMA


@dataclass(frozen=True)
class Incoming:
    """What a load brings: operational tables, and descriptive rows of users to fill in."""

    users: DataFrame
    products: DataFrame
    orders: DataFrame
    prior_items: DataFrame
    train_items: DataFrame
    as_of: str
    details: DataFrame | None = None


def current_run(spark: SparkSession, root: str) -> str | None:
    """Run whose tables are the star schema."""
    path = f"{root}/current"
    return spark.read.json(path).first()["run"] if tables.path_exists(spark, path) else None


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star tables of the current run; without one ``FileNotFoundError``."""
    run = current_run(spark, root)
    if run is None:
        raise FileNotFoundError(f"{root}/current")
    return {name: spark.read.parquet(f"{root}/runs/{run}/{name}") for name in STAR_KEYS}


def _with_new(old: DataFrame | None, incoming: DataFrame, keys: list[str]) -> DataFrame:
    if old is None:
        return etl.first_of_each(incoming, keys)
    return old.unionByName(etl.insert_ignore(old, incoming, keys))


def _steps(spark: SparkSession, root: str, run: str, new: Incoming, old: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    def loaded(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/runs/{run}/{name}")

    def dim_user() -> DataFrame:
        rows = _with_new(old.get("dim_user"), etl.build_dim_user(new.users, new.orders, new.as_of), STAR_KEYS["dim_user"])
        return rows if new.details is None else etl.backfill_dim_user(rows, new.details)

    def dim_product() -> DataFrame:
        rows = etl.build_dim_product(new.products, etl.eligible_products(new.prior_items))
        return _with_new(old.get("dim_product"), rows, STAR_KEYS["dim_product"])

    def fact() -> DataFrame:
        history = etl.consolidate(etl.union_items(new.prior_items, new.train_items), new.orders)
        rows = etl.build_fact(history, loaded("dim_user"), loaded("dim_product"))
        return _with_new(old.get("fact_order_products"), rows, STAR_KEYS["fact_order_products"])

    return {"dim_user": dim_user, "dim_product": dim_product, "fact_order_products": fact}


def etl_job(spark: SparkSession, root: str, run: str, new: Incoming) -> DataFrame:
    """Load under the run's name; report of table, state (completed, resumed, skipped, failed, pending), rows, seconds, error."""
    before = current_run(spark, root)
    if before == run:
        rows = [(name, "skipped", frame.count(), 0.0, None) for name, frame in read_star(spark, root).items()]
        return spark.createDataFrame(rows, REPORT)
    old = read_star(spark, root) if before else {}
    rows, failed = [], False
    for name, build in _steps(spark, root, run, new, old).items():
        path = f"{root}/runs/{run}/{name}"
        started = time.monotonic()
        if failed:
            rows.append((name, "pending", 0, 0.0, None))
        elif tables.path_exists(spark, path):
            rows.append((name, "resumed", spark.read.parquet(path).count(), time.monotonic() - started, None))
        else:
            try:
                fresh = f"{path}.{uuid.uuid4().hex}"
                build().write.parquet(fresh)
                sinks.replace_folder(spark, fresh, path)
                rows.append((name, "completed", spark.read.parquet(path).count(), time.monotonic() - started, None))
            except Exception as error:  # reported; later steps depend on this one
                failed = True
                rows.append((name, "failed", 0, time.monotonic() - started, str(error)))
    report = spark.createDataFrame(rows, REPORT)
    sinks.write_json(report, f"{root}/runs/{run}/report")
    if not failed:
        constraints.enforce({name: spark.read.parquet(f"{root}/runs/{run}/{name}") for name in STAR_KEYS})
        sinks.write_json(spark.createDataFrame([(run,)], "run string"), f"{root}/current")
    return report


def counts(report: DataFrame) -> DataFrame:
    """Rows of each table of a load."""
    return report.select("table", F.col("rows").cast("bigint").alias("rows"))
