"""Star schema and feature matrix written once and read by every report.

The pipeline's reports all read a loaded star schema. ``Workspace`` runs the load on first use and
writes each table to the shared folder named by ``spark.checkpoint.dir``; later readers scan
parquet with partition pruning and column pruning instead of re-deriving the tables, and a lost
executor costs no recomputation of the load. Writes have shuffle partitions in proportion to the order lines,
so the memory of a task is bounded whatever the input.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cartlens.functions.spreading import spread
from cartlens.operators import etl, features
from cartlens.sources.adapter import BasketSources, basket_sources
from cartlens.sources.tables import path_exists

AS_OF = "2001-08-01"

_OPEN: dict[tuple[str, str], "Workspace"] = {}
_OPEN_LOCK = threading.Lock()
_LOCAL_ROOTS: dict[str, tempfile.TemporaryDirectory] = {}


def workspace_root(spark: SparkSession) -> str:
    """Shared folder for written tables.

    The cluster's ``spark.checkpoint.dir`` wins. A temporary folder is only used in local mode,
    where every task sees the same disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/cartlens"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        # removed when the process ends
        _LOCAL_ROOTS[app] = tempfile.TemporaryDirectory(prefix="cartlens-", ignore_cleanup_errors=True)
    return _LOCAL_ROOTS[app].name


class Workspace:
    """Written tables of one input folder, built on first use within an application."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        digest = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        self.path = f"{workspace_root(spark)}/{spark.sparkContext.applicationId}/{digest}"
        self._lock = threading.RLock()
        self._tables: dict[str, DataFrame] = {}
        self._sources: dict[bool, BasketSources] = {}

    @classmethod
    def open(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        key = (spark.sparkContext.applicationId, sf_dir)
        with _OPEN_LOCK:  # two workspaces of one path would overwrite each other's tables
            if key not in _OPEN:
                _OPEN[key] = cls(spark, sf_dir)
            return _OPEN[key]

    @cached_property
    def lines(self) -> int:
        """Order lines of the input, read off the files' footers; 0 where it has none."""
        path = f"{self.sf_dir}/lineitem.parquet"
        return self.spark.read.parquet(path).count() if path_exists(self.spark, path) else 0

    def written(self, name: str, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        """Read a table, writing it first when this application has not done so yet."""
        with self._lock:  # concurrent callers must not write one table twice
            if name not in self._tables:
                path = f"{self.path}/{name}"
                writer = build().write.mode("overwrite")
                with spread(self.spark, self.lines):
                    (writer.partitionBy(partition) if partition else writer).parquet(path)
                self._tables[name] = self.spark.read.parquet(path)
            return self._tables[name]

    def stage(self, name: str, frame: DataFrame) -> DataFrame:
        """Write a frame that several branches read, and read it back."""
        return self.written(name, lambda: frame)

    def stage_under(self, run: str) -> Callable[[str, DataFrame], DataFrame]:
        """Stage function whose tables belong to one job and are not shared with reports."""
        return lambda name, frame: self.stage(f"{run}/{name}", frame)

    def written_path(self, name: str, table: Callable[[], DataFrame]) -> str:
        """Folder of a written table, after making sure it is there."""
        table()
        return f"{self.path}/{name}"

    # --- operational tables ---
    def sources(self, folded: bool = True) -> BasketSources:
        """Operational tables; orders, and history once a reader asks for it, are read from their written copies."""
        if folded not in self._sources:
            raw = basket_sources(self.spark, self.sf_dir, folded, self.stage)
            suffix = "" if folded else "_full"
            self._sources[folded] = BasketSources(
                users=raw.users,
                orders=raw.orders,
                products=raw.products,
                load_history=lambda: self.written(f"history{suffix}", lambda: raw.history, "eval_set"),
            )
        return self._sources[folded]

    # --- star schema ---
    @property
    def dim_user(self) -> DataFrame:
        def build() -> DataFrame:
            src = self.sources()
            return etl.build_dim_user(src.users, src.orders, AS_OF)

        return self.written("dim_user", build)

    @property
    def dim_product(self) -> DataFrame:
        def build() -> DataFrame:
            src = self.sources()
            return etl.build_dim_product(src.products, etl.eligible_products(src.prior_items))

        return self.written("dim_product", build)

    @property
    def fact(self) -> DataFrame:
        def build() -> DataFrame:
            return etl.build_fact(self.sources().history, self.dim_user, self.dim_product)

        return self.written("fact", build, "get_eval")

    @property
    def matrix(self) -> DataFrame:
        """Feature matrix in wide types, as the reports compare it."""

        def build() -> DataFrame:
            return features.feature_matrix(
                self.fact, self.dim_product, contract_types=False, stage=self.stage
            )

        return self.written("matrix", build)
