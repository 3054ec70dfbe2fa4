"""Helpers the operators share: code shipping, Arrow batches, scratch tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from cartlens.plans.workspace import workspace_root

_SHIPPED: set[str] = set()
_LOCK = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so their workers can import it."""
    with _LOCK:
        app = spark.sparkContext.applicationId
        if app in _SHIPPED:
            return
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root = os.path.dirname(package)
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cartlens-ship-")), "cartlens_src.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, root))
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """Path of a new table in the shared folder; recomputation never sees another run's table."""
    return f"{workspace_root(spark)}/{spark.sparkContext.applicationId}/llm/{uuid.uuid4().hex[:12]}/{name}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and fixes the rows."""
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Delete the scratch tables of this application (results that still read them become invalid)."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(f"{workspace_root(spark)}/{context.applicationId}/llm")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fields(frame: DataFrame, keep: Sequence[str], added: Sequence[tuple[str, DataType]]) -> StructType:
    """Schema of a Python stage: some input columns, then new ones."""
    return StructType(
        [StructField(c, frame.schema[c].dataType) for c in keep] + [StructField(n, t) for n, t in added]
    )


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows with about ``limit`` bytes of text each.

    A row is never cut, so a longer text is a run of its own.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts as str; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def fresh(columns: Sequence[str], *names: str) -> list[str]:
    """Names that no column has, for helper columns beside those of a caller."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


class Powers:
    """Powers 0 to n of an odd base and of its inverse, modulo 2^64.

    A worker keeps up to ``KEPT`` of them; a longer text makes its own for the time it needs them.
    """

    KEPT = 1 << 21

    def __init__(self, base: int):
        self.bases = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        tables = self.tables
        if len(tables[0]) <= n:
            size, tables = 1 << max(12, n.bit_length()), []
            for base in self.bases:
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                tables.append(np.multiply.accumulate(factors))
            if size <= self.KEPT:
                self.tables = tables
        return tables[0], tables[1]
