"""Token-id files: Parquet list columns for selective reads of tokens or metadata.

Layout. Documents are range-partitioned by id and sorted, so file order is id order. A row holds
``part`` (the writing partition), the id, ``local_start`` (tokens before it in its part),
``n_tokens`` and ``ids`` as ``list<int>``. Ids are dictionary-encoded (16-bit indexes for the
usual vocabularies) under zstd; the sorted integers are delta-encoded. Row groups and pages have
set sizes and page indexes are written, so a reader of a few documents or of the metadata columns
touches only their pages. The global start of a document is its local start plus the total of
the lower parts, a table of one row per part.

Defined results: null and empty texts hold the end id alone; null ids come first; repeated ids
keep all their rows, ordered by the hash of the text and the text; an empty table gives empty files
and results; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from cartlens.llm.common import byte_slices, fields, ship, utf8

BATCH_BYTES = 1 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000


def encode_ordered(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encoded documents in id order: ``part``, id, ``local_start``, ``n_tokens``, ``ids``."""
    ship(docs.sparkSession)
    schema = fields(
        docs,
        [id_col],
        [
            ("part", IntegerType()),
            ("local_start", LongType()),
            ("n_tokens", LongType()),
            ("ids", ArrayType(IntegerType(), False)),
        ],
    )
    end = np.asarray([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm.pieces import encoder

        encode = encoder(tokenizer_path).encode
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for run in byte_slices(batch, text_col, BATCH_BYTES):
                packed = [ids + end for ids in encode(utf8(run, text_col))]
                counts = np.asarray([len(p) // 4 for p in packed], np.int64)
                ends = np.cumsum(counts)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4"))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        run.column(id_col),
                        pa.array(np.full(len(packed), part, np.int32)),
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        ids,
                    ],
                    names=schema.names,
                )
                start += int(ends[-1])

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(id_col, text.alias(text_col)).withColumn("_tie", F.xxhash64(text_col))
    ordered = keyed.repartitionByRange(F.col(id_col).asc_nulls_first(), "_tie").sortWithinPartitions(
        F.col(id_col).asc_nulls_first(), "_tie", text_col
    )
    return ordered.select(id_col, text_col).mapInArrow(encoded, schema)


def write_tokens(encoded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write encoded documents in the file format above."""
    writer = encoded.write.option("compression", "zstd").option("parquet.writer.version", "v2")
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS)
    for column in (id_col, "local_start", "n_tokens"):  # sorted or short: delta packing instead of a dictionary
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path)


def read_tokens(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """Read documents back with their global ``start``; a filter on ids or lengths reaches the page indexes.

    Only the columns asked for are read. The part totals hold one row per written partition, which
    bounds their window and broadcast.
    """
    stored = spark.read.parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = stored if where is None else stored.where(where)
    located = rows.join(F.broadcast(base), "part").withColumn("start", F.col("_base") + F.col("local_start"))
    return located.select(*(columns or [c for c in located.columns if c not in ("_base", "local_start", "part")]))


def digest(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Id, ``start``, ``n_tokens`` and ``ids_crc32`` (unsigned, over little-endian 32-bit ids) of stored rows."""
    ship(tokens.sparkSession)
    schema = fields(tokens, [id_col, "start", "n_tokens"], [("ids_crc32", LongType())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = ids.flatten().to_numpy().astype("<u4", copy=False)
            ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            found = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (id_col, "start", "n_tokens")), pa.array(found, pa.int64())],
                names=schema.names,
            )

    return tokens.select(id_col, "start", "n_tokens", "ids").mapInArrow(sums, schema)
