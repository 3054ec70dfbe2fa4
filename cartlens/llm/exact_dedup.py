"""Exact dedup: tree-merge of sorted digest runs, in DataFrame operations only.

Each input partition is a run of digests. In every round ``FAN_IN`` neighbouring runs merge into
one (binomial rounds with a wider fan-in): rows of a run are grouped by digest, combined
before they are exchanged, and the row to keep, the smallest of (fewest missing code points,
smallest id), is retained with the number of copies. A run is spread over all partitions by
digest, so the last rounds are as parallel as the first, and a text with very many copies is
one row per run from the first round on. The grouping key is the SHA-256 digest verified by the
byte length and an independent 64-bit hash of the normalised text.

The aggregates hold structs, so Spark sorts each run and merges sorted runs.

Defined results: null counts as empty, and all texts without visible characters are equal; a null
id is smaller than any other; of repeated rows with one id exactly one is kept; an empty
table gives an empty result; other columns are ignored, or passed through by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartlens.llm.common import fresh, written

#: Characters that do not count: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
FAN_IN = 8
KEY = ["_sha", "_check", "_bytes"]


def normalised(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of one small row per document: id, code points, digest columns, row and run numbers."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).alias("_id"), F.char_length(text).cast("long").alias("_chars"), normalised(text).alias("_t"))
    return written(
        plain.select(
            "_id",
            "_chars",
            F.unhex(F.sha2("_t", 256)).alias("_sha"),
            F.xxhash64("_t").alias("_check"),
            F.octet_length("_t").alias("_bytes"),
            F.monotonically_increasing_id().alias("_row"),
            F.spark_partition_id().alias("_run"),
        ),
        "digests",
    )


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per digest: the best row (``_best``) and the number of rows (``_copies``)."""
    runs = (rows.agg(F.max("_run")).first()[0] or 0) + 1
    best = F.struct((-F.col("_chars")).alias("less"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    merged = rows.groupBy("_run", *KEY).agg(F.min(best).alias("_best"), F.count("*").alias("_copies"))
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = (
            merged.withColumn("_run", F.floor(F.col("_run") / fan_in).cast("int"))
            .groupBy("_run", *KEY)
            .agg(F.min("_best").alias("_best"), F.sum("_copies").alias("_copies"))
        )
    return merged.drop("_run")


def resolved(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest rows with the best row and group size of their text."""
    rows = digests(docs, id_col, text_col)
    return rows.join(merge_runs(rows), KEY)


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    return resolved(docs, id_col, text_col).select(
        F.col("_id").alias(id_col),
        F.col("_best.id").alias("keep_id"),
        F.col("_copies").alias("group_size"),
        (F.col("_row") == F.col("_best.row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = written(resolved(docs, id_col, text_col).select("_id", "_chars", "_check", "_row", "_best"), "resolved")
    key, chars, check, own_chars, own_check = fresh(docs.columns, "_id", "_chars", "_check", "_c", "_h")
    kept = rows.where(F.col("_row") == F.col("_best.row")).select(
        F.col("_id").alias(key), F.col("_chars").alias(chars), F.col("_check").alias(check)
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumns({own_chars: F.char_length(text).cast("long"), own_check: F.xxhash64(normalised(text))})
    on = F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own_check) == F.col(check)) & (F.col(own_chars) == F.col(chars))
    left = marked.join(kept, on, "left_semi")
    named = rows.select("_id", "_chars", "_check")
    if named.count() > named.distinct().count():
        # the same row more than once: any one of them stays
        left = left.dropDuplicates([id_col, own_check, own_chars])
    return left.drop(own_chars, own_check)
