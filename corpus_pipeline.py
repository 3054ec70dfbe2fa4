"""Training corpus from ``documents``: filter, dedup, near-dedup, mix, encode.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and, but for the last,
returns the columns of ``documents``. ``run`` writes each result and reads it for the next stage.

Defined results: null and empty texts have no features, so the classifier's bias decides on them, are one text for both
dedups, and leave in the mix, which takes words; null ids and null sources are ids and sources like others; of
rows of one text the longest original, then the smallest id stays, of rows that agree in id and text any one; an
empty table gives an empty result at every stage; columns besides those of ``documents`` pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlens.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality
from cartlens.llm.common import documents, written
from cartlens.llm.registry import BYTE_RANKS


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row per document and epoch."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of each row."""
    kept = [c for c in docs.columns if c != "text"]
    encoded = byte_bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN, keep=kept)
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte BPE", encode),
]

#: SQL can state neither the trained classifier nor the signatures and draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
