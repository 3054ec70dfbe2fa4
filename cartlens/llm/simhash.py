"""SimHash near-dedup by multi-index hashing.

A text's fingerprint has a bit set where more than half of its shingle hashes do. Two fingerprints
within three bits differ in at most one bit of their lower or of their upper half. Both halves are
indexed: the table holds every fingerprint under the value of each half, and every fingerprint
looks up the Hamming ball of radius one around its own half. A ball is enumerated by setting one
clear bit, as of two halves that differ in one bit exactly one has it clear, so each pair
is found from one side. Matches are verified by the distance of the whole fingerprints.

Equal fingerprints are one vertex from the start. A table key with more than ``MATCHES``
fingerprints is not paired: its fingerprints share a half, and with the distance left for the other
half they meet in the middle. Every fingerprint of the key enters the points within one bit of its free
half as a core and those at two bits as a guest, a fingerprint that looked the key up through a set bit the points
within one bit as a guest. A point with a core links all its fingerprints to its smallest core, three bits away
at most, and every link of the key has such a point. A point has at most 529 fingerprints of the key and 1,056 guests, so rows
grow in proportion to fingerprints however dense a group of near copies is. Components of the links are
those that all pairs would give.

Defined results: null texts count as empty; texts without words have fingerprint zero, linked like any
other; one or two words are one shingle; repeated rows each return a row; null ids come after others
and stay null only in components without any other; empty tables give empty results; other columns are ignored. Texts are read in
windows of ``WINDOW`` bytes cut at white space, so memory does not follow their number of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from cartlens.llm.common import byte_slices, fields, ship, utf8, written
from cartlens.llm.near_dedup import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BATCH_BYTES = 1 << 20
WINDOW = 1 << 18
#: Fingerprints of a table key that are paired one by one; beyond them the key's fingerprints meet in the middle.
MATCHES = 256
_HALF = 32
_LOW = (1 << _HALF) - 1
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def words_by_window(data: bytes, window: int = WINDOW) -> Iterator[list[bytes]]:
    """The words of a text with A-Z in lower case, in runs of about ``window`` bytes."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > window and (found := _BLANK.search(data, at + window)):
            end = found.start()
        yield data[at:end].lower().split()
        at = end


def fingerprint(data: bytes, window: int = WINDOW) -> int:
    """64-bit fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest as xxh64

    set_bits, total, tail = np.zeros(64, np.int64), 0, []
    for words in words_by_window(data, window):
        words = tail + words
        hashes = [xxh64(b" ".join(s), SEED) for s in zip(words, words[1:], words[2:])]
        tail = words[-(SHINGLE - 1) :]
        if hashes:
            set_bits += _set_bits(hashes)
            total += len(hashes)
    if not total:
        if not tail:
            return 0
        set_bits, total = _set_bits([xxh64(b" ".join(tail), SEED)]), 1
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def _set_bits(hashes: list[int]) -> np.ndarray:
    octets = np.asarray(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table with ``_id`` and ``_f``, the fingerprint as a signed long, per document."""
    ship(docs.sparkSession)
    small = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    schema = fields(small, ["_id"], [("_f", LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in byte_slices(batch, "_text", BATCH_BYTES):
                found = np.asarray([fingerprint(data) for data in utf8(run, "_text")], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([run.column("_id"), pa.array(found)], names=schema.names)

    return written(small.mapInArrow(hashed, schema), "fingerprints")


def _masks(*bits: int) -> list[int]:
    """Masks of a half with 0, 1 or 2 bits set, as asked for."""
    one = [1 << i for i in range(_HALF)]
    by_number = {0: [0], 1: one, 2: [a | b for i, a in enumerate(one) for b in one[:i]]}
    return [m for n in bits for m in by_number[n]]


def _exploded(masks: list[int]) -> Column:
    return F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))


def links(distinct: DataFrame, matches: int = MATCHES) -> DataFrame:
    """Pairs ``_a``, ``_b`` of distinct fingerprints (``_f``) whose components are those of all pairs within the distance."""
    low = F.col("_f").bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned("_f", _HALF)
    table = distinct.select("_f", F.explode(F.array(low, high + F.lit(1 << _HALF))).alias("_key"))
    ball = table.select("_f", "_key", _exploded(_masks(0, 1)).alias("_mask")).where(F.col("_key").bitwiseAND(F.col("_mask")) == 0)
    probes = ball.select("_f", F.col("_key").bitwiseOR(F.col("_mask")).alias("_key"), (F.col("_mask") == 0).alias("_own"))
    crowded = written(table.groupBy("_key").agg(F.count("*").alias("_size")).where(F.col("_size") > matches).select("_key"), "crowded")
    some = not crowded.isEmpty()
    paired = table.join(crowded, "_key", "left_anti") if some else table
    near = F.bit_count(F.col("_f").bitwiseXOR(F.col("_g"))) <= DISTANCE
    once = ~F.col("_own") | (F.col("_f") < F.col("_g"))
    # merged by hint: the optimiser takes the 33 probes of a fingerprint for one row and would broadcast them from the driver
    matched = probes.join(paired.select("_key", F.col("_f").alias("_g")).hint("merge"), "_key").where(once & near)
    found = matched.select(F.col("_f").alias("_a"), F.col("_g").alias("_b"))
    return found.unionByName(_met(table, probes, crowded)) if some else found


def _met(table: DataFrame, probes: DataFrame, crowded: DataFrame) -> DataFrame:
    """Links inside crowded keys by the points that fingerprints share (see the module's text)."""
    free = F.when(F.col("_key") > _LOW, F.col("_f").bitwiseAND(F.lit(_LOW))).otherwise(F.shiftrightunsigned("_f", _HALF))
    kept = table.join(crowded, "_key", "left_semi")
    guests = probes.where(~F.col("_own")).join(crowded, "_key", "left_semi")

    def points(frame: DataFrame, masks: list[int], core: bool) -> DataFrame:
        near = frame.select("_key", "_f", free.alias("_free"), _exploded(masks).alias("_mask"))
        return near.select("_key", "_f", F.col("_free").bitwiseXOR(F.col("_mask")).alias("_point"), F.lit(core).alias("_core"))

    every = points(kept, _masks(0, 1), True).unionByName(points(kept, _masks(2), False)).unionByName(points(guests, _masks(0, 1), False))
    met = every.groupBy("_key", "_point").agg(F.min(F.when(F.col("_core"), F.col("_f"))).alias("_a"), F.collect_set("_f").alias("_all"))
    star = met.where(F.col("_a").isNotNull() & (F.size("_all") > 1)).select("_a", F.explode("_all").alias("_b"))
    near = F.bit_count(F.col("_a").bitwiseXOR(F.col("_b"))) <= DISTANCE
    return star.where((F.col("_a") != F.col("_b")) & near).distinct()


def link_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", matches: int = MATCHES) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``, the smallest id it is linked to."""
    rows = fingerprints(docs, id_col, text_col)
    distinct = written(rows.groupBy("_f").agg(F.min("_id").alias("_first")), "distinct_fingerprints")
    labels = components(links(distinct.select("_f"), matches))
    labelled = distinct.join(labels.toDF("_f", "_c"), "_f", "left").withColumn("_c", F.coalesce("_c", "_f"))
    least = labelled.groupBy("_c").agg(F.min("_first").alias("_least"))
    # written, so that adaptive execution can split a hot fingerprint in the join
    named = written(labelled.join(least, "_c").select("_f", "_least"), "named_fingerprints")
    return rows.join(named, "_f").select(
        F.col("_id").alias(id_col),
        F.lpad(F.lower(F.hex("_f")), 16, "0").alias("fingerprint"),
        F.col("_least").alias("component_id"),
    )
