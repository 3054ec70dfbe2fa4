"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over seven bytes of the UTF-8 text; where it hits a block size's trigger value a chunk
ends, and each chunk's hash gives one character of a signature. Block sizes are 3 * 2^i and the
triggers of a block size are among those of the half size, so one pass finds all of them. The block
size follows the length (``CHUNKS`` chunks or fewer are expected); it is halved while there are
under ``FEWEST`` chunks and doubled while there are over ``MOST``, so signatures are short without
being cut. A fingerprint holds the signatures of that block size and of twice it:
``block:signature:signature``.

Two fingerprints are compared at block sizes they share: the likeness is one minus the
edit distance of the signatures by the longer length, the best of the shared sizes, and 0 where
they share no run of ``COMMON`` characters (less for short signatures) or no block size.

Defined results: null and empty texts have the fingerprint ``3::`` and are alike 1 among
themselves and 0 to others; repeated ids are ordered by the hash of the text and the text; null
ids come last; of a single document the next is itself; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from cartlens.llm.common import byte_slices, fields, ship, strings, utf8, written

BATCH_BYTES = 1 << 20
CHUNKS, FEWEST, MOST = 64, 16, 256
COMMON = 4
SMALLEST_BLOCK = 3
WINDOW = 7
#: The 64 signature characters.
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL = [np.uint32(pow(0x9E3779B1, k, 1 << 32)) for k in range(WINDOW)]
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the chunk hash's base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        size = 1 << max(12, n.bit_length())
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.multiply.accumulate(factors)
    return _POWERS[0], _POWERS[1]


def _signature(prefix: np.ndarray, ends: np.ndarray) -> str:
    """One character for each chunk between successive ends."""
    starts = np.concatenate([[0], ends[:-1]])
    chunk = (prefix[ends] - prefix[starts]) * _powers(len(prefix))[1][starts]
    chunk = (chunk ^ (chunk >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ALPHABET[(chunk >> np.uint64(58)).astype(np.int64)].tobytes().decode("ascii")


def fingerprint(text: bytes) -> str:
    """Fingerprint of a UTF-8 text of any length."""
    n = len(text)
    if not n:
        return f"{SMALLEST_BLOCK}::"
    with np.errstate(over="ignore"):
        data = np.frombuffer(text, np.uint8)
        spread = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
        roll = spread.copy()
        for k in range(1, min(WINDOW, n)):
            roll[k:] += spread[:-k] * _ROLL[k]
        roll ^= roll >> np.uint32(15)
        hit = np.flatnonzero(roll % np.uint32(SMALLEST_BLOCK) == SMALLEST_BLOCK - 1)
        over = (roll[hit].astype(np.int64) + 1) // SMALLEST_BLOCK
        level = np.log2(over & -over).astype(np.int64)  # a power of two: exact
        powers = _powers(n)[0]
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * powers[:n], out=prefix[1:])
        # chunks at level i: triggers of that level or more, and the rest of the text if any
        at_least = np.cumsum(np.bincount(level, minlength=36)[::-1])[::-1]
        i = max(0, (-(-n // (CHUNKS * SMALLEST_BLOCK)) - 1).bit_length())
        while i and at_least[i] < FEWEST:
            i -= 1
        while at_least[i] >= MOST:
            i += 1

        def signed(level_: int) -> str:
            ends = hit[level >= level_] + 1
            return _signature(prefix, ends if len(ends) and ends[-1] == n else np.append(ends, n))

        return f"{SMALLEST_BLOCK << i}:{signed(i)}:{signed(i + 1)}"


def distance(a: str, b: str) -> int:
    """Edit distance, a column of the table per step as bits of one integer."""
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        match = at.get(c, 0)
        diagonal = ((match & up) + up ^ up) | match | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        if right_up & last:
            score += 1
        elif right_down & last:
            score -= 1
        right_up = (right_up << 1 | 1) & full
        up = (right_down << 1) & full | ~(diagonal | right_up) & full
        down = right_up & diagonal
    return score


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    run = min(COMMON, max(1, min(len(a), len(b)) // COMMON))
    shared = {a[i : i + run] for i in range(len(a) - run + 1)}
    if shared.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 1.0 - distance(a, b) / max(len(a), len(b))


def likeness(one: str, two: str) -> float:
    """Likeness 0 to 1 of two fingerprints at the block sizes they share."""
    if one == two:
        return 1.0
    block_a, a, a2 = one.split(":")
    block_b, b, b2 = two.split(":")
    if block_a == block_b:
        return max(_alike(a, b), _alike(a2, b2))
    if int(block_a) == 2 * int(block_b):
        return _alike(a, b2)
    if int(block_b) == 2 * int(block_a):
        return _alike(a2, b)
    return 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``fingerprint``; no shuffle."""
    ship(docs.sparkSession)
    schema = fields(docs, [id_col], [("fingerprint", StringType())])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in byte_slices(batch, text_col, BATCH_BYTES):
                found = [fingerprint(t) for t in utf8(run, text_col)]
                yield pa.RecordBatch.from_arrays([run.column(id_col), pa.array(found, pa.string())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(marked, schema)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(text: str, own: str, following: str, next_mark: str) -> tuple[str, str, float, float]:
    """Digest and fingerprint of the edited text, likeness to it and to the next document."""
    changed = edited(text, following).encode("utf-8")
    mark = fingerprint(changed)
    return hashlib.sha256(changed).hexdigest(), mark, likeness(own, mark), likeness(own, next_mark)


RESULT = [
    ("n_chars", LongType()),
    ("edited_sha256", StringType()),
    ("fingerprint", StringType()),
    ("edited_fingerprint", StringType()),
    ("near_edited", DoubleType()),
    ("near_next", DoubleType()),
]


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its edited text and its next document, by descending id.

    Rows are range-partitioned and sorted, and each partition is streamed with its neighbour at
    hand. Only the first and last text of a partition leave it: the last document of a
    partition is completed by a join with the first one of the next partition.
    """
    ship(docs.sparkSession)
    body = fields(docs, [id_col], [*RESULT, ("_part", IntegerType()), ("_first", StringType()), ("_last", StringType())])
    names = body.names

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, None
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(id_col).type
            for run in byte_slices(batch, text_col, BATCH_BYTES):
                rows = []
                for key, text in zip(run.column(id_col).to_pylist(), strings(run, text_col)):
                    mark = fingerprint(text.encode("utf-8"))
                    if held is None:
                        first = text
                    else:
                        rows.append(complete(held, text, mark, part))
                    held = (key, text, mark)
                if rows:
                    yield table(rows, id_type)
        if held is not None:
            key, text, mark = held
            yield table([(key, len(text), None, mark, None, None, None, part, first, text)], id_type)

    def complete(held: tuple, following: str, next_mark: str, part: int) -> tuple:
        key, text, mark = held
        digest, changed, near_edited, near_next = compared(text, mark, following, next_mark)
        return (key, len(text), digest, mark, changed, near_edited, near_next, part, None, None)

    def table(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field(id_col).type
            rows = [
                complete((r[id_col], r["_last"], r["fingerprint"]), r["_next"], fingerprint(r["_next"].encode("utf-8")), r["_part"])
                for r in batch.to_pylist()
            ]
            if rows:
                yield table(rows, id_type)

    order = [F.col(id_col).desc_nulls_last(), F.col("_tie")]
    keyed = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col)).withColumn("_tie", F.xxhash64(text_col))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order, text_col).select(id_col, text_col)
    rows = written(ordered.mapInArrow(streamed, body), "neighbours")

    open_ = rows.where(F.col("_last").isNotNull())
    # a number per partition that has rows: the window holds no texts
    every = Window.orderBy("_part")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = open_.select(
        F.col("_part"), F.coalesce(F.lead("_part").over(every), F.first("_part").over(whole)).alias("_after")
    )
    heads = open_.select(F.col("_part").alias("_after"), F.col("_first").alias("_next"))
    pairs = open_.select(id_col, "fingerprint", "_part", "_last").join(follows, "_part").join(heads, "_after")
    tails = pairs.select(id_col, "fingerprint", "_part", "_last", "_next").mapInArrow(closed, body)
    columns = [id_col, *(name for name, _ in RESULT)]
    return rows.where(F.col("_last").isNull()).select(*columns).unionByName(tails.select(*columns))
