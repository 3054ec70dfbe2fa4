"""Mixing sources to target weights with fixed-length blocks.

The words of a source, in document order, are packed into blocks of ``BLOCK`` words. A source's
target words become a whole number of slots, at most three per block. The slots of every source
are spread over the output shards multinomially: counts are halved down a binary tree of shards
with binomial draws seeded by tree node, so the totals are exact, a task draws its own shard
without seeing the others, and a rerun draws the same. The n-th slot of a source takes block
``n mod blocks`` of epoch ``n div blocks`` through a pseudorandom permutation of the block indexes
(one per source and epoch), so every block of an epoch is taken once before the next begins. Slots
are then joined with blocks by index.

Targets: sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the sum of all
sizes; a target above three times its source's size is cut there and the rest is shared again
by weight until none is above.

Bounds: one row per source goes through the driver; a mix is stated for at most ``MAX_SOURCES``
sources and more is an error. Running word offsets are streamed inside range partitions and joined
with one total per partition and source.

Defined results: null and empty texts have size 0 and are never taken; the null source is a source;
documents of a source are ordered by id (null first), then by the hash of the text; repeated rows
are rows of their own; empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from cartlens.llm.common import byte_slices, fields, ship, utf8, written

BLOCK = 64
SHARD_SLOTS = 4096
MAX_SOURCES = 100_000
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def water_fill(sizes: list[int], weights: list[int], factor: int = MAX_EPOCHS) -> list[float]:
    """Targets that share the sum of sizes by weight, none above ``factor`` times its size."""
    caps = [factor * s for s in sizes]
    target, open_, rest = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_ and rest > 0:
        unit = rest / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > caps[i]]
        if not over:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = float(caps[i])
            rest -= caps[i]
        open_ = [i for i in open_ if i not in set(over)]
    return target


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of ``range(size)``: a four-round Feistel network, walked back into range."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    rounds = mixed_bits(np.arange(4, dtype=np.uint64) + np.uint64(key) * np.uint64(4))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for r in rounds:
            left, right = right, left ^ (mixed_bits(right ^ r) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def shard_counts(slots: np.ndarray, shard: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in a shard and in the shards before it, by binomial halving from the root."""
    count, before, node = slots.astype(np.int64), np.zeros(len(slots), np.int64), 1
    for level in range(depth - 1, -1, -1):
        left = np.random.default_rng([seed, node]).binomial(count, 0.5)
        right = shard >> level & 1
        before, count = (before + left, count - left) if right else (before, left)
        node = 2 * node + right
    return count, before


class Mix:
    """Sizes, targets and slots of the sources of a document table."""

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        block: int = BLOCK,
        seed: int = SEED,
        words_only: bool = True,
    ):
        spark = docs.sparkSession
        ship(spark)
        self.spark, self.id_col, self.text_col, self.block, self.seed = spark, id_col, text_col, block, seed
        text = F.coalesce(F.col(text_col), F.lit(""))
        small = [
            F.col(id_col).alias("_id"),
            F.col(source_col).cast("string").alias("_source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
            F.xxhash64(text).alias("_tie"),
            F.monotonically_increasing_id().alias("_row"),
        ]
        if words_only:
            self.docs, sized = None, written(docs.select(*small), "sized")
        else:  # the rows themselves are written with a row number, to be cut later
            self.docs = written(docs.withColumns({c: e for c, e in zip(("_id", "_source", "_size", "_tie", "_row"), small)}), "numbered")
            sized = self.docs.select("_id", "_source", "_size", "_tie", "_row")
        totals = sized.groupBy("_source").agg(F.sum("_size").alias("_n")).limit(MAX_SOURCES + 1).collect()
        if len(totals) > MAX_SOURCES:
            raise ValueError(f"a mix is stated for at most {MAX_SOURCES} sources")
        totals.sort(key=lambda r: (r[0] is None, r[0] or ""))
        self.names = [r[0] for r in totals]
        self.sizes = [r[1] for r in totals]
        self.targets = water_fill(self.sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))])
        self.blocks = np.asarray([-(-s // block) for s in self.sizes], np.int64)
        mean = [s / b if b else 1.0 for s, b in zip(self.sizes, self.blocks.tolist())]
        wanted = np.asarray([round(t / m) for t, m in zip(self.targets, mean)], np.int64)
        self.slots = np.minimum(wanted, MAX_EPOCHS * self.blocks)
        sources = spark.createDataFrame(
            [(n, i, s, t) for i, (n, s, t) in enumerate(zip(self.names, self.sizes, self.targets))],
            "_source string, _s int, _source_size long, _target double",
        )
        # bounded: one row per source
        coded = sized.join(F.broadcast(sources), sized["_source"].eqNullSafe(sources["_source"])).drop("_source")
        self.placed = self._placed(coded)

    def _placed(self, coded: DataFrame) -> DataFrame:
        """Add ``_first``, the words of the source before the document."""
        schema = fields(coded, ["_s", "_size", "_row", "_id", "_source_size", "_target"], [("_local", LongType())])

        def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            source, done = -1, 0
            for batch in batches:
                codes = batch.column("_s").to_numpy()
                sizes = batch.column("_size").to_numpy()
                ends = np.cumsum(sizes)
                before = ends - sizes
                starts = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
                base = np.repeat(before[starts], np.diff(np.append(starts, len(codes))))
                local = before - base
                if len(codes) and codes[0] == source:
                    local[codes == source] += done
                if len(codes):
                    source = codes[-1]
                    done = int(local[-1] + sizes[-1])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-1]), pa.array(local)], names=schema.names)

        order = [F.col("_s"), F.col("_id").asc_nulls_first(), F.col("_tie"), F.col("_row")]
        ranged = coded.repartitionByRange(*order).sortWithinPartitions(*order)
        local = written(ranged.select(*schema.names[:-1]).mapInArrow(running, schema).withColumn("_part", F.spark_partition_id()), "placed")
        # at most one row per partition and source
        totals = local.groupBy("_s", "_part").agg(F.sum("_size").alias("_n"))
        lower = Window.partitionBy("_s").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        base = totals.select("_s", "_part", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_base"))
        return local.join(F.broadcast(base), ["_s", "_part"]).withColumn("_first", F.col("_base") + F.col("_local")).drop("_base", "_local", "_part")

    def output_slots(self) -> DataFrame:
        """The mix: one row per output slot with ``shard``, ``position``, ``_s``, ``_block`` and ``epoch``."""
        total = int(self.slots.sum())
        depth = max(0, -(-total // SHARD_SLOTS) - 1).bit_length()
        slots, blocks, seed = self.slots, self.blocks, self.seed

        def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in batch.column("id").to_pylist():
                    count, before = shard_counts(slots, shard, depth, seed)
                    source = np.repeat(np.arange(len(slots)), count)
                    if not len(source):
                        continue
                    number = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(before, count)
                    epoch, index = number // blocks[source], number % blocks[source]
                    for s in np.flatnonzero(count).tolist():
                        for e in np.unique(epoch[source == s]).tolist():
                            own = (source == s) & (epoch == e)
                            index[own] = permuted(index[own], int(blocks[s]), (seed << 40) + s * (MAX_EPOCHS + 1) + e)
                    place = np.random.default_rng([seed, 0, shard]).permutation(len(source))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(source), shard)),
                            pa.array(place.astype(np.int32)),
                            pa.array(source.astype(np.int32)),
                            pa.array(index),
                            pa.array(epoch.astype(np.int32)),
                        ],
                        names=["shard", "position", "_s", "_block", "epoch"],
                    )

        shards = self.spark.range(0, 1 << depth, 1, max(8, (1 << depth) // 64)) if total else self.spark.range(0)
        return shards.mapInArrow(drawn, "shard long, position int, _s int, _block long, epoch int")

    def pieces(self) -> DataFrame:
        """The packing: one row per document and block that it lies in, with word offsets in the document."""
        size = self.block
        some = self.placed.where("_size > 0")
        each = some.withColumn("_block", F.explode(F.expr(f"sequence(_first div {size}, (_first + _size - 1) div {size})")))
        start = F.greatest(F.col("_block") * size - F.col("_first"), F.lit(0))
        end = F.least((F.col("_block") + 1) * size - F.col("_first"), F.col("_size"))
        return each.select("_s", "_block", "_row", start.alias("_from"), end.alias("_to"))

    def taken(self) -> DataFrame:
        """``_row`` and the words the mix takes of it, repeats counted; rows of which none are taken are left out."""
        times = self.output_slots().groupBy("_s", "_block").agg(F.count("*").alias("_times"))
        # the planner takes a few shard numbers for the size of the slots, so broadcasting is ruled out
        joined = self.pieces().join(times.hint("merge"), ["_s", "_block"])
        return joined.groupBy("_row").agg(F.sum((F.col("_to") - F.col("_from")) * F.col("_times")).alias("_taken"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` (of its source), ``taken``."""
    mix = Mix(docs, id_col, text_col, source_col)
    return mix.placed.join(mix.taken().hint("merge"), "_row", "left").select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.coalesce("_taken", F.lit(0)).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """The mix as documents: a row per document and epoch that takes words of it, holding those words.

    Blocks that lie side by side keep the text between their words; a document that an epoch
    takes whole keeps its text unchanged. Columns are those of the input; ``chars_col`` is counted
    anew.
    """
    rest = F.struct(*[c for c in docs.columns if c != text_col])
    packed = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), rest.alias("rest")
    )
    mix = Mix(packed, "id", "text", "source", words_only=False)
    cut = (
        mix.pieces().join(mix.output_slots().hint("merge"), ["_s", "_block"])
        .groupBy("_row", "epoch")
        .agg(F.array_sort(F.collect_list(F.struct("_from", "_to"))).alias("_parts"))
    )
    joined = mix.docs.join(cut.hint("merge"), "_row").select("rest", "text", "_parts", "_size")

    @F.arrow_udf("string")
    def sliced(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            texts: list[pa.Array] = [pa.array([], pa.string())]
            for run in byte_slices(pa.RecordBatch.from_arrays(list(columns), ["text", "parts"]), "text", 1 << 20):
                rows = zip(utf8(run, "text"), run.column("parts").to_pylist())
                texts.append(pa.array([cut_words(text, [(p["_from"], p["_to"]) for p in parts or ()]) for text, parts in rows], pa.string()))
            yield pa.concat_arrays(texts)

    # a document taken whole stays in the JVM; of the others only text and places go to Python
    whole = F.aggregate("_parts", F.lit(0).cast("long"), lambda n, p: n + p["_to"] - p["_from"]) == F.col("_size")
    given = [F.when(~whole, F.col(c)).alias(c) for c in ("text", "_parts")]
    some = joined.select("rest", F.when(whole, F.col("text")).alias("_kept"), sliced(*given).alias("_cut"))
    taken = some.select("rest", F.coalesce("_kept", "_cut").alias("text"))

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("text").alias(name)
        if name == chars_col:
            return F.char_length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("rest")[name].alias(name)

    return taken.select(*[column(c) for c in docs.columns])


def cut_words(text: bytes, parts: list[tuple[int, int]]) -> str:
    """The words of the given ranges (sorted, disjoint), with the text between them where ranges touch."""
    merged: list[list[int]] = []
    for start, end in parts:
        if merged and merged[-1][1] == start:
            merged[-1][1] = end
        else:
            merged.append([start, end])
    found, ranges, first = [], iter(merged), 0
    start, end = next(ranges, (-1, -1))
    for number, word in enumerate(_WORD.finditer(text)):
        if number == start:
            first = word.start()
        if number == end - 1:
            found.append(text[first : word.end()].decode("utf-8"))
            start, end = next(ranges, (-1, -1))
            if end < 0:
                break
    return "\n".join(found)
