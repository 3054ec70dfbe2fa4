"""MinHash near-dedup: DartMinHash signatures, banded joining, verified links, classes.

Texts with the same word stream are one class member from the start, so copies cost one row each. The
members' signatures are cut into bands; members that agree in a band share a bucket and are
candidates. At a weighted similarity of 0.8 the chance to share none of 24 bands of 4 is 3 in a
million. Candidates are verified by the similarity of their shingle occurrences.

Classes are the connected components of the links, found without all pairs of a bucket:

1. The shingle occurrences that a member shares with no other bound its similarity to any: members
   that cannot reach the threshold leave, and so do pairs that cannot.
2. In each bucket the member with the smallest share of own occurrences is the hub, and every other
   member is a candidate with it. Verified links give classes.
3. What remains are pairs of different classes in one bucket. Two sets share at most the sum, over hash
   classes of occurrences, of the smaller number that each could share. A set marks a bit per class and level (it
   has one, it has two), so the sum is the number of common bits, compiled, with what is
   above the levels added whole; all pairs that this bound allows are verified, each once, from the first bucket they share. In the end no candidate pair of different classes is undecided, so the
   classes are those that all pairs would give.

Bucket counts and hubs are grouped with map-side combine, and members are joined with them, which
adaptive execution splits for a hot bucket. No bucket is collected.

Defined results: texts without words are similar only to texts that are exactly equal; null counts
as empty; one to four words are one shingle; null ids come after others; repeated rows belong
to one class and one of them is kept; empty tables give empty results; other columns are ignored, or
passed through by ``drop_near_copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from cartlens.llm.common import byte_slices, fields, fresh, ship, strings, written

BATCH_BYTES = 1 << 20
SIMILARITY = 0.8
#: Hash classes of shingle occurrences, and the occurrences of a class that are marked one by one.
CLASSES = 1024
LEVELS = 2
KEY = ["_k1", "_k2"]


def _member_keys(streams: list[bytes], texts: list[str]) -> tuple[list[int], list[int]]:
    """128-bit key of a word stream; of the text itself where it has no words."""
    found = [
        np.frombuffer(hashlib.blake2b(s if s else b"\0" + t.encode("utf-8"), digest_size=16).digest(), "<i8")
        for s, t in zip(streams, texts)
    ]
    return [int(f[0]) for f in found], [int(f[1]) for f in found]


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table with a row per document: ``_id``, ``_tie`` (hash of the text), member key, ``_bands``."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    small = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    schema = fields(small, ["_id", "_tie"], [("_k1", LongType()), ("_k2", LongType()), ("_bands", ArrayType(LongType(), False))])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm import dart_minhash

        for batch in batches:
            for run in byte_slices(batch, "_text", BATCH_BYTES):
                texts = strings(run, "_text")
                streams = [dart_minhash.word_stream(t) for t in texts]
                signature, counts = dart_minhash.signatures(streams)
                keys = dart_minhash.bands(signature)
                each = np.where(counts > 0, keys.shape[1], 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), pa.array(keys[counts > 0].reshape(-1))
                )
                one, two = _member_keys(streams, texts)
                yield pa.RecordBatch.from_arrays(
                    [run.column("_id"), run.column("_tie"), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists],
                    names=schema.names,
                )

    return written(small.mapInArrow(signed, schema), "sketched")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written table of member key, ``_n`` and ``_codes`` (shingle occurrences) of the wanted documents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    small = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    named = wanted.select(F.col("_id").alias("_wid"), F.col("_tie").alias("_wtie"))
    chosen = small.join(named, F.col("_id").eqNullSafe(F.col("_wid")) & (F.col("_tie") == F.col("_wtie")), "left_semi")
    kind = "_k1 long, _k2 long, _n int, _codes array<int>"

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm import dart_minhash

        for batch in batches:
            for run in byte_slices(batch, "_text", BATCH_BYTES):
                texts = strings(run, "_text")
                streams = [dart_minhash.word_stream(t) for t in texts]
                sets = dart_minhash.occurrences(streams)
                one, two = _member_keys(streams, texts)
                sizes = [len(s) for s in sets]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(sets), pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one, pa.int64()),
                        pa.array(two, pa.int64()),
                        pa.array(sizes, pa.int32()),
                        lists,
                    ],
                    names=["_k1", "_k2", "_n", "_codes"],
                )

    sets = written(chosen.select("_text").mapInArrow(coded, kind), "sets")
    # the same row more than once, if any, has the same set
    return sets.dropDuplicates(KEY) if sets.count() > sets.select(*KEY).distinct().count() else sets


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The pairs (``_a``, ``_b`` member numbers) whose similarity reaches the threshold."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values.to_numpy() for c in ("_codes_a", "_codes_b"))
                shared = len(np.intersect1d(a, b))
                if shared >= threshold * (len(a) + len(b) - shared) - 1e-9:
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(kept, pa.int64())) for c in ("_a", "_b")], names=["_a", "_b"])

    one = pairs.join(sets.select(F.col("_m").alias("_a"), F.col("_codes").alias("_codes_a")), "_a")
    both = one.join(sets.select(F.col("_m").alias("_b"), F.col("_codes").alias("_codes_b")), "_b")
    return both.select("_a", "_b", "_codes_a", "_codes_b").mapInArrow(similar, "_a long, _b long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``_m`` and ``_c``, the smallest member it is linked to.

    Every round points each vertex to its smallest neighbour if that is smaller, follows the pointers to
    their roots (doubling), and contracts the edges to roots: edges inside a tree leave.
    """
    edges = written(_ordered(edges), "edges")
    both = edges.select("_a", "_b").unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
    labels = written(_pointers(both).toDF("_m", "_c"), "labels")
    roots = _rooted(labels.toDF("_x", "_root"))
    labels = roots.toDF("_m", "_c")
    while True:
        left = edges.join(roots.toDF("_a", "_ra"), "_a", "left").join(roots.toDF("_b", "_rb"), "_b", "left")
        moved = left.select(F.coalesce("_ra", "_a").alias("_a"), F.coalesce("_rb", "_b").alias("_b"))
        edges = written(_ordered(moved), "edges")
        if edges.isEmpty():
            return labels
        both = edges.select("_a", "_b").unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        roots = _rooted(written(_pointers(both).toDF("_x", "_root"), "pointers"))
        labels = labels.join(roots.toDF("_c", "_root"), "_c", "left").select("_m", F.coalesce("_root", "_c").alias("_c"))
        labels = written(labels, "labels")


def _pointers(both: DataFrame) -> DataFrame:
    return both.groupBy("_a").agg(F.min("_b").alias("_near")).select("_a", F.least("_a", "_near").alias("_to"))


def _rooted(pointers: DataFrame) -> DataFrame:
    """Follow ``_x`` to ``_root`` until no pointer changes; pointers lead to smaller vertices, so they end."""
    while True:
        onward = pointers.toDF("_root", "_next")
        step = written(pointers.join(onward, "_root").select("_x", F.col("_next").alias("_to"), "_root"), "pointers")
        pointers = step.select("_x", F.col("_to").alias("_root"))
        if step.where(F.col("_to") != F.col("_root")).isEmpty():
            return pointers


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: ``_id``, ``_tie`` and ``_class`` (struct of the smallest id and tie of its class)."""
    rows = sketched(docs, id_col, text_col)
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_tie").alias("tie")))
    members = written(
        rows.groupBy(*KEY).agg(first.alias("_first"), F.first("_bands").alias("_bands")).withColumn("_m", F.monotonically_increasing_id()),
        "members",
    )
    spread = members.select("_m", F.explode("_bands").alias("_bucket"))
    # written, so that adaptive execution can split a hot bucket in the join
    shared = written(spread.groupBy("_bucket").agg(F.count("*").alias("_size")).where("_size > 1"), "shared")
    placed = written(spread.join(shared, "_bucket"), "placed")
    central = written(placed.groupBy("_m").agg(F.sum("_size").alias("_degree")), "central")
    wanted = members.join(central.select("_m"), "_m", "left_semi")
    found = shingle_sets(docs, wanted.select("_first.id", "_first.tie").toDF("_id", "_tie"), id_col, text_col)
    sets = written(wanted.select(*KEY, "_m").join(found, KEY).select("_m", "_n", "_codes"), "member_sets")
    traits = written(linkable(sets, threshold).join(central, "_m"), "traits")
    placed = written(placed.select("_bucket", "_m").join(traits.drop("_own"), "_m"), "linkable")

    hubs = written(placed.groupBy("_bucket").agg(F.max(_rank()).alias("_hub")), "hubs")
    pairs = placed.join(hubs, "_bucket").where(_possible(*(F.col(c) for c in ("_n", "_u", "_hub.n", "_hub.u")), threshold))
    tried = written(_ordered(pairs.select(F.col("_m").alias("_a"), (-F.col("_hub.m")).alias("_b"))), "pairs")
    links = written(verified(tried, sets, threshold), "links")
    labels = components(links)

    joined = written(placed.join(labels, "_m", "left").withColumn("_c", F.coalesce("_c", "_m")), "labelled")
    several = joined.groupBy("_bucket").agg(F.min("_c").alias("_low"), F.max("_c").alias("_high")).where("_low < _high")
    left = joined.join(written(several.select("_bucket"), "several"), "_bucket")
    left = written(left, "mixed_members")
    marked = marks(sets.join(left.select("_m").distinct(), "_m", "left_semi"), traits.select("_m", "_own"))
    marked = written(marked.join(members.select("_m", "_bands"), "_m"), "marks")
    left = written(left.join(marked, "_m"), "mixed")
    names = ("_m", "_c", "_n", "_u", "_marks", "_above", "_bands")
    a, b = (left.select("_bucket", *[F.col(c).alias(f"{c}{side}") for c in names]) for side in ("a", "b"))
    possible = _possible(*(F.col(c) for c in ("_na", "_ua", "_nb", "_ub")), threshold)
    most = F.least("_abovea", "_aboveb")
    for i in range(CLASSES * LEVELS // 64):
        most = most + F.bit_count(F.col("_marksa")[i].bitwiseAND(F.col("_marksb")[i]))
    enough = most >= threshold * (F.col("_na") + F.col("_nb") - most) - 1e-9
    # a pair leaves from the first of the buckets it shares alone
    first = F.col("_bucket") == F.array_min(F.array_intersect("_bandsa", "_bandsb"))
    across = a.join(b, "_bucket").where((F.col("_ca") < F.col("_cb")) & possible & enough & first)
    pairs = _ordered(across.select(F.col("_ma").alias("_a"), F.col("_mb").alias("_b")))
    new = written(pairs.join(tried, ["_a", "_b"], "left_anti"), "pairs")
    if not new.isEmpty():
        more = written(verified(new, sets, threshold), "links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))

    whole = members.select(*KEY, "_m", "_first").join(labels, "_m", "left").withColumn("_c", F.coalesce("_c", "_m"))
    least = whole.groupBy("_c").agg(F.min("_first").alias("_class"))
    named = whole.join(least, "_c").select(*KEY, "_class")
    return rows.select("_id", "_tie", *KEY).join(named, KEY).select("_id", "_tie", "_class")


def linkable(sets: DataFrame, threshold: float) -> DataFrame:
    """Members that can be similar to another: ``_m``, ``_n``, ``_u`` and ``_own``.

    ``_own`` has the occurrences that no other member has, ``_u`` their number. A partner shares at most ``n - u`` occurrences, and the union has at least ``n``.
    """
    codes = sets.select("_m", F.explode("_codes").alias("_code"))
    alone = codes.groupBy("_code").agg(F.count("*").alias("_times"), F.min("_m").alias("_m")).where("_times = 1")
    # a list is part of its member's set
    own = alone.groupBy("_m").agg(F.count("*").alias("_u"), F.collect_list("_code").alias("_own"))
    joined = sets.select("_m", "_n").join(own, "_m", "left")
    known = joined.select("_m", "_n", F.coalesce("_u", F.lit(0)).alias("_u"), F.coalesce("_own", F.array().cast("array<int>")).alias("_own"))
    return known.where(F.col("_n") - F.col("_u") >= threshold * F.col("_n") - 1e-9)


def marks(sets: DataFrame, own: DataFrame) -> DataFrame:
    """``_m`` with ``_marks``, the shareable occurrences as bits by level and class, and ``_above``, their number above the levels."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, above = [], []
            for i in range(batch.num_rows):
                codes, alone = (batch.column(c)[i].values.to_numpy() for c in ("_codes", "_own"))
                number = np.bincount(np.setdiff1d(codes, alone) & (CLASSES - 1), minlength=CLASSES)
                bits = np.packbits(number >= np.arange(1, LEVELS + 1)[:, None], bitorder="little")
                words.append(bits.view("<i8").tolist())
                above.append(int(np.maximum(number - LEVELS, 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_m"), pa.array(words, pa.list_(pa.int64())), pa.array(above, pa.int32())], names=["_m", "_marks", "_above"]
            )

    return sets.join(own, "_m").select("_m", "_codes", "_own").mapInArrow(marked, "_m long, _marks array<long>, _above int")


def _possible(n: Column, u: Column, m: Column, v: Column, threshold: float) -> Column:
    """Whether sets of n and m occurrences, u and v of them shared with no other, can reach the threshold."""
    most = F.least(n - u, m - v)
    return most >= threshold * (n + m - most) - 1e-9


def _rank() -> Column:
    """Order of members as hubs: the smallest share of own occurrences, the most and largest buckets, the number."""
    return F.struct(
        (-F.col("_u") / F.col("_n")).alias("common"),
        F.col("_degree").alias("degree"),
        (-F.col("_m")).alias("m"),
        F.col("_n").alias("n"),
        F.col("_u").alias("u"),
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    apart = pairs.where(F.col("_a") != F.col("_b"))
    return apart.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: id, ``class_id`` (the smallest id of its class), ``class_size``, ``kept``."""
    rows = written(classes(docs, id_col, text_col, threshold), "classes")
    # written, so that adaptive execution can split a hot class in the join
    sizes = written(rows.groupBy("_class").agg(F.count("*").alias("class_size")), "sizes")
    return rows.join(sizes, "_class").select(
        F.col("_id").alias(id_col),
        F.col("_class.id").alias("class_id"),
        "class_size",
        (F.col("_id").eqNullSafe(F.col("_class.id")) & (F.col("_tie") == F.col("_class.tie"))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """The first document of each class, with all its columns."""
    rows = classes(docs, id_col, text_col, threshold)
    same = F.col("_id").eqNullSafe(F.col("_class.id")) & (F.col("_tie") == F.col("_class.tie"))
    key, tie, own = fresh(docs.columns, "_id", "_tie", "_t")
    kept = written(rows.where(same).select(F.col("_id").alias(key), F.col("_tie").alias(tie)), "kept")
    tied = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    left = tied.join(kept, F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(tie)), "left_semi")
    if kept.count() > kept.distinct().count():
        left = left.dropDuplicates([id_col, own])  # the same row more than once: any one of them stays
    return left.drop(own)
