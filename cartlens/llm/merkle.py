"""Merkle manifest of a dataset: one tree per group, a tree over their roots, a checked proof per row.

Leaves are digests of rows. Levels are climbed by sibling-shift joins: with ``FAN`` nodes in a
run, the node in slot zero is joined with its siblings by their computed indices (its own plus 1, 2, ...)
and emits the parent. The joins of a level share their key, so each node moves once. On the
way down every run hands its nodes the siblings before and after them, with the path of the run's parent. A row's path
is hashed into its proof and folded from its leaf back to the root.

Positions come from ranges: rows are dealt by (group, id) in order, numbered in their range, and range totals are
added, so the largest group is no task of its own. All joins are on (tree, position), where no key repeats.

Defined results: null columns are written ``-`` and null groups are a group, the first; rows of equal id
are ordered by their leaf; rows with null ids come first and are not tampered with; repeated rows are
leaves of their own; empty tables give empty results; other columns are ignored. A text
of any length is hashed in one expression.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartlens.llm.common import written

FAN = 8
TAMPER = 3
KEY = ["_tree", "_at"]
PATH = "array<struct<before: string, after: string>>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs one after another."""
    return F.sha2(F.concat(*inputs), 256)


def netstring(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def ranged(frame: DataFrame, group: str, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Written rows dealt to ranges in order, and per (group, range): ``_shift`` from row numbers to positions, ``_of``, the group's rows."""
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = frame.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(dealt.withColumn("_row", F.monotonically_increasing_id()), f"{name}_ranges")
    placed = placed.withColumn("_range", F.shiftright("_row", 33))
    totals = placed.groupBy(F.col(group).alias("_group"), "_range").agg(F.min("_row").alias("_lowest"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_group",
        "_range",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_lowest")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_group")).alias("_of"),
    )
    return placed, written(starts, f"{name}_starts")


def numbered(placed: DataFrame, starts: DataFrame, group: str) -> DataFrame:
    """Rows with ``_at``, the position in their group from 0, and the columns of ``starts``."""
    side = starts.withColumnRenamed("_range", "_part")
    joined = placed.join(side, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_part")))
    return joined.withColumn("_at", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_part", "_shift", "_group")


def _runs(nodes: DataFrame, fan: int) -> DataFrame:
    """Runs of siblings: ``_tree``, ``_at`` and ``_of`` of the parent, ``_nodes`` in order, ``_digest`` of the parent."""
    slot = F.col("_at") % fan
    run = nodes.where(slot == 0).withColumnRenamed("_node", "_node0")
    for shift in range(1, fan):
        sibling = nodes.where(slot == shift).select("_tree", (F.col("_at") - shift).alias("_at"), F.col("_node").alias(f"_node{shift}"))
        run = run.join(sibling, KEY, "left")
    names = [f"_node{i}" for i in range(fan)]
    return run.select(
        "_tree",
        F.expr(f"_at div {fan}").alias("_at"),
        F.expr(f"(_of + {fan - 1}) div {fan}").alias("_of"),
        F.filter(F.array(*names), lambda node: node.isNotNull()).alias("_nodes"),
        digest(*[F.coalesce(F.col(n)["digest"], F.lit("")) for n in names]).alias("_digest"),
    )


def climb(nodes: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of every level, and the nodes that are roots at every level, from the leaves up.

    ``nodes`` has ``_tree``, ``_at``, ``_of`` and ``_node`` (a struct with ``digest``).
    """
    most = nodes.agg(F.max("_of")).first()[0] or 0
    levels, roots = [], []
    while True:
        roots.append(nodes.where("_of = 1").select("_tree", "_node"))
        if most <= 1:
            return levels, roots
        levels.append(written(_runs(nodes.where("_of > 1"), fan), f"level{len(levels)}"))
        nodes = levels[-1].select(*KEY, "_of", F.struct(F.col("_digest").alias("digest")).alias("_node"))
        most = -(-most // fan)


def descend(levels: list[DataFrame], roots: list[DataFrame], starts: DataFrame, fan: int = FAN) -> DataFrame:
    """Leaves with their paths: ``_tree``, ``_at``, ``_node``, ``_path`` and the other columns of ``starts``.

    ``starts`` has a row per tree: ``_tree``, ``_path`` (what follows the tree's root) and columns to hand down.
    """
    handed = [c for c in starts.columns if c not in ("_tree", "_path")]
    above = None
    for level in range(len(roots) - 1, -1, -1):
        rooted = roots[level].join(starts, "_tree").select("_tree", F.lit(0).cast("long").alias("_at"), "_node", "_path", *handed)
        if above is None:
            above = rooted
            continue
        # only paths move here, those of the leaves are made after the last join
        parents = written(above.drop("_node"), f"paths{level + 1}")
        spread = levels[level].join(parents, KEY).select(*KEY, "_nodes", "_path", *handed, F.posexplode("_nodes").alias("_slot", "_node"))
        digests = F.col("_nodes.digest")
        own = F.struct(
            F.array_join(F.slice(digests, F.lit(1), F.col("_slot")), "").alias("before"),
            F.array_join(F.slice(digests, F.col("_slot") + 2, F.lit(fan)), "").alias("after"),
        )
        below = spread.select(
            "_tree", (F.col("_at") * fan + F.col("_slot")).alias("_at"), "_node", F.concat(F.array(own), "_path").alias("_path"), *handed
        )
        above = below.unionByName(rooted)
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["before"], node, level["after"]))


def proof(path: Column) -> Column:
    """Digest of all siblings on a path."""
    return digest(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    leaf_cols: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    text_col: str = "text",
    fan: int = FAN,
    tamper: int = TAMPER,
) -> DataFrame:
    """One row per row of ``docs``: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    Where ``tamper`` divides the id's CRC-32, ``folded_root`` starts from the leaf of a changed row (A-Z of the text in lower case).
    """
    lowered = F.translate(text_col, string.ascii_uppercase, string.ascii_lowercase)
    leaf = digest(*[netstring(F.col(c)) for c in leaf_cols])
    changed = digest(*[netstring(lowered if c == text_col else F.col(c)) for c in leaf_cols])
    chosen = F.crc32(F.col(id_col).cast("string")) % tamper == 0
    hashed = docs.select(
        F.col(id_col).alias("_id"),
        F.col(group_col).alias("_lang"),
        leaf.alias("_leaf"),
        F.when(chosen, changed).otherwise(leaf).alias("_start"),
    )
    rows, starts = ranged(written(hashed, "leaves"), "_lang", ["_id", "_leaf"], "rows")
    groups = starts.select(F.col("_group").alias("_name"), F.lit(0).alias("_one")).distinct()
    trees = numbered(*ranged(groups, "_one", ["_name"], "groups"), "_one")
    trees = written(trees.select("_name", F.col("_at").alias("_tree"), F.col("_of").alias("_trees")), "trees")
    # trees are added to range totals, so a large group is split over its ranges in the join with its rows
    starts = starts.join(trees, F.col("_group").eqNullSafe(F.col("_name"))).drop("_name", "_trees")
    node = F.struct(F.col("_leaf").alias("digest"), F.col("_id").alias("id"), F.col("_start").alias("start")).alias("_node")
    leaves = numbered(rows, starts, "_lang").select(*KEY, "_of", node)
    levels, roots = climb(written(leaves, "tree_leaves"), fan)

    only = F.struct(F.col("_node.digest").alias("digest")).alias("_node")
    subroots = roots[0].select("_tree", only)
    for found in roots[1:]:
        subroots = subroots.unionByName(found.select("_tree", only))
    tops = written(subroots.join(trees, "_tree").select(F.lit(0).cast("long").alias("_tree"), F.col("_tree").alias("_at"), F.col("_trees").alias("_of"), "_node"), "subroots")
    top_levels, top_roots = climb(tops, fan)
    root = top_roots[-1].select("_tree", F.array().cast(PATH).alias("_path"), F.col("_node.digest").alias("_root"))
    starts = descend(top_levels, top_roots, written(root, "root"), fan).select(
        F.col("_at").alias("_tree"), "_path", F.col("_node.digest").alias("_subroot"), "_root"
    )
    final = descend(levels, roots, written(starts, "starts"), fan)
    folded_root = folded(F.col("_node.start"), F.col("_path"))
    return final.select(
        F.col("_node.id").alias(id_col),
        F.col("_node.digest").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        proof(F.col("_path")).alias("proof_sha256"),
        folded_root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
