"""The manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cartlens.llm import merkle
from tests.llm.cases import awkward, empty, rows_of


def digest(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def netstring(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves: list[str], fan: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and per leaf the siblings before and after, level by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run = i // fan * fan
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + fan])))
        nodes, at = [digest(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)], [i // fan for i in at]
    return nodes[0], paths


def plain_manifest(rows, fan: int = 8) -> list[tuple]:
    """``rows``: doc_id, source, lang, n_chars, text."""
    groups = {}
    for row in rows:
        changed = (*row[:4], None if row[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
        leaf, other = (digest(*map(netstring, r)) for r in (row, changed))
        chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        groups.setdefault(row[2], []).append((row[0], leaf, other if chosen else leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(plain_tree([r[1] for r in groups[name]], fan))
    root, tops = plain_tree([t[0] for t in trees], fan)
    found = []
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (i, leaf, start), path in zip(groups[name], paths):
            whole = path + top
            node = start
            for before, after in whole:
                node = digest(before, node, after)
            found.append((i, leaf, subroot, root, digest(*[b + a for b, a in whole]), node, node == root))
    return sorted(found, key=repr)


KIND = "doc_id long, source string, lang string, n_chars int, text string, _at long, root string"


def rows(sizes: dict) -> list[tuple]:
    found, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            i += 1
            found.append((i * 7 % 1009, None if i % 5 == 0 else f"s{i % 3}", name, None if i % 4 == 0 else i, None if i % 11 == 0 else f"Text {i} É"))
    return found


@pytest.mark.parametrize(
    "sizes",
    [{"en": 1}, {"en": 8}, {"en": 9, None: 1}, {"en": 200, "de": 65, None: 64, "": 2, "é": 8, "z": 1}, {f"l{i:02}": i % 4 + 1 for i in range(20)}],
)
def test_equals_a_plain_tree(spark, sizes):
    given = rows(sizes)
    docs = spark.createDataFrame([(*r, 3, "clash") for r in given], KIND)
    assert rows_of(merkle.manifest(docs)) == plain_manifest(given)


def test_another_fan(spark):
    given = rows({"en": 23, "de": 5})
    docs = spark.createDataFrame([(*r, 3, "clash") for r in given], KIND)
    assert rows_of(merkle.manifest(docs, fan=2)) == plain_manifest(given, 2)


def test_changed_rows_are_found(spark):
    given = rows({"en": 100, "de": 30})
    docs = spark.createDataFrame([(*r, 3, "clash") for r in given], KIND)
    found = merkle.manifest(docs)
    for row in found.join(docs.select("doc_id", "text"), "doc_id").collect():
        changed = row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
        assert row.verified == (not changed)
    assert found.where("verified").where(F.col("folded_root") != F.col("root")).isEmpty()


def test_awkward_rows(spark):
    docs = awkward(spark)
    given = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert rows_of(merkle.manifest(docs)) == plain_manifest(given)
    by_source = merkle.manifest(docs, group_col="source")
    assert by_source.count() == len(given) and by_source.select("root").distinct().count() == 1
    assert rows_of(merkle.manifest(empty(spark))) == []
