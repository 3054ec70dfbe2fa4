"""Near-dedup against all pairs, and its signatures against exact similarities."""

import random
from collections import Counter

import numpy as np
import pytest

from cartlens.llm import dart_minhash, near_dedup
from tests.llm.cases import awkward, empty, prose


def grams(text: str) -> Counter:
    words = dart_minhash.word_stream(text).split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def edited(text: str, edits: int, seed: int) -> str:
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def plain_classes(rows) -> dict[int, int]:
    sets, parent = [grams(t or "") for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = not sets[i] and not sets[j] and (rows[i][1] or "") == (rows[j][1] or "")
            if same or similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return {key: least[find(i)] for i, (key, _) in enumerate(rows)}


def test_signatures_estimate_the_weighted_similarity():
    a = [prose(i, n) * (1 + i % 3) for i, n in enumerate((1, 3, 5, 8, 30, 200, 1_000) * 15)]
    b = [edited(t, i % 4, i) for i, t in enumerate(a)]
    streams = [dart_minhash.word_stream(t) for t in a + b]
    marks, counts = dart_minhash.signatures(streams)
    estimate = (marks[: len(a)] == marks[len(a) :]).mean(axis=1)
    exact = np.asarray([similarity(grams(x), grams(y)) for x, y in zip(a, b)])
    assert abs((estimate - exact).mean()) < 0.01 and (estimate - exact).std() < 0.05
    assert counts.tolist() == [sum(grams(t).values()) for t in a + b]
    some, _ = dart_minhash.signatures(streams[20:40])
    assert np.array_equal(some, marks[20:40])
    sets = dart_minhash.occurrences(streams)
    for i in range(len(a)):
        x, y = set(sets[i].tolist()), set(sets[len(a) + i].tolist())
        assert len(x & y) / len(x | y) == pytest.approx(exact[i])


def test_classes_are_those_of_all_pairs(spark):
    rows = []
    for base in range(12):
        text = prose(base, 60 + 10 * base)
        rows += [(len(rows) + k, edited(text, k % 4, k)) for k in range(10)]
    chain = prose(77, 120)  # neighbours are similar, the ends are not
    for k in range(15):
        rows.append((len(rows), chain))
        chain = edited(chain, 2, k)
    rows += [(len(rows), prose(500, 50)), (len(rows) + 1, prose(501, 3)), (len(rows) + 2, prose(501, 3).upper() + "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_dedup.near_copies(docs).collect()
    want = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in found} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in found)
    kept = near_dedup.drop_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(sizes)


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(149)] + [(order[i], order[i + 1]) for i in range(150, 199)]
    found = {r["_m"]: r["_c"] for r in near_dedup.components(spark.createDataFrame(edges, "_a long, _b long")).collect()}
    assert all(found[v] == min(order[:150]) for v in order[:150]) and all(found[v] == min(order[150:]) for v in order[150:])


def test_edge_cases(spark):
    docs = awkward(spark)
    found = near_dedup.near_copies(docs).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(found) == docs.count()
    assert by_id[1][0].class_id == by_id[2][0].class_id != by_id[3][0].class_id
    assert by_id[4][0].class_id == by_id[5][0].class_id == 4
    assert {r.class_id for r in by_id[9]} == {6}
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.class_id for r in found}) + 1  # id 6 stands for two texts
    assert near_dedup.near_copies(empty(spark)).collect() == [] and near_dedup.drop_near_copies(empty(spark)).collect() == []


def test_marks_bound_what_two_sets_share(spark):
    rng = np.random.default_rng(3)
    sets, own = [], []
    for m in range(30):
        n = int(rng.choice([3, 50, 400, 6_000]))
        codes = np.unique(rng.integers(0, 9_000, n)).astype(np.int32)
        alone = rng.choice(codes, len(codes) // 5, replace=False)
        sets.append((m, codes.tolist()))
        own.append((m, alone.tolist()))
    marked = near_dedup.marks(
        spark.createDataFrame(sets, "_m long, _codes array<int>"), spark.createDataFrame(own, "_m long, _own array<int>")
    ).collect()
    assert len(marked) == 30
    words = {r["_m"]: (np.asarray(r["_marks"], "<i8").view("<u8"), r["_above"]) for r in marked}
    left = {m: set(c) - set(o) for (m, c), (_, o) in zip(sets, own)}
    for a in left:
        for b in left:
            common = int(np.bitwise_count(words[a][0] & words[b][0]).sum()) + min(words[a][1], words[b][1])
            assert len(left[a] & left[b]) <= common
            if a == b:
                assert common == len(left[a])


def test_families_that_share_a_passage_stay_apart(spark):
    """Many classes in the buckets of one passage: few pairs leave the bound, and classes are those of all pairs."""
    passage, rows = prose(900, 60, 10_000), []
    for family in range(60):
        text = passage + " " + prose(1_000 + family, 80, 10_000)
        rows += [(3 * family + k, edited(text, k, family)) for k in range(3)]
    found = near_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.class_id for r in found} == plain_classes(rows)
