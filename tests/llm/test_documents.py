"""Quality, licenses, fingerprints, mixing and exact dedup against plain versions."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartlens.llm import exact_dedup, licenses, mixing, piecewise_hash, quality
from cartlens.llm.common import byte_slices, utf8
from tests.llm.cases import awkward, empty, prose, rows_of


# --- quality ---
def test_classifier_learns_and_holds_out(spark):
    good = [(i, prose(i, 60 + i % 50)) for i in range(300)]
    bad = [(1_000 + i, " ".join(f"{w.upper()}!!" for w in prose(i, 50).split())) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1_000)) for i, _ in good + bad] + [(5, None)], "doc_id long, quality int")
    found = quality.classify(docs, labels).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 360 and len(held) > 30
    assert np.mean([r.predicted == int(r.doc_id < 1_000) for r in held]) > 0.97
    assert quality.classify(docs, labels).collect() == found


def test_scoring_memory_is_that_of_a_batch():
    texts = [prose(i, 1_500).encode() for i in range(200)]
    assert sum(map(len, texts)) > 4 * quality.BATCH_BYTES
    model = quality.fit(texts[:6], [0, 1] * 3, epochs=1)
    alone = [float(model.scores([t])[0]) for t in texts[:20]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["_text"])
    tracemalloc.start()
    found = np.concatenate([model.scores(utf8(run, "_text")) for run in byte_slices(batch, "_text", quality.BATCH_BYTES)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 200 and found[:20].tolist() == pytest.approx(alone, abs=1e-12)
    assert peak < 60_000_000


def test_held_out_labels_are_not_read(spark):
    docs = spark.createDataFrame([(i, prose(i, 40)) for i in range(100)], "doc_id long, text string")
    flags = {r[0]: r[1] for r in docs.select("doc_id", quality.fold(docs["doc_id"])).collect()}
    one = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    two = spark.createDataFrame([(i, i % 2 if flags[i] else 1 - i % 2) for i in range(100)], "doc_id long, quality int")
    assert np.array_equal(quality.train(docs, one).weights, quality.train(docs, two).weights)


def test_scores_do_not_depend_on_the_batch():
    model = quality.fit([prose(i, 30).encode() for i in range(20)], [i % 2 for i in range(20)])
    texts = [b"", b"one", prose(99, 500).encode(), b"  a  b ", b"", "é日本 x".encode()]
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts])
    assert together[0] == together[4]


def test_classifier_edge_cases(spark):
    labels = spark.createDataFrame([(4, 1), (7, 0), (6, 1)], "doc_id long, quality int")
    docs = awkward(spark)
    found = quality.classify(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    none = labels.limit(0)
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.classify(empty(spark), labels).collect() == []
    assert quality.accepted(docs, quality.train(docs, none)).columns == docs.columns


# --- licenses ---
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hits = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        hits += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = sorted(i for i, _ in hits)
    first, last = (starts[0], starts[-1]) if starts else (None, None)
    return len(words), len(hits), first, last, ",".join(sorted({label for _, label in hits}))


def test_licenses_base_places(spark):
    docs = awkward(spark).select("doc_id", "text").union(
        spark.createDataFrame(
            [
                (20, "The MIT License. mit license MIT-license\nApache  License"),
                (21, "gnu general public license " * 50),
                (22, "mit licenses; general public"),
                (23, "Ümit license"),
            ],
            "doc_id long, text string",
        )
    )
    found = licenses.scan_licenses(docs).collect()
    want = [(r.doc_id, *plain_base(r.text)) for r in docs.collect()]
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found)
    assert licenses.scan_licenses(empty(spark)).collect() == []


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("Redistributions of source code must retain the above copyright notice", "bsd"),
        ("GNU Lesser General Public License v2.1", "lgpl-2.1"),
    ],
)
def test_license_labels(text, label):
    assert [k[1] for k in licenses.scan(text.encode())[2]] == [label]


def test_rules_are_many_and_gated():
    rules = licenses.rules()
    assert len(rules) > 250 and all(r.gate for r in rules)
    assert licenses.scan(prose(1, 100).encode()) == (100, [], [])


def expanded(tree) -> list[str]:
    """Texts of a parsed pattern: each alternative, and each repeat at its least and one above."""
    texts = [""]
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            own = [chr(value)]
        elif name == "IN":  # "any but space" is one word
            own = [t for k, v in value for t in ([chr(v)] if str(k) == "LITERAL" else map(chr, range(v[0], v[1] + 1)) if str(k) == "RANGE" else ["x"])]
        elif name == "SUBPATTERN":
            own = expanded(value[3])
        elif name == "BRANCH":
            own = [t for branch in value[1] for t in expanded(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            own = [t * n for n in range(value[0], min(value[0] + 1, value[1]) + 1) for t in expanded(value[2])]
        else:
            assert name == "ASSERT", name  # the spaces around a match
            own = [""]
        texts = [t + o for t in texts for o in dict.fromkeys(own)]
    return texts


def test_gates_hide_no_match(monkeypatch):
    texts = [t for _, _, pattern in licenses.BODIES for t in expanded(re._parser.parse(pattern))]
    for _, _, name, spdx in licenses.LICENSES:
        texts += [f"spdx license identifier {t}" for t in expanded(re._parser.parse(spdx))]
        for own in dict.fromkeys(expanded(re._parser.parse(name))):
            texts += [own, f"licensed under {own}"]
    gated = [licenses.scan(t.encode()) for t in texts]
    every = tuple(range(len(licenses.rules())))
    words = {w.encode() for t in texts for w in t.split()}
    monkeypatch.setattr(licenses, "gates", lambda: (frozenset(words), dict.fromkeys(words, every)))
    wrong = [t for t, own in zip(texts, gated) if licenses.scan(t.encode()) != own]
    assert len(texts) > 2_000 and not wrong, wrong[:20]


@pytest.mark.parametrize(
    ("text", "label"),
    [("LGPLv3", "lgpl-3.0"), ("AGPLv3", "agpl-3.0"), ("GPL2", "gpl-2.0"), ("MPLv2", "mpl-2.0"), ("EPL2", "epl-2.0"), ("Apache2", "apache-2.0")]
    + [("ASLv2", "apache-2.0"), ("GPLv1", "gpl-1.0"), ("PSF license", "psf"), ("Public Domain Dedication and License", "pddl")],
)
def test_glued_versions_open_the_gate(text, label):
    assert [k[1] for k in licenses.scan(text.encode())[2]] == [label]


def test_containment_suppression_matches_a_plain_version():
    rng = np.random.default_rng(1)
    for _ in range(200):
        found = [(int(p), int(s), int(s + n), i) for i, (p, s, n) in enumerate(zip(rng.integers(0, 4, 30), rng.integers(0, 40, 30), rng.integers(1, 9, 30)))]
        kept = []
        for hit in sorted(found, key=lambda f: (f[0], f[1], -f[2], f[3])):
            if not any(k[1] <= hit[1] and hit[2] <= k[2] for k in kept):
                kept.append(hit)
        assert sorted(licenses.resolve(found)) == sorted(kept)


# --- fingerprints ---
def test_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("ABC"), rng.integers(0, 70))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert piecewise_hash.distance(a, b) == row[-1]


def test_fingerprints_tell_copies_from_others():
    for seed in range(20):
        words = prose(seed, 600).split()
        text, other = " ".join(words), prose(seed + 100, 600)
        for at in (50, 300, 500):
            words[at] = "changed"
        mark = piecewise_hash.fingerprint(text.encode())
        assert piecewise_hash.likeness(mark, piecewise_hash.fingerprint(" ".join(words).encode())) > 0.75
        assert piecewise_hash.likeness(mark, piecewise_hash.fingerprint(other.encode())) < 0.2
    assert piecewise_hash.fingerprint(b"") == "3::"
    assert max(map(len, piecewise_hash.fingerprint(b"ab" * 100_000).split(":"))) <= piecewise_hash.MOST


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours_across_partitions(spark, parts):
    texts = [(i, prose(i, i % 40) + "é" * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.doc_id: r for r in piecewise_hash.compare_neighbours(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 300
    for i, text in texts:
        after = texts[i - 1][1]  # descending ids; after the last the first
        half = len(text) // 2
        changed = (text[: len(text) - half] + after[:half]).encode()
        row = found[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed).hexdigest())
        assert row.fingerprint == piecewise_hash.fingerprint(text.encode())
        assert row.edited_fingerprint == piecewise_hash.fingerprint(changed)
        assert row.near_next == piecewise_hash.likeness(row.fingerprint, piecewise_hash.fingerprint(after.encode()))


def test_neighbour_edge_cases(spark):
    docs = awkward(spark)
    found = piecewise_hash.compare_neighbours(docs)
    assert found.count() == docs.count()
    assert piecewise_hash.compare_neighbours(empty(spark)).collect() == []
    single = docs.where("doc_id = 7")
    row = piecewise_hash.compare_neighbours(single).first()
    assert row.near_next == 1.0
    assert rows_of(piecewise_hash.fingerprints(docs)) == rows_of(found.select("doc_id", "fingerprint"))


# --- mixing ---
def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [1, 2, 3]) == [5.0, 10.0, 15.0]
    target = mixing.water_fill([100, 1, 1], [1, 2, 3])
    assert target[1:] == [3.0, 3.0] and target[0] == 96.0
    assert mixing.water_fill([0, 0], [1, 2]) == [0.0, 0.0] and mixing.water_fill([], []) == []


@pytest.mark.parametrize("size", [1, 2, 3, 17, 256, 1000])
def test_permutations(size):
    for key in (0, 5, 1 << 42):
        assert sorted(mixing.permuted(np.arange(size), size, key).tolist()) == list(range(size))


def test_shard_counts_add_up():
    slots, depth = np.asarray([0, 5, 1000, 123456]), 5
    parts = [mixing.shard_counts(slots, s, depth, 7) for s in range(1 << depth)]
    assert np.array_equal(sum(c for c, _ in parts), slots)
    running = np.zeros(4, np.int64)
    for count, before in parts:
        assert np.array_equal(before, running)
        running += count


def test_mixture_meets_its_targets(spark):
    rows = [(i, prose(i, 20 + i % 300), f"s{i % 4 if i % 3 else 0}" if i % 50 else None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixture(docs).collect()
    assert sorted(r.doc_id for r in found) == list(range(600))
    source = {i: s for i, _, s in rows}
    totals, taken = Counter(), Counter()
    for r in found:
        assert r.size == 20 + r.doc_id % 300 and r.taken <= 3 * r.size
        totals[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    assert all(totals[source[r.doc_id]] == r.source_size for r in found)
    names = sorted(n for n in totals if n is not None) + [None]
    want = mixing.water_fill([totals[n] for n in names], [1, 2, 3, 1, 2][: len(names)])
    target = {source[r.doc_id]: r.target for r in found}
    assert [target[n] for n in names] == pytest.approx(want)
    assert all(abs(taken[n] - target[n]) <= 200 for n in names)
    assert rows_of(mixing.mixture(docs)) == rows_of(mixing.mixture(docs.repartition(7)))


def test_mixed_documents_hold_the_taken_words(spark):
    docs = awkward(spark)
    taken = defaultdict(int)
    for r in mixing.mixture(docs).collect():
        taken[r.doc_id] += r.taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    texts = {r.text for r in docs.collect()}
    for r in mixed.collect():
        got[r.doc_id] += len(r.text.encode().split())
        assert r.n_chars == len(r.text) and r["_id"] == "clash"
        assert any(r.text.split("\n")[0] in t for t in texts if t)
    assert got == {k: v for k, v in taken.items() if v}
    assert mixing.mixed_documents(empty(spark)).collect() == [] and mixing.mixture(empty(spark)).collect() == []


# --- exact dedup ---
def plain_copies(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append(r)
    return groups


def test_exact_copies(spark):
    docs = awkward(spark)
    found = exact_dedup.find_copies(docs).collect()
    groups = plain_copies(docs.collect())
    want = Counter()
    for text, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r.text or ""), r.doc_id is not None, r.doc_id or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        for r in rows:
            want[r.doc_id, best.doc_id, len(rows), digest] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.find_copies(empty(spark)).collect() == [] and exact_dedup.drop_copies(empty(spark)).collect() == []


@pytest.mark.parametrize("fan_in", [2, 8])
def test_rounds_merge_many_runs(spark, fan_in):
    docs = spark.createDataFrame([(i, f"t{i % 37}") for i in range(2_000)], "doc_id long, text string").repartition(23)
    merged = exact_dedup.merge_runs(exact_dedup.digests(docs), fan_in).collect()
    assert len(merged) == 37 and sum(r["_copies"] for r in merged) == 2_000
    assert sorted(r["_best"]["id"] for r in merged) == sorted(min(i for i in range(2_000) if i % 37 == k) for k in range(37))


def test_exact_dedup_runs_no_python(spark):
    plan = exact_dedup.find_copies(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
