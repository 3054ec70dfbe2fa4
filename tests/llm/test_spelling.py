"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cartlens.llm import spelling
from tests.llm.cases import awkward, empty, rows_of


def plain_words(rows) -> Counter:
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= 6 and n >= 5})


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows) -> list[tuple]:
    words = plain_words(rows)
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    best = {w: min(o, key=lambda x: (-words[x], x)) for w, o in near.items() if o}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()), key=repr)


def mutated(rng, word: str) -> str:
    i, c = rng.randrange(len(word)), rng.choice("abcdéÉ")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word + c, c + word])


def texts(seed: int, stems: int = 12, variants: int = 40, docs: int = 30) -> list[tuple]:
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(6, 14))) for _ in range(stems)]
    for _ in range(variants):
        pool.append(mutated(rng, rng.choice(pool)))
    weights = [rng.choice([1, 1, 5, 30, 200]) for _ in pool]
    return [(i, " ".join(w.title() if rng.random() < 0.2 else w for w in rng.choices(pool, weights, k=200)) + ", x1") for i in range(docs)]


@pytest.mark.parametrize("limits", [{}, {"group": 2}, {"longest": 2, "block": 5}, {"group": 3, "longest": 4, "block": 1}])
def test_variants_equal_all_pairs(spark, limits):
    given = texts(5)
    docs = spark.createDataFrame(given, "doc_id long, text string")
    expected = plain_variants(given)
    assert any(r[1] for r in expected) and any(r[4] > 2 for r in expected)
    assert rows_of(spelling.variants(docs, **limits)) == expected


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_exactly_one_edit(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abÿ") for _ in range(rng.randrange(1, 7))) for _ in range(150)})
    groups = np.asarray([rng.randrange(3) for _ in words])
    groups = np.unique(groups, return_inverse=True)[1]
    a, b = spelling.one_edit_apart(words, groups)
    expected = {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if groups[i] == groups[j] and one_edit(x, y)}
    assert set(zip(a.tolist(), b.tolist())) == expected and len(a) == len(expected)


def test_every_near_pair_shares_a_group(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(6, 10))) for _ in range(150)} | {"a" * n for n in (6, 7, 40, 41, 100, 101)}
    frame = spark.createDataFrame(list(enumerate(sorted(words))), "_v long, word string")
    word = dict(enumerate(sorted(words)))
    expected = {(i, j) for i, x in word.items() for j, y in word.items() if one_edit(x, y)}
    for group in (1, 8, 4096):
        assert set(rows_of(spelling.near_words(frame, group=group))) == expected


def test_roots_follow_chains(spark):
    counts = {"abcdefgh": 700, "abcdefg": 110, "abcdef": 20, "xyzxyz": 6}
    given = [(0, " ".join(w for w, n in counts.items() for _ in range(n)))]
    found = {r[0]: r[1:] for r in rows_of(spelling.variants(spark.createDataFrame(given, "doc_id long, text string")))}
    assert found == {r[0]: r[1:] for r in plain_variants(given)}
    assert found["abcdef"][:2] == ("abcdefg", "abcdefgh")


def test_windows_do_not_change_words():
    text = ("Wörterbuch, " * 50 + "q" * 400 + " x Ärger").encode()
    whole = Counter(w for part in spelling.runs_by_window(text) for w in part)
    assert whole == Counter(w for part in spelling.runs_by_window(text, 9) for w in part)
    assert whole["q" * 400] == 1 and whole["wörterbuch"] == 50


def test_awkward_rows(spark):
    docs = awkward(spark).unionByName(awkward(spark)).unionByName(awkward(spark))
    given = [(r.doc_id, r.text) for r in docs.collect()]
    found = rows_of(spelling.variants(docs))
    assert found == plain_variants(given)
    long_word = spark.createDataFrame([(i, "ab" * 50_000 + "c" * (i % 2)) for i in range(12)], "doc_id long, text string")
    assert len(rows_of(spelling.variants(long_word))) == 2
    assert rows_of(spelling.variants(empty(spark))) == []
