"""Fingerprints against a plain version, components against all pairs."""

import random
import re

import pytest
import xxhash

from cartlens.llm import simhash
from cartlens.llm.near_dedup import components
from tests.llm.cases import awkward, empty, prose, rows_of


def plain_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values: list[int]) -> dict[int, int]:
    """Smallest index that each value reaches."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if label[j] < label[i] and (a ^ b).bit_count() <= 3:
                    label[i], changed = label[j], True
    return {v: label[i] for i, v in enumerate(values)}


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "ÀB c À d \x0b e", prose(3, 500), "Same " * 900])
@pytest.mark.parametrize("window", [7, 1 << 18])
def test_fingerprint_is_the_plain_one(text, window):
    assert simhash.fingerprint((text or "").encode(), window) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text_does_not_depend_on_windows():
    data = (prose(1, 200_000, 50_000) + " " + "x" * 3_000_000).encode()
    assert simhash.fingerprint(data) == simhash.fingerprint(data, 1 << 40)


@pytest.mark.parametrize("matches", [0, 2, 256])
def test_components_equal_all_pairs(spark, matches):
    rng = random.Random(matches)
    values = {rng.getrandbits(64) for _ in range(40)}
    base = rng.getrandbits(64)
    for center in (base, base ^ (0x1F << 5), base ^ (0x1F << 40), rng.getrandbits(64)):  # near copies, dense in one half or both
        for _ in range(60):
            near = center
            for _ in range(rng.randrange(6)):
                near ^= 1 << rng.choice([rng.randrange(64), rng.randrange(6), 32 + rng.randrange(6)])
            values.add(near)
    values = sorted(values, key=signed)
    expected = plain_components(values)
    frame = spark.createDataFrame([(signed(v),) for v in values], "_f long")
    links = simhash.links(frame, matches)
    assert links.where("bit_count(_a ^ _b) > 3 or _a = _b").isEmpty()
    found = dict(rows_of(components(links)))
    assert {signed(v): found.get(signed(v), signed(v)) for v in values} == {signed(v): signed(values[i]) for v, i in expected.items()}


def test_one_dense_group_makes_rows_in_proportion(spark):
    """2,000 fingerprints that share a half: pairs would be two million."""
    values = [(v << 32 | 7,) for v in range(2_000)]
    links = simhash.links(spark.createDataFrame(values, "_f long"), 100)
    assert links.count() <= 1_100 * len(values) / 10
    assert {c for _, c in rows_of(components(links))} == {7}


def test_documents(spark):
    texts = [prose(1, 300), prose(1, 300).upper().replace("W", "w"), prose(2, 300), "", None, "  ", prose(2, 300) + "!"]
    docs = spark.createDataFrame([(10 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    prints = {10 - i: plain_fingerprint(t) for i, t in enumerate(texts)}
    distinct = sorted(set(prints.values()))
    label = plain_components(distinct)
    least = {c: min(i for i, f in prints.items() if label[f] == c) for c in label.values()}
    expected = sorted(((i, f"{f:016x}", least[label[f]]) for i, f in prints.items()), key=repr)
    assert rows_of(simhash.link_fingerprints(docs)) == expected


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = rows_of(simhash.link_fingerprints(docs))
    assert len(rows) == docs.count()
    blank = [r for r in rows if r[1] == "0" * 16]
    assert len(blank) == 4 and {r[2] for r in blank} == {1}  # null and empty texts, one with a null id
    assert len([r for r in rows if r[0] == 6]) == 3
    assert rows_of(simhash.link_fingerprints(empty(spark))) == []


def test_probes_are_not_broadcast(spark, capsys, tmp_path):
    """Probes are 33 rows a fingerprint, which the driver must not gather however small their estimate is."""
    spark.createDataFrame([(i * 7919,) for i in range(200)], "_f long").write.parquet(f"{tmp_path}/distinct")
    simhash.links(spark.read.parquet(f"{tmp_path}/distinct")).explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out
