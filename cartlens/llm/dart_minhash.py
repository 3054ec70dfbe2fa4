"""DartMinHash signatures of weighted word shingles.

The elements of a text are its runs of ``SHINGLE`` words, weighted by their number. For every element
the plane of weight and rank is cut into regions whose sides double; a region's seed gives the
number of darts in it (Poisson with the region's area), and every dart its weight, rank and coordinate. A
text hits the darts below its elements' weights. Each coordinate of the signature keeps the hit of the
lowest rank, so two texts agree in a coordinate with the probability of their weighted Jaccard
similarity. Only ranks below ``darts / total weight`` are thrown, about ``k ln k + 2k`` hits whatever
the length; a text with an empty coordinate throws again with twice the ranks.

All texts of a batch are handled side by side in numpy.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from cartlens.llm.common import Powers

SHINGLE = 5
COORDINATES = 96
BAND = 4
#: Side of the lowest rank region.
FIRST_RANK = 0.25
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_powers = Powers(_BASE)
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def word_stream(text: str) -> bytes:
    """Lower-case words (runs of ASCII letters and digits and of any other character) joined by spaces."""
    return b" ".join(text.lower().encode("utf-8").translate(_WORD_BYTES).split())


def shingles(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, and how many each text has: words - 4, or 1 for one to four words."""
    sizes = np.asarray([len(s) for s in streams], np.int64)
    data = np.frombuffer(b"".join([b" ".join(streams), b" "]), np.uint8)
    n = len(data)
    blank = data == 32
    with np.errstate(over="ignore"):
        powers, inverse = _powers(n)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * powers[:n], out=prefix[1:])
        edges = np.diff(np.concatenate([[True], blank]).astype(np.int8))
        first, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        word = mixed((prefix[end] - prefix[first]) * inverse[first])
        if not len(word):
            return word, np.zeros(len(streams), np.int64)
        text_start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        owner = np.searchsorted(text_start, first, "right") - 1
        words = np.bincount(owner, minlength=len(streams))
        counts = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
        begin = np.concatenate([[0], np.cumsum(words)])[:-1]
        text = np.repeat(np.arange(len(streams)), counts)
        at = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = begin[text] + at
        out = np.zeros(len(text), np.uint64)
        for k in range(SHINGLE):
            there = at + k < words[text]
            out = out * np.uint64(_BASE) + np.where(there, word[np.where(there, place + k, 0)], np.uint64(0))
        return mixed(out), counts


def elements(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with its number, and the number of shingles of each text."""
    hashes, counts = shingles(streams)
    text = np.repeat(np.arange(len(streams)), counts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    number = np.diff(np.append(starts, len(hashes)))
    return text[starts], hashes[starts], number, counts


def occurrences(streams: list[bytes]) -> list[np.ndarray]:
    """32-bit codes of the shingle occurrences of each text: the n-th of equal shingles has a code of its own.

    The Jaccard similarity of two such sets is the weighted similarity of the texts.
    """
    text, hashes, number, counts = elements(streams)
    with np.errstate(over="ignore"):
        rows = np.repeat(np.arange(len(hashes)), number)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(number) - number, number)
        codes = (mixed(hashes[rows] + nth.astype(np.uint64) * _GOLDEN) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return np.split(codes, np.cumsum(counts)[:-1])


@lru_cache(maxsize=512)
def _poisson(area: float) -> np.ndarray:
    """Distribution function of the number of darts in a region."""
    top = int(area + 12 * np.sqrt(area) + 30)
    steps = np.log(area) - np.log(np.arange(1, top + 1))
    return np.cumsum(np.exp(-area + np.concatenate([[0], np.cumsum(steps)])))


def _thrown(text: np.ndarray, hashes: np.ndarray, number: np.ndarray, limit: np.ndarray, k: int) -> list[np.ndarray]:
    """Darts that texts hit: text, coordinate, rank, identity. ``limit``: ranks thrown for each text."""
    found = []
    heaviest = int(number.max(initial=0))
    low, side, level = 0.0, 1.0, 0
    while low < heaviest:  # regions of weight [0, 1), [1, 2), [2, 4), ...
        deep = np.flatnonzero(number > low)
        bottom, height, band = 0.0, FIRST_RANK, 0
        while True:  # regions of rank
            own = deep[limit[text[deep]] > bottom]
            if not len(own):
                break
            seed = mixed(hashes[own] + np.uint64((level << 8 | band) + 1) * _GOLDEN)
            darts = np.searchsorted(_poisson(side * height), _unit(seed), "right")
            rows = np.repeat(own, darts)
            if len(rows):
                nth = np.arange(len(rows)) - np.repeat(np.cumsum(darts) - darts, darts)
                identity = mixed(np.repeat(seed, darts) + (nth.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
                rank = bottom + height * _unit(identity)
                spot = mixed(identity ^ _GOLDEN)
                hit = (rank < limit[text[rows]]) & (low + side * _unit(spot) < number[rows])
                rows, identity, rank, spot = rows[hit], identity[hit], rank[hit], spot[hit]
                coordinate = (mixed(spot + _GOLDEN) % np.uint64(k)).astype(np.int64)
                found.append((text[rows], coordinate, rank, identity))
            bottom, height, band = bottom + height, bottom + height, band + 1
        low, side, level = low + side, low + side, level + 1
    return [np.concatenate(part) for part in zip(*found)] if found else [np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.uint64)]


def signatures(streams: list[bytes], k: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """Signature rows (texts x k) and the number of shingles of each text; texts without any have zeros."""
    text, hashes, number, counts = elements(streams)
    out = np.zeros((len(streams), k), np.uint64)
    limit = np.where(counts > 0, (k * np.log(k) + 2 * k) / np.maximum(counts, 1), 0.0)
    with np.errstate(over="ignore"):
        while len(text):
            owner, coordinate, rank, identity = _thrown(text, hashes, number, limit, k)
            slot = owner * k + coordinate
            order = np.lexsort((identity, rank, slot))
            slot, identity = slot[order], identity[order]
            first = np.ones(len(slot), bool)
            first[1:] = slot[1:] != slot[:-1]
            slot, identity = slot[first], identity[first]
            filled = np.bincount(slot // k, minlength=len(streams))
            done = filled[slot // k] == k
            out.reshape(-1)[slot[done]] = identity[done]
            again = filled[text] < k
            text, hashes, number = text[again], hashes[again], number[again]
            limit = limit * 2
    return out, counts


def bands(signature: np.ndarray, rows: int = BAND) -> np.ndarray:
    """One 64-bit key per run of ``rows`` coordinates and text, with the band's number mixed in."""
    n, k = signature.shape
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(k // rows, dtype=np.uint64) + np.uint64(1), (n, 1))
        for r in range(rows):
            key = mixed(key * np.uint64(_BASE) + signature[:, r : k // rows * rows : rows])
    return key.view(np.int64)
