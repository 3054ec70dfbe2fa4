"""Byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern and every match is merged on its own. A segment tree
over the byte positions of a match keeps, for each live position, the rank of the pair that it
forms with its live right neighbour; the root is the leftmost pair of minimum rank. A merge is
three point updates (the position, its left neighbour, the neighbour it swallows), logarithmic in
the length. Short matches run through one numpy tree with a row per match, long ones through a
scalar tree. Equal matches are encoded once per worker.

Ids are packed as little-endian unsigned 32-bit integers in a binary column.

Defined results: null and empty texts give no ids and decode to no bytes; repeated rows are encoded
row by row; an empty table gives an empty result; other columns are ignored unless kept by name, and a
column named like a result gives way to it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType

from cartlens.llm.common import byte_slices, fields, fresh, ship, strings

BATCH_BYTES = 1 << 20
#: Entries of the per-worker memory of encoded matches; beyond it the memory starts afresh.
REMEMBERED = 100_000
#: Matches up to this many bytes go through the row-wise tree and are remembered.
SHORT = 64
#: Matches of a text that are held at a time.
MATCHES = 100_000
NONE = np.int64(1) << 62

_CODECS: dict[tuple[str, str], "Codec"] = {}


class Codec:
    """Ranks of one vocabulary: rank files of base64 tokens, ids equal ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file) if r}
        self.vocabulary = {r: t for t, r in self.ranks.items()}
        self.find = regex.compile(pattern).finditer
        self.byte_ids = np.asarray([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.keys = np.asarray(sorted(pairs), np.int64)
        self.values = np.asarray([pairs[k] for k in self.keys.tolist()], np.int64)
        self.known: dict[str, bytes] = {}

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where they do not merge; a negative id has no pair."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.values[at], NONE)

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of matches of up to SHORT bytes, all merged side by side."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.asarray([len(w) for w in words])
        width = 2
        while width <= SHORT:
            members = np.flatnonzero((sizes > width // 2) & (sizes <= width) | (sizes == 1) & (width == 2))
            if len(members):
                for i, ids in zip(members.tolist(), self._merge_width([words[i] for i in members.tolist()], width)):
                    out[i] = ids
            width *= 2
        return out

    def _merge_width(self, words: list[bytes], width: int) -> list[bytes]:
        n, sizes = len(words), np.asarray([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        place = np.arange(width)
        ids = np.full((n, width + 2), -1, np.int64)  # two columns beyond the end stand for "no neighbour"
        ids[:, :width] = np.where(place < sizes[:, None], self.byte_ids[raw], -1)
        after = np.tile(np.arange(1, width + 3), (n, 1))
        before = np.tile(np.arange(-1, width + 1), (n, 1))
        end = width + 1
        after[:, width:] = end
        # A node holds rank * width + position: its minimum is the leftmost pair of minimum rank.
        tree = np.full((n, 2 * width), NONE, np.int64)
        first = self._pair_ranks(ids[:, :width].ravel(), ids[:, 1 : width + 1].ravel()).reshape(n, width)
        tree[:, width:] = np.where(first < NONE, first * width + place, NONE)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def put(rows: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = np.where(rank < NONE, rank * width + at, NONE)
            while width > 1 and node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = tree[rows, 1]
            at, rank = best % width, best // width
            gone = after[rows, at]
            beyond = after[rows, gone]
            ids[rows, at] = rank
            ids[rows, gone] = -1
            after[rows, at] = beyond
            before[rows, beyond] = at
            put(rows, gone, np.full(len(rows), NONE))
            put(rows, at, self._pair_ranks(rank, ids[rows, beyond]))
            left = before[rows, at]
            has = left >= 0
            if has.any():
                some, left = rows[has], left[has]
                put(some, left, self._pair_ranks(ids[some, left], rank[has]))
            rows = rows[tree[rows, 1] < NONE]
        live = ids >= 0
        packed = ids[live].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(live.sum(axis=1))]).tolist()
        return [packed[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]

    def merge_long(self, word: bytes) -> bytes:
        """Packed ids of one match of any length, by a scalar tree."""
        n, width, none = len(word), 1, int(NONE)
        while width < n:
            width *= 2
        ids = [*self.byte_ids[np.frombuffer(word, np.uint8)].tolist(), -1]
        after, before, pairs = list(range(1, n + 1)) + [n], list(range(-1, n)), self.pairs
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            node >>= 1
            while node:
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    return
                tree[node] = value
                node >>= 1

        while n > 1 and tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            beyond = after[gone]
            ids[at], ids[gone], after[at] = rank, -1, beyond
            put(gone, none)
            joined = None
            if beyond < n:
                before[beyond] = at
                joined = pairs.get(rank << 32 | ids[beyond])
            put(at, none if joined is None else joined * width + at)
            left = before[at]
            if left >= 0:
                joined = pairs.get(ids[left] << 32 | rank)
                put(left, none if joined is None else joined * width + left)
        return np.asarray([i for i in ids if i >= 0], "<u4").tobytes()

    def _learn(self, matches: set[str]) -> dict[str, bytes]:
        """Encode matches that are not known yet; returns the long ones, which are not remembered."""
        new = list(matches.difference(self.known))
        coded = [m.encode("utf-8") for m in new]
        short = [i for i, c in enumerate(coded) if len(c) <= SHORT]
        for i, ids in zip(short, self.merge_rows([coded[i] for i in short])):
            self.known[new[i]] = ids
        return {m: self.merge_long(c) for m, c in zip(new, coded) if len(c) > SHORT}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, done, held = self.known, [[] for _ in texts], []
        room = MATCHES

        def flush() -> None:
            extra = self._learn(set().union(*(part for _, part in held)))
            for i, part in held:
                if extra:
                    done[i].append(b"".join([known[m] if m in known else extra[m] for m in part]))
                else:
                    done[i].append(b"".join(map(known.__getitem__, part)))
            held.clear()

        for i, text in enumerate(texts):
            found = (m[0] for m in self.find(text))
            while part := list(islice(found, room)):
                held.append((i, part))
                room -= len(part)
                if not room:
                    flush()
                    room = MATCHES
        flush()
        return [b"".join(parts) for parts in done]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a vocabulary."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """The kept columns and ``ids``, the packed ids of the text; no shuffle."""
    ship(docs.sparkSession)
    keep = [c for c in keep if c != "ids"]
    (source,) = fresh(keep, "_text")
    schema = fields(docs, keep, [("ids", BinaryType())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm.byte_bpe import codec

        own = codec(ranks_path, pattern)
        for batch in batches:
            for run in byte_slices(batch, source, BATCH_BYTES):
                ids = pa.array(own.encode(strings(run, source)), pa.binary())
                yield pa.RecordBatch.from_arrays([*(run.column(i) for i in range(len(keep))), ids], names=schema.names)

    return docs.select(*keep, F.col(text_col).alias(source)).mapInArrow(encoded, schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Add ``decoded``, the bytes that the packed ``ids`` stand for."""
    ship(encoded.sparkSession)
    encoded = encoded.drop("decoded")
    schema = fields(encoded, encoded.columns, [("decoded", BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm.byte_bpe import codec

        own = codec(ranks_path, pattern)
        for batch in batches:
            for run in byte_slices(batch, "ids", BATCH_BYTES):
                texts = pa.array([own.decode(x) for x in run.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*run.columns, texts], names=schema.names)

    return encoded.mapInArrow(decoded, schema)
