"""Encoding with the tokenizers library, piece by piece.

A text is cut at ASCII white space. The supported tokenizers drop white space and never merge,
normalise or match special strings across it, so the ids of a text are the ids of its pieces in a
row (``safe`` checks the settings this rests on). Equal pieces are encoded once per worker, which
is most of the gain on prose, and a very long text never goes to the library in one call.

Most calls of the library are for rare words, and cost more than the words in them. Where the tokenizer's words are those of
``WORDS``, the last punctuation of a piece is encoded apart from what it follows, and words of plain letters go to the library
many in a text; the end-of-word mark of their last token tells them apart again.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

#: Entries of the per-worker memory of encoded pieces; beyond it the memory starts afresh.
REMEMBERED = 1_500_000
#: Longer pieces are encoded but not remembered.
LONG_PIECE = 64
#: Pieces given to the library in one call.
CALL = 20_000
#: Words of plain letters in one text of a call.
JOINED = 100
#: Words between which nothing merges: letters never stand in one word with the punctuation after them.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: ASCII punctuation without the apostrophe, which may begin a word of letters.
CLOSING = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
#: Letters of ASCII and Latin-1.
_LETTER = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_PLAIN = re.compile(_LETTER + rb"+")

_ENCODERS: dict[str, "PieceEncoder"] = {}


def safe(settings: dict) -> bool:
    """Whether white space separates pieces for good: it is folded, dropped and part of no special string."""
    before = settings.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    first = steps[0] if steps else {}
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    prefix = any(s.get("add_prefix_space") for s in steps)
    folding = settings.get("normalizer") or {}
    known = {"NFC", "Lowercase", "Replace"}
    kinds = {n["type"] for n in folding.get("normalizers", [folding] if folding else [])}
    tokens = settings.get("added_tokens", [])
    plain = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not t["normalized"] for t in tokens)
    blank = any(c.isspace() for t in tokens for c in t["content"])
    return drops and not prefix and kinds <= known and plain and not blank


class PieceEncoder:
    """Ids of pieces as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.splits = safe(settings)
        self.lowers = "Lowercase" in json.dumps(settings.get("normalizer"))
        self.special = [t["content"].encode().lower() for t in settings.get("added_tokens", [])]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.closes = self._word_ends(settings) if self.splits else None

    def _word_ends(self, settings: dict) -> np.ndarray | None:
        """Whether each id ends a word; None for a tokenizer with other words than ``WORDS`` or without a mark at their end."""
        steps = settings["pre_tokenizer"].get("pretokenizers", [settings["pre_tokenizer"]])
        suffix = settings["model"].get("end_of_word_suffix")
        rest = all(s["type"] == "ByteLevel" and not s.get("use_regex", True) for s in steps[1:])
        if not suffix or not rest or steps[0]["pattern"] != {"Regex": WORDS}:
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in settings["model"]["vocab"].items():
            ends[number] = token.endswith(suffix)
        return ends

    def _call(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _bare(self, piece: bytes) -> bytes:
        """A piece without its last punctuation; the whole piece where that may be part of a word or a special string."""
        stem = piece.rstrip(CLOSING)
        if not (stem[-1:].isalnum() or _PLAIN.fullmatch(stem[-2:])):
            return piece
        small = piece.lower()
        for special in self.special:
            if special in small:
                return piece
        return stem

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of plain letters, ``JOINED`` words in a text."""
        runs = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        out = []
        for run, ids in zip(runs, self._call([b" ".join(r) for r in runs])):
            ends = 4 * (np.flatnonzero(self.closes[np.frombuffer(ids, "<u4")]) + 1)
            if len(ends) != len(run) or ends[-1] != len(ids):
                out += self._call(run)
                continue
            ends = ends.tolist()
            out += [ids[a:b] for a, b in zip([0, *ends], ends)]
        return out

    def _encoded(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each piece with its ids."""
        if self.closes is None:
            return zip(pieces, self._call(pieces))
        bare = [self._bare(p) if p[-1] in CLOSING else p for p in pieces]
        tails = [p[len(b) :] for p, b in zip(pieces, bare)]
        new = {*bare, *tails}.difference(self.known)
        plain = list(filter(_PLAIN.fullmatch, new))
        other = list(new.difference(plain))
        found = dict(zip(plain + other, self._plain(plain) + self._call(other)))
        stems, ends = ([found[p] if p in found else self.known[p] for p in parts] for parts in (bare, tails))
        return zip(pieces, map(bytes.__add__, stems, ends))

    def _cut(self, text: bytes) -> list[bytes]:
        """Pieces of a text; a tokenizer that lower-cases gets ASCII letters lower-cased, so more pieces are equal.

        Not where a special string may stand, nor beside combining marks (U+0300 to U+037F), which
        compose with some small letters but not with their capitals.
        """
        if self.lowers and b"\xcc" not in text and b"\xcd" not in text:
            small = text.lower()
            if not any(s in small for s in self.special):
                return small.split()
        return text.split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each UTF-8 text."""
        if not self.splits:
            return self._call(texts)
        if len(self.known) > REMEMBERED:
            self.known = {}
        cut = [self._cut(t) for t in texts]
        known, extra = self.known, {}
        new = list(set().union(*cut).difference(known))
        for i in range(0, len(new), CALL):
            part = new[i : i + CALL]
            for piece, ids in self._encoded(part):
                (known if len(piece) <= LONG_PIECE else extra)[piece] = ids
        if not extra:
            return [b"".join(map(known.__getitem__, c)) for c in cut]
        return [b"".join([known[p] if p in known else extra[p] for p in c]) for c in cut]


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
