"""License scans: ordered signature rules with a keyword gate and containment suppression.

A text is reduced to its words (ASCII letters lower-cased), joined by single spaces; every rule is a
regular expression over that stream and every detection an interval of words. Rules carry a gate:
words that each match must hold. Only rules whose gate words occur in the text are run, which for
most texts is none. Detections are resolved by priority: one whose interval lies inside a detection
of a stronger or equal class is suppressed, so "licensed under the apache license version 2 0" is
one statement and not also a bare title.

The base phrases are places of fixed words; they are counted always and never suppressed. The rules
add labels of their own.

Defined results: null and empty texts have no words, no labels and score 0; very long texts are
scanned whole; repeated rows are scanned row by row; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from cartlens.llm.common import byte_slices, fields, ship, utf8

BATCH_BYTES = 1 << 20

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, words every match holds (alternatives by |; before a version also glued to it, as "lgplv3" and
# "lgpl3"), name as a pattern over words, SPDX words.
LICENSES = [
    ("agpl-3.0", "affero|agpl", r"(?:gnu )?(?:affero general public licen[sc]e|agpl)(?: v(?:ersion)?)? ?v?3(?: 0)?", r"agpl 3 0"),
    ("agpl", "affero|agpl", r"(?:gnu )?(?:affero general public licen[sc]e|agpl)", r"agpl"),
    ("lgpl-2.1", "lesser|lgpl", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl)(?: v(?:ersion)?)? ?v?2 1", r"lgpl 2 1"),
    ("lgpl-3.0", "lesser|lgpl", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl)(?: v(?:ersion)?)? ?v?3(?: 0)?", r"lgpl 3 0"),
    ("lgpl-2.0", "library|lgpl", r"(?:gnu )?(?:library general public licen[sc]e|lgpl)(?: v(?:ersion)?)? ?v?2(?: 0)?", r"lgpl 2 0"),
    ("lgpl", "lesser|lgpl", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl)", r"lgpl"),
    ("gpl-1.0", "general|gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)(?: v(?:ersion)?)? ?v?1(?: 0)?", r"gpl 1 0"),
    ("gpl-2.0", "general|gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)(?: v(?:ersion)?)? ?v?2(?: 0)?|gplv2", r"gpl 2 0"),
    ("gpl-3.0", "general|gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)(?: v(?:ersion)?)? ?v?3(?: 0)?|gplv3", r"gpl 3 0"),
    ("gpl", "general|gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)", r"gpl"),
    ("gfdl", "documentation|gfdl", r"(?:gnu )?(?:free documentation licen[sc]e|gfdl)", r"gfdl"),
    ("apache-1.0", "apache", r"apache(?: software)? licen[sc]e(?: v(?:ersion)?)? ?v?1 0", r"apache 1 0"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e(?: v(?:ersion)?)? ?v?1 1", r"apache 1 1"),
    ("apache-2.0", "apache|asl", r"(?:apache(?: software)? licen[sc]e|asl|apache)(?: v(?:ersion)?)? ?v?2(?: 0)?", r"apache 2 0"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", r"apache"),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?", r"mit 0"),
    ("mit", "mit|expat", r"(?:mit|expat) licen[sc]e", r"mit"),
    ("x11", "x11", r"x11 licen[sc]e", r"x11"),
    ("isc", "isc", r"isc licen[sc]e", r"isc"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[sc]e)?", r"bsd 4 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?", r"bsd 3 clause"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[sc]e)?", r"bsd 2 clause"),
    ("0bsd", "0bsd|bsd", r"(?:0bsd|zero clause bsd)(?: licen[sc]e)?", r"0bsd"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", r"bsd"),
    ("mpl-1.1", "mozilla|mpl", r"(?:mozilla public licen[sc]e|mpl)(?: v(?:ersion)?)? ?v?1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla|mpl", r"(?:mozilla public licen[sc]e|mpl)(?: v(?:ersion)?)? ?v?2(?: 0)?", r"mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", r"mpl"),
    ("epl-1.0", "eclipse|epl", r"(?:eclipse public licen[sc]e|epl)(?: v(?:ersion)?)? ?v?1(?: 0)?", r"epl 1 0"),
    ("epl-2.0", "eclipse|epl", r"(?:eclipse public licen[sc]e|epl)(?: v(?:ersion)?)? ?v?2(?: 0)?", r"epl 2 0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", r"epl"),
    ("eupl", "union|eupl", r"(?:european union public licen[sc]e|eupl)(?: 1 [012])?", r"eupl 1 [012]"),
    ("cddl", "cddl|distribution", r"(?:common development and distribution licen[sc]e|cddl)(?: 1 [01])?", r"cddl 1 [01]"),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: v(?:ersion)?)?(?: 1 0)?", r"cpl 1 0"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e 1 0", r"artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e(?: v(?:ersion)?)? 2 0", r"artistic 2 0"),
    ("artistic", "artistic", r"artistic licen[sc]e", r"artistic"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", r"zlib"),
    ("bsl-1.0", "boost|bsl", r"(?:boost software licen[sc]e|bsl)(?: v(?:ersion)?)?(?: 1 0)?", r"bsl 1 0"),
    ("busl-1.1", "business", r"business source licen[sc]e(?: 1 1)?", r"busl 1 1"),
    ("psf", "python|psf", r"python software foundation licen[sc]e|psf licen[sc]e", r"psf 2 0|python 2 0"),
    ("ofl-1.1", "sil|ofl", r"sil open font licen[sc]e(?: v(?:ersion)?)?(?: 1 1)?|ofl 1 1", r"ofl 1 1"),
    ("wtfpl", "wtfpl", r"wtfpl(?: licen[sc]e)?", r"wtfpl"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r"unlicense"),
    ("odbl", "odbl|database", r"open(?: data commons)? (?:open )?database licen[sc]e|odbl", r"odbl 1 0"),
    ("pddl", "pddl|dedication", r"public domain dedication and licen[sc]e|pddl", r"pddl 1 0"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", r"ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", r"ms rl"),
    ("sspl-1.0", "server|sspl", r"server side public licen[sc]e|sspl", r"sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: 2 0)?", r"elastic 2 0"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc-by-nc-nd", "nd|noderivatives", r"(?:cc by nc nd|attribution noncommercial noderivatives)(?: [1-4] [05])?", r"cc by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", "sa|sharealike", r"(?:cc by nc sa|attribution noncommercial sharealike)(?: [1-4] [05])?", r"cc by nc sa [1-4] [05]"),
    ("cc-by-nc", "nc|noncommercial", r"(?:cc by nc|attribution noncommercial)(?: [1-4] [05])?", r"cc by nc [1-4] [05]"),
    ("cc-by-nd", "nd|noderivatives", r"(?:cc by nd|attribution noderivatives)(?: [1-4] [05])?", r"cc by nd [1-4] [05]"),
    ("cc-by-sa", "sa|sharealike", r"(?:cc by sa|attribution sharealike)(?: [1-4] [05])?", r"cc by sa [1-4] [05]"),
    ("cc-by", "cc|commons", r"(?:cc by|creative commons attribution)(?: [1-4] [05])?", r"cc by [1-4] [05]"),
]

# The forms in which a license is stated, strongest first: (form, score, pattern around the name).
FORMS = [
    ("spdx", 1.0, r"spdx licen[sc]e identifier (?:{spdx})(?: only| or later)?"),
    ("grant", 0.95, r"(?:licen[sc]ed|released|distributed|available|published|covered|governed|provided|redistributed?)"
                    r"(?: \S+){{0,3}}? (?:under|by)(?: (?:the|a|an|terms|of|conditions)){{0,6}} (?:{name})"),
    ("subject", 0.9, r"(?:subject to|according to|pursuant to|in accordance with|under)"
                     r"(?: (?:the|terms|and|conditions|of)){{0,6}} (?:{name})"),
    ("header", 0.8, r"(?:licen[sc]e|licen[sc]es|licensing|copying) (?:is |file )?(?:the )?(?:{name})"),
    ("name", 0.6, r"(?:{name})"),
]

# Telling sentences of license texts: label, gate word, pattern.
BODIES = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "sublicense", r"use copy modify merge publish distribute sublicense and or sell copies"),
    ("isc", "fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", r"neither the name of \S+(?: \S+){0,12}? may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "apache", r"you may obtain a copy of the license at (?:https? )?www apache org licenses license 2 0"),
    ("apache-2.0", "as", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "gnu", r"you should have received a copy of the gnu general public license"),
    ("lgpl", "lesser", r"you should have received a copy of the gnu lesser general public license"),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ("epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("bsl-1.0", "executable", r"machine executable object code generated by a source language processor"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "waived", r"to the extent possible under law(?: \S+){0,12}? has waived all copyright"),
    ("public-domain", "domain", r"(?:released|placed|dedicated|dedicate) (?:in|into|to) the public domain"),
    ("all-rights-reserved", "reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
]

#: First digit of a version that a name may be glued to, in the pattern of the name.
_VERSION = re.compile(r" \?v\?(\d)")

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int  # smaller is stronger
    score: float
    gate: frozenset[bytes]
    pattern: re.Pattern[bytes]


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, strongest first: bodies, then each form of each license."""

    def rule(name: str, label: str, priority: int, score: float, gate: str, pattern: str) -> Rule:
        words = frozenset(g.encode() for g in gate.split("|"))
        return Rule(name, label, priority, score, words, re.compile(rf"(?<= )(?:{pattern})(?= )".encode()))

    found = [rule(f"body-{i}", label, 0, 1.0, gate, pattern) for i, (label, gate, pattern) in enumerate(BODIES)]
    for priority, (form, score, around) in enumerate(FORMS, 1):
        for label, gate, name, spdx in LICENSES:
            glued = [g + v + n for n in sorted(set(_VERSION.findall(name))) for g in gate.split("|") for v in ("", "v")]
            gate = "spdx" if form == "spdx" else "|".join([gate, *glued])
            found.append(rule(f"{form}-{label}", label, priority, score, gate, around.format(name=name, spdx=spdx)))
    return tuple(found)


@lru_cache(maxsize=1)
def gates() -> tuple[frozenset[bytes], dict[bytes, tuple[int, ...]]]:
    """All gate words, and the rules that each lets through."""
    by_word: dict[bytes, list[int]] = {}
    for i, rule in enumerate(rules()):
        for word in rule.gate:
            by_word.setdefault(word, []).append(i)
    return frozenset(by_word), {w: tuple(i) for w, i in by_word.items()}


def resolve(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Detections (priority, start, end, rule) that lie in no other of a stronger or equal class.

    Of equal intervals of one class the first rule stays. Levels are swept in turn against the
    running ends of what has been accepted, so the work is near linear in the detections.
    """
    kept: list[tuple[int, int, int, int]] = []
    starts: list[int] = []
    ends: list[int] = []
    for level in sorted({f[0] for f in found}):
        own: list[tuple[int, int, int, int]] = []
        furthest = -1
        for hit in sorted((f for f in found if f[0] == level), key=lambda f: (f[1], -f[2], f[3])):
            at = bisect_right(starts, hit[1])
            if hit[2] <= furthest or at and ends[at - 1] >= hit[2]:
                continue
            furthest = hit[2]
            own.append(hit)
        kept = sorted(kept + own, key=lambda f: (f[1], f[2]))
        starts, ends, furthest = [], [], -1
        for hit in kept:
            furthest = max(furthest, hit[2])
            starts.append(hit[1])
            ends.append(furthest)
    return kept


def places(stream: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word intervals of byte spans (in order of start) in the padded word stream."""
    out, at, words = [], 0, -1
    for start, end in spans:
        words += stream.count(b" ", at, start)
        out.append((words, words + stream.count(b" ", start, end) + 1))
        at = start
    return out


def scan(text: bytes) -> tuple[int, list[tuple[str, int]], list[tuple[str, str, int, int, float]]]:
    """Words, base places (label, start) and resolved detections (rule, label, start, end, score) of a UTF-8 text."""
    words = text.translate(_WORD_BYTES).split()
    every, by_word = gates()
    here = every.intersection(words)
    if not here and b"license" not in words:
        return len(words), [], []
    stream = b" " + b" ".join(words) + b" "
    base = []
    for phrase, label in BASE.items():
        needle, spans = b" " + phrase.encode() + b" ", []
        at = stream.find(needle)
        while at >= 0:
            spans.append((at + 1, at + len(needle) - 1))
            at = stream.find(needle, at + 1)
        base += [(label, start) for start, _ in places(stream, spans)]
    hits = []
    for i in sorted({i for word in here for i in by_word[word]}):
        spans = [m.span() for m in rules()[i].pattern.finditer(stream)]
        hits += [(rules()[i].priority, start, end, i) for start, end in places(stream, spans)]
    kept = [(rules()[i].name, rules()[i].label, s, e, rules()[i].score) for _, s, e, i in resolve(hits)]
    return len(words), base, kept


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, word count, base places and labels, all labels, score and ``detections``."""
    ship(docs.sparkSession)
    detection = StructType(
        [
            StructField("rule", StringType()),
            StructField("label", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
            StructField("score", DoubleType()),
        ]
    )
    added = [
        ("n_words", LongType()),
        ("n_base", LongType()),
        ("first_word", LongType()),
        ("last_word", LongType()),
        ("base_labels", StringType()),
        ("labels", StringType()),
        ("score", DoubleType()),
        ("detections", ArrayType(detection)),
    ]
    schema = fields(docs, [id_col], added)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm.licenses import scan

        kind = pa.list_(
            pa.struct([("rule", pa.string()), ("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        )
        for batch in batches:
            for run in byte_slices(batch, text_col, BATCH_BYTES):
                rows = []
                for text in utf8(run, text_col):
                    n, base, kept = scan(text)
                    starts = [s for _, s in base]
                    own = {label for label, _ in base}
                    rows.append(
                        (
                            n,
                            len(base),
                            min(starts, default=None),
                            max(starts, default=None),
                            ",".join(sorted(own)),
                            ",".join(sorted(own | {k[1] for k in kept})),
                            max([k[4] for k in kept] + ([FORMS[-1][1]] if base else []), default=0.0),
                            [dict(zip(("rule", "label", "start", "end", "score"), k)) for k in kept],
                        )
                    )
                kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), kind]
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([run.column(id_col), *columns], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(scanned, schema)
