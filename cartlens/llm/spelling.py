"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words are counted in Arrow functions. Near words then meet in groups that leave the edit a short
window: a word of n letters stands under the base lengths n and n - 1, so that a pair shares the smaller of
its lengths, and two words one edit apart share what is before or what is after the middle of that base. A group with more than
``GROUP`` words, or with windows over ``LONGEST`` letters, halves its windows again, until the window is one letter.
A group is then at most one letter, or two, in place of one: as many words as the alphabet allows.

Sorted by group key, whole groups are packed into blocks of about ``BLOCK`` words. A block's index has a bitset over its
words for every (position, letter) of their windows. All words of the block run through the index at
once: after i letters, one set of bits has the words with no error, three more those with one, by the shift of their next
position: replaced (i), left out (i - 1), put in (i + 1). Each step is a few AND and OR on whole
machine words. Words that end where their set says are one edit apart.

Defined results: null texts have no words; a null id is written as nothing in the check value; repeated rows count again; of
near words with equal counts the smaller in code-point order is the form; empty tables give empty results; other columns
are ignored. Texts are read in windows of ``TEXT`` characters cut between words; a single word of any length is one word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartlens.llm.common import byte_slices, ship, utf8, written

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: How many times a form is as frequent as its variant.
RATIO = 5
#: Runs whose check value this divides lose a letter.
DAMAGE = 199
BATCH_BYTES = 1 << 20
TEXT = 1 << 20
#: Distinct words a task counts before it hands counts on.
COUNTED = 200_000
GROUP = 4096
LONGEST = 32
BLOCK = 2048
_WORD = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
_BETWEEN = re.compile("[^a-zÀ-ÿ]")


def runs_by_window(data: bytes, window: int = TEXT) -> Iterator[list[str]]:
    """Lower-cased (A-Z only) letter runs of at least six letters."""
    text = data.lower().decode("utf-8")
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > window and (found := _BETWEEN.search(text, at + window)):
            end = found.start()
        yield _WORD.findall(text, at, end)
        at = end


def _spelled(run: str, check: int) -> str:
    """The run, or the run without a letter where its check value says so."""
    value = zlib.crc32(run.encode("utf-8"), check)
    if value % DAMAGE:
        return run
    at = value % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table of the words: ``_v`` (number), ``word``, ``n`` (occurrences over all documents)."""
    ship(docs.sparkSession)
    small = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.col(text_col).alias("_text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()
        for batch in batches:
            for run in byte_slices(batch, "_text", BATCH_BYTES):
                for key, data in zip(run.column("_id").to_pylist(), utf8(run, "_text")):
                    check = zlib.crc32(f"{key}:".encode())
                    for words in runs_by_window(data):
                        for word, n in Counter(words).items():
                            totals[_spelled(word, check)] += n
                if len(totals) > COUNTED:
                    yield _counts(totals)
                    totals.clear()
        yield _counts(totals)

    parts = small.mapInArrow(counted, "word string, n long")
    whole = parts.groupBy("word").agg(F.sum("n").alias("n"))
    known = whole.where((F.char_length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT))
    return written(known.withColumn("_v", F.monotonically_increasing_id()), "vocabulary")


def _counts(totals: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["word", "n"])


def _key(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*[p.cast("binary") for p in parts])))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows under two keys each: one for an edit in the first half of the window, one for the second."""
    first = F.expr("_base div 2")
    rest = F.col("_base") - first
    before = F.struct(
        _key(F.col("_key"), F.lit("a"), F.expr("right(_part, _base - _base div 2)")).alias("_key"),
        F.substring("_part", F.lit(1), F.char_length("_part") - rest).alias("_part"),
        first.cast("int").alias("_base"),
    )
    after = F.struct(
        _key(F.col("_key"), F.lit("b"), F.expr("left(_part, _base div 2)")).alias("_key"),
        F.substring("_part", first + 1, F.char_length("_part")).alias("_part"),
        rest.cast("int").alias("_base"),
    )
    return rows.select("_v", F.explode(F.array(before, after)).alias("_half")).select("_v", "_half.*")


def grouped(words: DataFrame, group: int = GROUP, longest: int = LONGEST) -> DataFrame:
    """Words (``_v``, ``word``) under the keys of their groups: ``_v``, ``_key``, ``_part`` (window), ``_base`` (its smaller length)."""
    letters = F.char_length("word")
    bases = F.array(letters, letters - 1)
    whole = words.select("_v", F.col("word").alias("_part"), F.explode(bases).alias("_base"))
    whole = whole.where(F.col("_base") >= LEAST_LETTERS).select("_v", _key(F.col("_base").cast("string")).alias("_key"), "_part", "_base")
    rows, ready = written(_halved(whole), "windows"), []
    while True:
        sizes = rows.groupBy("_key").agg(F.count("*").alias("_size"), F.max("_base").alias("_base"))
        large = (F.col("_size") > 1) & (F.col("_base") > 1) & ((F.col("_size") > group) | (F.col("_base") > longest))
        again = written(sizes.where(large).select("_key"), "large")
        if again.isEmpty():
            break
        ready.append(rows.join(again, "_key", "left_anti"))
        rows = written(_halved(rows.join(again, "_key", "left_semi")), "windows")
    for part in ready:
        rows = rows.unionByName(part)
    return rows


def one_edit_apart(parts: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all ordered pairs of one group whose parts differ by one edit.

    ``groups`` numbers the group of each part from 0.
    """
    lengths = np.asarray([len(p) for p in parts])
    order = np.argsort(lengths, kind="stable")
    lengths, groups = lengths[order], groups[order]
    n, top = len(parts), int(lengths.max())
    points = np.frombuffer("".join([parts[i] for i in order]).encode("utf-32-le"), "<u4")
    letters, flat = np.unique(points, return_inverse=True)
    owner = np.repeat(np.arange(n), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    codes = np.zeros((n, top), np.int64)
    codes[owner, place] = flat

    def bitsets(flags: np.ndarray) -> np.ndarray:
        octets = np.packbits(flags, axis=-1, bitorder="little")
        spare = -octets.shape[-1] % 8
        return np.pad(octets, [(0, 0)] * (octets.ndim - 1) + [(0, spare)]).view(np.uint64)

    index = np.zeros((top + 2, len(letters), n), bool)
    index[place, flat, owner] = True
    index = bitsets(index)
    lasts = bitsets(lengths >= np.arange(1, top + 3)[:, None])  # [i]: words with a letter at position i
    ends = bitsets(lengths == np.arange(top + 2)[:, None])  # [i]: words of i letters
    members = bitsets(groups == np.arange(groups.max() + 1)[:, None])

    none = members[groups]
    replaced, left_out, put_in = (np.zeros_like(none) for _ in range(3))
    for i in range(top):
        on = slice(int(np.searchsorted(lengths, i, "right")), n)  # words that have a letter i
        code = codes[on, i]
        here, ahead, exact, there = index[i, code], index[i + 1, code], none[on], lasts[i]
        put_in[on] = (put_in[on] | (exact & there)) & ahead
        replaced[on] = (replaced[on] & here) | (exact & there & ~here)
        left_out[on] = (left_out[on] & index[i - 1, code]) | exact if i else exact
        none[on] = exact & here
    found = replaced & ends[lengths]
    found |= np.where((lengths > 0)[:, None], left_out & ends[np.maximum(lengths - 1, 0)], np.uint64(0))
    found |= (put_in | (none & lasts[lengths])) & ends[lengths + 1]
    a, b = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, count=n, bitorder="little"))
    return order[a], order[b]


def near_words(words: DataFrame, group: int = GROUP, longest: int = LONGEST, block: int = BLOCK) -> DataFrame:
    """All ordered pairs of words (``_a``, ``_b``: their ``_v``) that differ by one edit."""
    dealt = grouped(words, group, longest).repartition("_key").sortWithinPartitions("_key")

    def searched(keys: list[bytes], parts: list[str], numbers: list[int]) -> pa.RecordBatch:
        _, groups = np.unique(np.asarray(keys, "S16"), return_inverse=True)
        shared = np.flatnonzero(np.bincount(groups)[groups] > 1)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(shared):
            _, groups = np.unique(groups[shared], return_inverse=True)
            a, b = one_edit_apart([parts[i] for i in shared], groups)
        own = np.asarray(numbers, np.int64)[shared]
        return pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(own[b])], names=["_a", "_b"])

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, numbers = [], [], []
        for batch in batches:
            keys += [k.hex().encode() for k in batch.column("_key").to_pylist()]
            parts += batch.column("_part").to_pylist()
            numbers += batch.column("_v").to_pylist()
            start = 0
            while len(keys) - start > block:  # cut where a group ends; the last group may go on in the next batch
                end = start + block
                while end < len(keys) and keys[end] == keys[end - 1]:
                    end += 1
                if end == len(keys):
                    break
                yield searched(keys[start:end], parts[start:end], numbers[start:end])
                start = end
            keys, parts, numbers = keys[start:], parts[start:], numbers[start:]
        if keys:
            yield searched(keys, parts, numbers)

    return dealt.select("_key", "_part", "_v").mapInArrow(by_block, "_a long, _b long").distinct()


def _last(forms: DataFrame) -> DataFrame:
    """Follow ``_v`` to ``_to`` until the word that has no form: ``_v``, ``_root``. Forms are more frequent, so no chain closes."""
    while True:
        onward = forms.select(F.col("_v").alias("_to"), F.col("_to").alias("_next"))
        step = written(forms.join(onward, "_to", "left").select("_v", "_to", "_next"), "chains")
        forms = step.select("_v", F.coalesce("_next", "_to").alias("_to"))
        if step.where("_next is not null").isEmpty():
            return forms.withColumnRenamed("_to", "_root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, longest: int = LONGEST, block: int = BLOCK) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = vocabulary(docs, id_col, text_col)
    other = words.select(F.col("_v").alias("_b"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"), F.col("_v").alias("v")).alias("_other"))
    best = near_words(words, group, longest, block).join(other, "_b").groupBy("_a").agg(F.count("*").alias("_near"), F.min("_other").alias("_best"))
    joined = words.join(best.withColumnRenamed("_a", "_v"), "_v", "left")
    formed = -F.col("_best.less") >= RATIO * F.col("n")
    rows = joined.select(
        "_v",
        "word",
        "n",
        F.coalesce("_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("_best.word")).alias("form"),
        F.when(formed, -F.col("_best.less")).alias("form_n"),
        F.when(formed, F.col("_best.v")).alias("_form"),
    )
    rows = written(rows, "forms")
    roots = _last(rows.where("_form is not null").select("_v", F.col("_form").alias("_to")))
    named = roots.join(words.select(F.col("_v").alias("_root"), F.col("word").alias("root")), "_root").select("_v", "root")
    return rows.join(named, "_v", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
