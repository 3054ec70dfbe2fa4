"""Token counts, token store and byte-level BPE against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from cartlens.llm import byte_bpe, token_counts, token_store
from cartlens.llm.pieces import PieceEncoder
from cartlens.llm.registry import BYTE_RANKS, END_ID, WORD_TOKENIZER
from tests.llm.cases import awkward, empty

ALPHABET = "abcXYZ019 .,'!\n\t\x0b\x0c\r\x1c\x1f\x85\xa0ÉéßΣσςİı日本̱́̌JHTW|<> 🎉'sS're"


def random_texts(n: int) -> list[str]:
    rng = random.Random(5)
    special = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", " 's"]
    one = lambda: rng.choice(special) if rng.random() < 0.03 else rng.choice(ALPHABET)
    return ["", " ", *("".join(one() for _ in range(rng.randrange(80))) for _ in range(n))]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER)


def expected_ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_are_the_librarys(library):
    texts = random_texts(3_000)
    found = PieceEncoder(WORD_TOKENIZER).encode([t.encode() for t in texts])
    assert found == [np.asarray(i, "<u4").tobytes() for i in expected_ids(library, texts)]


def test_unsafe_tokenizers_are_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, texts = PieceEncoder(path), ["two  spaces here", " lead", "a\n\nb"]
    assert not encoder.splits
    own = Tokenizer.from_file(path)
    assert encoder.encode([t.encode() for t in texts]) == [
        np.asarray(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts
    ]


def test_token_counts(spark, library):
    docs = awkward(spark)
    found = sorted(map(tuple, token_counts.count_tokens(docs, WORD_TOKENIZER).collect()), key=repr)
    rows = docs.collect()
    ids = expected_ids(library, [r.text for r in rows])
    assert found == sorted(
        ((r.doc_id, len((r.text or "").encode()), len(i), len(i) > 2048) for r, i in zip(rows, ids)), key=repr
    )
    assert token_counts.count_tokens(empty(spark), WORD_TOKENIZER).collect() == []


def test_token_store(spark, library, folder):
    docs = awkward(spark)
    path = f"{folder}/tokens"
    token_store.write_tokens(token_store.encode_ordered(docs, WORD_TOKENIZER, END_ID), path)
    back = token_store.read_tokens(spark, path).collect()
    by_start = sorted(back, key=lambda r: r.start)
    assert [r.doc_id is None for r in by_start[:2]] == [True, True]
    assert [r.doc_id for r in by_start[2:]] == sorted(r.doc_id for r in by_start[2:])
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start[:-1]]).tolist()
    rows = docs.collect()
    ids = expected_ids(library, [r.text for r in rows])
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in back), key=key) == sorted(
        ((r.doc_id, i + [END_ID]) for r, i in zip(rows, ids)), key=key
    )
    sums = {(r.start, r.ids_crc32) for r in token_store.digest(token_store.read_tokens(spark, path)).collect()}
    assert sums == {(r.start, zlib.crc32(np.asarray(r.ids, "<u4").tobytes())) for r in back}
    only = token_store.read_tokens(spark, path, ["doc_id", "n_tokens"])
    assert "ids" not in only._jdf.queryExecution().executedPlan().toString()


def test_token_store_of_nothing(spark, folder):
    path = f"{folder}/nothing"
    token_store.write_tokens(token_store.encode_ordered(empty(spark), WORD_TOKENIZER, END_ID), path)
    assert token_store.digest(token_store.read_tokens(spark, path)).collect() == []


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(BYTE_RANKS, public_tokenizers.PATTERN)


def test_byte_bpe_is_the_librarys(codec):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )
    rng = random.Random(3)
    long_words = ["".join(rng.choice("abthein") for _ in range(rng.randrange(1, 400))) for _ in range(200)]
    texts = [*random_texts(2_000), *long_words, "a" * 3_000, "日本語" * 200]
    found = codec.encode(texts)
    assert found == [np.asarray(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert [codec.decode(f) for f in found] == [t.encode() for t in texts]


def test_scalar_and_row_trees_agree(codec):
    rng = random.Random(4)
    words = [bytes(rng.choice(b"thein\xc3\xa9") for _ in range(rng.randrange(1, 65))) for _ in range(500)]
    assert codec.merge_rows(words) == [codec.merge_long(w) for w in words]


def test_byte_bpe_round_trip(spark, codec):
    docs = awkward(spark)
    encoded = byte_bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN, keep=["doc_id", "text", "n_tokens"])
    for row in byte_bpe.decode(encoded, BYTE_RANKS, public_tokenizers.PATTERN).collect():
        assert bytes(row.decoded) == (row.text or "").encode()
        assert bytes(row.ids) == codec.encode([row.text or ""])[0]
    assert byte_bpe.encode(empty(spark), BYTE_RANKS, public_tokenizers.PATTERN).collect() == []
