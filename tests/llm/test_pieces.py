"""Pieces of texts give the ids of whole texts, with few calls of the library."""

import random

import numpy as np
import public_tokenizers

from cartlens.llm.pieces import PieceEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_with_punctuation_share_calls():
    encoder, given = PieceEncoder(PATH), []
    call = encoder._call
    encoder._call = lambda pieces: given.extend(pieces) or call(pieces)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é" for i in range(200)]
    text = " ".join(f"{w} {w}, {w}. {w}!!" for w in words)
    (ids,) = encoder.encode([text.encode()])
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == whole
    assert len(given) < 20  # 800 pieces, each given on its own before


def test_borders_of_odd_pieces():
    encoder, draw = PieceEncoder(PATH), random.Random(7)
    parts = ["a", "B", "É", "×", "ß", "'", "'s", "’", ",", ".", "<", "|", ">", "<|endoftext|>", "1", "٣", "́", "̸", "İ", " "]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 9))) for _ in range(3000)]
    for i in range(0, len(texts), 50):
        run = texts[i : i + 50]
        for text, ids in zip(run, encoder.encode([t.encode() for t in run])):
            assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
