"""What a worker keeps between batches stays small."""

import random
import tracemalloc

import public_tokenizers

from cartlens.llm import byte_bpe


def test_remembered_matches_stay_under_thirty_megabytes():
    draw = random.Random(1)
    codec = byte_bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    tracemalloc.start()
    for _ in range(20):
        codec.encode([" ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(20_000))])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 30e6
