"""Token counts: batch encoding in Arrow functions that return lengths only.

The stage is one narrow pass without a shuffle. Arrow batches are cut into runs of about
``batch_bytes`` of text, so a run of long documents needs no more memory than a run of short
ones; long texts are split at white space, where the tokenizer never joins two tokens.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows and ids are counted
row by row; an empty table gives an empty result with the same schema; other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType

from cartlens.llm.common import byte_slices, fields, ship, utf8

BATCH_BYTES = 1 << 20
LIMIT = 2048


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    ship(docs.sparkSession)
    schema = fields(docs, [id_col], [("n_bytes", LongType()), ("n_tokens", LongType()), ("over_limit", BooleanType())])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cartlens.llm.pieces import encoder

        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for run in byte_slices(batch, text_col, batch_bytes):
                texts = utf8(run, text_col)
                counts = [len(ids) // 4 for ids in encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        run.column(id_col),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(lengths, schema)
