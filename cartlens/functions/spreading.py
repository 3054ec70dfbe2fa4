"""Shuffle partitions in proportion to the rows of a write.

An order line takes about 14 bytes in a shuffle file and over 300 in the sorts and hash tables of a task, so partitions that
are merged up to the default of 64 MB hold millions of lines each, and a fixed number of partitions grows with the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows of a shuffle partition, about, and its bytes in shuffle files after small ones are merged, at most.
ROWS = 1 << 18
BYTES = 1 << 23

PARTITIONS = "spark.sql.shuffle.partitions"
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def size_in_bytes(text: str) -> int | None:
    """Bytes of a setting such as ``64MB``; None for other forms."""
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower())
    return int(found[1]) * _UNITS[found[2]] if found else None


@contextmanager
def spread(spark: SparkSession, rows: int) -> Iterator[None]:
    """Run jobs over ``rows`` rows with bounded shuffle partitions; a session that has smaller ones keeps them."""
    conf = spark.conf
    kept = {name: conf.get(name, None) for name in (PARTITIONS, MERGED)}
    partitions = int(conf.get(PARTITIONS, "200"))
    merged = size_in_bytes(conf.get(MERGED, "64MB"))
    try:
        if -(-rows // ROWS) > partitions:
            conf.set(PARTITIONS, str(-(-rows // ROWS)))
        if merged is not None and merged > BYTES:
            conf.set(MERGED, str(BYTES))
        yield
    finally:
        for name, value in kept.items():
            if value is None:
                conf.unset(name)
            elif conf.get(name, None) != value:
                conf.set(name, value)
