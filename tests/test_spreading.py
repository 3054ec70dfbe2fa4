"""Writes of a workspace have shuffle partitions in proportion to the order lines."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartlens.functions import spreading
from cartlens.plans.workspace import Workspace


@pytest.mark.parametrize(
    "text, expected", [("64MB", 64 << 20), ("8m", 8 << 20), ("67108864b", 64 << 20), ("16k", 16 << 10), ("123", 123), ("a lot", None)]
)
def test_sizes_of_settings(text, expected):
    assert spreading.size_in_bytes(text) == expected


def test_partitions_follow_rows_and_the_session_is_as_before(spark):
    names = (spreading.PARTITIONS, spreading.MERGED)
    before = [spark.conf.get(n, None) for n in names]
    with spreading.spread(spark, 1000 * spreading.ROWS):
        assert spark.conf.get(spreading.PARTITIONS) == "1000"
        assert spreading.size_in_bytes(spark.conf.get(spreading.MERGED)) <= spreading.BYTES
    assert [spark.conf.get(n, None) for n in names] == before
    with pytest.raises(ZeroDivisionError), spreading.spread(spark, 1000 * spreading.ROWS):
        raise ZeroDivisionError
    assert [spark.conf.get(n, None) for n in names] == before


def test_smaller_partitions_of_a_session_stay(spark):
    before = spark.conf.get(spreading.MERGED, None)
    spark.conf.set(spreading.MERGED, "16k")
    try:
        with spreading.spread(spark, 1):
            assert spark.conf.get(spreading.MERGED) == "16k"
        assert spark.conf.get(spreading.MERGED) == "16k"
    finally:
        spark.conf.unset(spreading.MERGED) if before is None else spark.conf.set(spreading.MERGED, before)


def test_written_tables_are_made_by_more_tasks_for_more_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spreading, "ROWS", 50)
    lines = spark.range(3000).select(F.col("id").alias("l_orderkey"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        ws = Workspace.open(spark, str(tmp_path))
        table = ws.written("spread", lambda: lines.groupBy("l_orderkey").agg(F.count("*").alias("n")))
        assert table.count() == 3000
        tasks = table.select(F.input_file_name().alias("file")).distinct().count()
    finally:
        spark.conf.unset(coalesce)
    assert tasks > int(spark.conf.get(spreading.PARTITIONS)) and tasks <= 60
