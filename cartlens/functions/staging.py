"""Hook for writing frames that several branches of a plan read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Stage = Callable[[str, DataFrame], DataFrame]


def unstaged(name: str, frame: DataFrame) -> DataFrame:
    """Keep a shared frame lazy."""
    return frame
