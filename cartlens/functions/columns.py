"""Small column expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cartlens.schemas import SEGMENT_EDGES, SEGMENT_NAMES, SEGMENT_UPPER


def segment_code(orders: Column, upper: int = SEGMENT_UPPER) -> Column:
    """Right-closed frequency segment 1..5; 0 outside ``(0, upper]``.

    The upper edge of the last segment differs between the feature matrix (101) and the reports
    (100, 9999), so it is a parameter.
    """
    edges = (*SEGMENT_EDGES, upper)
    code = F.when(orders <= edges[0], F.lit(0))
    for i, edge in enumerate(edges[1:], start=1):
        code = code.when(orders <= edge, F.lit(i))
    return code.otherwise(F.lit(0))


def segment_name(code: Column) -> Column:
    """Name of a segment code, NULL for the out-of-range code."""
    name = F.when(F.lit(False), F.lit(""))
    for value, label in SEGMENT_NAMES.items():
        name = name.when(code == value, F.lit(label))
    return name


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division giving NULL instead of an ANSI error on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def share(condition: Column) -> Column:
    """Fraction of rows for which the condition holds."""
    return ratio(F.count_if(condition), F.count(F.lit(1)))


def as_rows(wide: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """Turn a one-row frame of numbers into (metric, value) rows."""
    return wide.select(*[F.col(c).cast("double").alias(c) for c in wide.columns]).unpivot(
        [], wide.columns, name, value
    )


def narrow(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a contract schema.

    Spark's ANSI casts raise when a value does not fit the target type, so a narrow column can
    never silently wrap around.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Widen integers to BIGINT and round fractions, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.FractionalType):
            column = F.round(column.cast("double"), digits)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)
