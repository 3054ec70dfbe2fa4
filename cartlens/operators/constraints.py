"""Constraints of the star schema: keys, references, missing values, lengths and value rules.

Rules of a table are compiled into as few passes as they need: all row rules (missing values, lengths, value rules) are
counts of one aggregate over the table, a primary key is a grouping on its columns, and a reference is a
grouping on the referring column, so each different value meets the referred table once, however many rows hold it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from cartlens import schemas


class ConstraintError(ValueError):
    """Raised when tables break a constraint."""


@dataclass(frozen=True)
class Rules:
    """What must hold in one table."""

    table: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    lengths: Mapping[str, int] | None = None
    values: Mapping[str, str] | None = None
    references: Mapping[str, str] | None = None

    @classmethod
    def of(cls, table: str, schema: StructType) -> "Rules":
        """The rules that the schema module states for a star table."""
        return cls(
            table,
            tuple(schemas.STAR_KEYS[table]),
            tuple(f.name for f in schema.fields if not f.nullable),
            schemas.STAR_LENGTHS.get(table, {}),
            schemas.STAR_RULES.get(table, {}),
            schemas.STAR_REFERENCES.get(table, {}),
        )

    def row_checks(self) -> dict[tuple[str, str], Column]:
        """Broken rows by (kind, columns); a value rule that is null holds, as in SQL."""
        checks = {("not_null", c): F.col(c).isNull() for c in self.required}
        checks |= {("length", c): F.char_length(c) > n for c, n in (self.lengths or {}).items()}
        return checks | {("check", c): ~F.expr(rule) for c, rule in (self.values or {}).items()}


def star_rules() -> list[Rules]:
    return [Rules.of(name, schema) for name, schema in schemas.STAR_SCHEMAS.items()]


def violations(tables: Mapping[str, DataFrame], rules: Sequence[Rules] | None = None) -> DataFrame:
    """One row per rule: ``table``, ``kind``, ``columns``, ``violations``.

    Of rows with one primary key all but one break it; rows with a null in the key are counted by their missing
    value alone. A reference counts rows whose value is not null and not in the referred table.
    """
    found = None
    for rule in star_rules() if rules is None else rules:
        frame = tables[rule.table]
        parts = []
        if checks := rule.row_checks():
            names = list(checks)
            one = frame.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())])
            parts.append(one.select(F.inline(F.array(*[_row(rule.table, *n, F.col(f"c{i}")) for i, n in enumerate(names)]))))
        known = frame.where(" and ".join(f"{c} is not null" for c in rule.key))
        repeats = known.groupBy(*rule.key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
        parts.append(repeats.select(F.inline(F.array(_row(rule.table, "primary_key", ", ".join(rule.key), F.col("n"))))))
        for column, target in (rule.references or {}).items():
            used = frame.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
            (referred,) = next(r.key for r in (star_rules() if rules is None else rules) if r.table == target)
            lost = used.join(tables[target].select(F.col(referred).alias(column)), column, "left_anti")
            lost = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
            parts.append(lost.select(F.inline(F.array(_row(rule.table, "foreign_key", column, F.col("n"))))))
        for part in parts:
            found = part if found is None else found.unionByName(part)
    return found


def _row(table: str, kind: str, columns: str, n: Column) -> Column:
    return F.struct(F.lit(table).alias("table"), F.lit(kind).alias("kind"), F.lit(columns).alias("columns"), n.cast("bigint").alias("violations"))


def enforce(tables: Mapping[str, DataFrame], rules: Sequence[Rules] | None = None) -> None:
    """Raise with the broken rules (a report has one row per rule)."""
    broken = violations(tables, rules).where("violations > 0").collect()
    if broken:
        raise ConstraintError("; ".join(sorted(f"{r.table} {r.kind} ({r.columns}): {r.violations} rows" for r in broken)))
