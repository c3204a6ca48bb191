"""Data checks. ``check_*`` return the violating rows or values; a report counts them for many checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.aggregates import duplicate_keys
from lakemart.operators.columns import quoted
from lakemart.operators.joins import orphan_rows
from lakemart.operators.unions import union_by_name


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return duplicate_keys(df.filter(quoted(column).isNotNull()), [column])


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose non-NULL value is not in the list."""
    return df.filter(~quoted(column).isin(*values))


def check_relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return orphan_rows(df, column, parent, parent_column)


def check_expression(df: DataFrame, expression: Column | str, strict: bool = False) -> DataFrame:
    """Rows for which the expression is false; with ``strict`` also those for which it is unknown."""
    return df.filter(_broken(F.expr(expression) if isinstance(expression, str) else expression, strict))


def check_shared_ids(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Ids that occur more than once over two tables together."""
    return duplicate_keys(union_by_name(left.select(column), right.select(column)), [column])


def _broken(expression: Column, strict: bool) -> Column:
    return ~F.coalesce(expression, F.lit(False)) if strict else ~expression


@dataclass(frozen=True)
class Check:
    """One check of a report. ``kind`` is unique, not_null, accepted_values, relationships or expression."""

    table: str
    kind: str
    column: str
    values: tuple = field(default=())
    parent: str = ""
    parent_column: str = ""
    strict: bool = False

    def row_condition(self) -> Column | None:
        """The per-row violation test, for kinds that need only the row itself."""
        if self.kind == "not_null":
            return quoted(self.column).isNull()
        if self.kind == "accepted_values":
            return ~quoted(self.column).isin(*self.values)
        if self.kind == "expression":
            return _broken(F.expr(self.column), self.strict)
        return None


def _label(check: Check) -> list[Column]:
    return [F.lit(check.kind).alias("check"), F.lit(check.table).alias("table"), F.lit(check.column).alias("column")]


def _key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, key, n)``: how often each non-NULL value of the columns occurs, from one grouping of the table."""
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("key")) for c in columns]
    stacked = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("key IS NOT NULL")
    return stacked.groupBy("column", "key").agg(F.count("*").alias("n"))


def quality_report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Rows ``(check, table, column, violations)``.

    All row-level checks of a table share one scan, and all its unique and relationships checks one grouping. Give
    kept tables: each scan of a table that is not kept computes its whole chain again.
    """
    parts = []
    by_table = sorted((c for c in checks if c.row_condition() is not None), key=lambda c: c.table)
    for table, group in groupby(by_table, key=lambda c: c.table):
        listed = list(group)
        counts = tables[table].agg(*[F.count_if(c.row_condition()).alias(f"v{i}") for i, c in enumerate(listed)])
        parts.append(_report_lines(counts, listed))
    grouped = [c for c in checks if c.row_condition() is None]
    if unknown := {c.kind for c in grouped} - {"unique", "relationships"}:
        raise ValueError(f"unknown check kind {sorted(unknown)}")
    columns: dict[str, list[str]] = {}
    for table, column in [(c.table, c.column) for c in grouped] + [(c.parent, c.parent_column) for c in grouped if c.parent]:
        if column not in columns.setdefault(table, []):
            columns[table].append(column)
    keys = {table: _key_counts(tables[table], names) for table, names in columns.items()}
    for table in columns:
        unique = [c for c in grouped if c.table == table and c.kind == "unique"]
        if unique:
            counts = keys[table].agg(*[F.count_if((F.col("column") == c.column) & (F.col("n") > 1)).alias(f"v{i}")
                                       for i, c in enumerate(unique)])
            parts.append(_report_lines(counts, unique))
    for c in grouped:
        if c.kind == "relationships":
            child, parent = (keys[t].filter(F.col("column") == name).drop("column")
                             for t, name in ((c.table, c.column), (c.parent, c.parent_column)))
            bad = child.join(parent.select("key"), "key", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v0"))
            parts.append(_report_lines(bad, [c]))
    return union_by_name(*parts)


def _report_lines(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = F.array(*[F.struct(*_label(c), F.col(f"v{i}").alias("violations")) for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


class QualityError(Exception):
    """Raised when a report holds violations."""


def assert_clean(report: DataFrame) -> None:
    """Raise if any check failed. Brings only the failed lines of the report to the driver."""
    failed = report.filter("violations > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{r['table']}.{r['column']} {r['check']}: {r['violations']}" for r in failed))


def checked(tables: Mapping[str, DataFrame], checks: Sequence[Check], strict: bool = True) -> dict[str, DataFrame]:
    """The tables and their report under ``checks``; with ``strict``, any violation raises."""
    report = quality_report(tables, checks)
    if strict:
        assert_clean(report)
    return {**tables, "checks": report}
