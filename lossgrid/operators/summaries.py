"""Small relational operators: totals, distinct rows, previews and the value at the greatest key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def totals(df: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """One row per key with the named aggregates; partial ones run before the shuffle."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggregates.items()])


def distinct_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The distinct combinations of ``columns``, or of all columns."""
    return (df.select(*columns) if columns else df).distinct()


def preview(df: DataFrame, order: list[Column], rows: int) -> DataFrame:
    """The first rows in a total order; every task sends at most that many."""
    return df.orderBy(*order).limit(rows)


def value_at_greatest(df: DataFrame, keys: list[str], value: str, wanted: dict[str, tuple[Column, list[str]]]) -> DataFrame:
    """Per key and name: ``value`` in the row with the greatest order columns among the rows that meet the condition.

    ``wanted`` maps a name to (condition, order columns). A key without such a row has NULL.
    """
    return df.groupBy(*keys).agg(
        *[F.max_by(value, F.when(condition, F.struct(*order))).alias(name) for name, (condition, order) in wanted.items()]
    )
