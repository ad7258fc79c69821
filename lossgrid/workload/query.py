"""A registered query: how Spark builds it, the columns it shows and the SQL that must agree."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Halves such as 0.00005 are moved off the rounding border, so sums taken in another order round alike;
# adding 0.0 turns a negative zero into zero.
NUDGE = 1e-7
DIGITS = 4


@dataclass(frozen=True)
class Query:
    """``columns`` lists ``name:kind`` with kind i (integer), d (double), s (string), t (date), ts (time), b (boolean)."""

    build: Callable[[SparkSession, str], DataFrame]
    columns: str
    sql: str | None = None

    def cells(self) -> list[tuple[str, str]]:
        return [tuple(cell.rsplit(":", 1)) for cell in self.columns.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        return df.select(*[_spark_cell(df, name, kind).alias(name) for name, kind in self.cells()])

    def oracle(self, ctes: dict[str, str]) -> str | None:
        if self.sql is None:
            return None
        shown = ", ".join(f"{_sql_cell(name, kind)} AS {name}" for name, kind in self.cells())
        return f"{with_clause(self.sql, ctes)}SELECT {shown} FROM ({self.sql}) AS result"


def _spark_cell(df: DataFrame, name: str, kind: str):
    column = F.col(name)
    if kind == "i":
        return column.cast("bigint")
    if kind == "d":
        return F.round(column.cast("double") + NUDGE, DIGITS) + F.lit(0.0)
    if kind == "t":
        return F.date_format(column, "yyyy-MM-dd")
    if kind == "ts":
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if kind == "s":
        return column.cast("string")
    return column


def _sql_cell(name: str, kind: str) -> str:
    if kind == "i":
        return f"CAST({name} AS BIGINT)"
    if kind == "d":
        return f"round(CAST({name} AS DOUBLE) + {NUDGE}, {DIGITS}) + 0.0"
    if kind == "t":
        return f"strftime({name}, '%Y-%m-%d')"
    if kind == "ts":
        return f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
    if kind == "s":
        return f"CAST({name} AS VARCHAR)"
    return name


def with_clause(sql: str, ctes: dict[str, str]) -> str:
    """WITH list of the named steps the statement uses, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in ctes:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(ctes[name])
                ordered.append(name)

    visit(sql)
    return "WITH " + ", ".join(f"{name} AS ({ctes[name]})" for name in ordered) + " " if ordered else ""
