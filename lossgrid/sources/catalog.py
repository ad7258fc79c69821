"""Reads: catalog tables, optional tables, vintages, training frames and flexible column names."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def catalog_scan(spark: SparkSession, tables: dict[str, str], alias: str) -> DataFrame:
    """Table behind an alias: a parquet folder when it looks like a path, else a catalog table."""
    name = tables[alias]
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def scan_or_empty(spark: SparkSession, name: str, schema: StructType | str) -> DataFrame:
    """The catalog table, or an empty frame with the schema when it does not exist."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def vintage_scan(regressors: DataFrame, training_end: str) -> DataFrame:
    """The regressors as they were known in the last training month."""
    return regressors.where(F.col("SeenMonth") == F.date_format(F.lit(training_end).cast("date"), "yyyy_MM"))


def temporal_filter(df: DataFrame, column: str | None, lower: str | None = None, upper: str | None = None) -> DataFrame:
    """Rows inside the closed range; either bound may be missing."""
    if column is None and (lower or upper):
        raise ValueError("a bound needs a date column")
    if lower:
        df = df.where(F.col(column) >= F.lit(lower).cast(df.schema[column].dataType))
    if upper:
        df = df.where(F.col(column) <= F.lit(upper).cast(df.schema[column].dataType))
    return df


def table_name(full: str | None = None, catalog: str | None = None, schema: str | None = None, table: str | None = None) -> str:
    """Either the full name or its parts."""
    parts = [p for p in (catalog, schema, table) if p]
    if bool(full) == bool(parts):
        raise ValueError("give either the full table name or its parts")
    return full or ".".join(parts)


def load_xy(
    df: DataFrame,
    features: list[str],
    target: str | None,
    auxiliary: list[str] | None = None,
    date_col: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
) -> DataFrame:
    """Training columns inside the date range, as a DataFrame."""
    wanted = list(dict.fromkeys([*features, *(auxiliary or []), *([target] if target else [])]))
    return resolve_columns(temporal_filter(df, date_col, lower, upper), wanted)


def resolve_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Select the wanted columns by exact name, then ignoring case, then by letters and digits only."""

    def plain(name: str) -> str:
        return re.sub(r"[^a-z0-9]", "", name.lower())

    selected = []
    for name in wanted:
        for same in (lambda c: c == name, lambda c: c.lower() == name.lower(), lambda c: plain(c) == plain(name)):
            found = [c for c in df.columns if same(c)]
            if len(found) > 1:
                raise ValueError(f"{name} matches several columns: {found}")
            if found:
                selected.append(F.col(f"`{found[0]}`").alias(name))
                break
        else:
            raise KeyError(name)
    return df.select(*selected)


def tables_by_prefix(spark: SparkSession, prefix: str, suffix: str = "_payload_flat", schema: str | None = None) -> DataFrame:
    """Union of all tables named ``prefix_..._payload_flat`` of a schema (``catalog.schema``, by default the current one).

    Missing columns become NULL. Temporary views belong to the current schema only.
    """
    pattern = re.compile(rf"^{re.escape(prefix)}_.*{re.escape(suffix)}$")
    names = sorted(t.name for t in spark.catalog.listTables(schema) if pattern.match(t.name) and not (schema and t.isTemporary))
    if not names:
        raise ValueError(f"no table matches {pattern.pattern}")
    return union_all([spark.table(f"{schema}.{name}" if schema else name) for name in names])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def models_info_frame(models: DataFrame, config_col: str = "model_config") -> DataFrame:
    """Model metadata with the configuration text as a map and the time of the stamp."""
    parsed = F.from_json(config_col, "map<string,string>")
    return models.withColumn(config_col, parsed).withColumn("ts", F.current_timestamp())
