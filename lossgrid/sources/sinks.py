"""Writes: named tables, views, appends with new columns, CSV exports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructField, StructType

#: Rows after which an export goes on in the next file.
MAX_CSV_ROWS = 1_000_000


def materialise_table(df: DataFrame, name: str) -> DataFrame:
    """Persist as a catalog table, replacing an earlier version, and read it back."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _files(spark: SparkSession, path: str):
    """File system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str) -> list[tuple[int, StructType]]:
    """The whole schema versions of an appended table, ascending. One that is just being written is not yet there."""
    files, folder = _files(spark, f"{path.rstrip('/')}.schema")
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.isdigit():
            text = spark.read.text(status.getPath().toString(), wholetext=True).head(1)
            try:
                found.append((int(name), StructType.fromJson(json.loads(text[0]["value"]))))
            except (IndexError, ValueError):
                continue
    return sorted(found, key=lambda v: v[0])


def _publish(spark: SparkSession, path: str, version: int, schema: StructType) -> None:
    """Make a schema version, or raise where another writer has made it: a version is created once and never changed."""
    files, at = _files(spark, f"{path.rstrip('/')}.schema/{version}")
    try:
        out = files.create(at, False)
    except Exception as error:
        if files.exists(at):
            raise RuntimeError(f"another writer has changed the columns of {path}: append again") from error
        raise
    try:
        out.write(bytearray(json.dumps(schema.jsonValue()).encode()))
    finally:
        out.close()


def appended_schema(spark: SparkSession, path: str) -> StructType:
    """The stored schema of an appended table, empty before the first append."""
    versions = _versions(spark, path)
    return versions[-1][1] if versions else StructType([])


def append_table(df: DataFrame, path: str) -> None:
    """Append rows; columns the table has not seen yet are allowed and are added to its stored schema.

    A column must keep its type. The schema is kept beside the table, so a read opens no footers to find it. Rows with new
    columns are written out of sight first, then the schema is published as its next version, then the files move in: a failure
    leaves no schema without its predecessor and no row half visible, and of two writers with new columns the slower is refused
    before any of its rows show. Rows without new columns need no version and are simply appended.
    """
    spark = df.sparkSession
    versions = _versions(spark, path)
    known = versions[-1][1] if versions else StructType([])
    kinds = {f.name: f.dataType for f in known}
    for field in df.schema:
        if kinds.get(field.name, field.dataType) != field.dataType:
            raise ValueError(f"{field.name} is {kinds[field.name].simpleString()} in the table")
    merged = StructType([*known.fields, *[StructField(f.name, f.dataType) for f in df.schema if f.name not in kinds]])
    if len(merged) == len(known):
        df.write.mode("append").parquet(path)
        return
    staged = f"{path.rstrip('/')}.staged/{uuid.uuid4().hex}"
    df.write.parquet(staged)
    files, folder = _files(spark, staged)
    try:
        _publish(spark, path, (versions[-1][0] if versions else 0) + 1, merged)
    except Exception:
        files.delete(folder, True)
        raise
    _, target = _files(spark, path)
    files.mkdirs(target)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("part-"):
            files.rename(status.getPath(), _files(spark, f"{path.rstrip('/')}/{name}")[1])
    files.delete(folder, True)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All appended rows with the union of their columns."""
    return spark.read.schema(appended_schema(spark, path)).parquet(path)


def flat_columns(df: DataFrame) -> list[str]:
    """Columns a CSV file can hold."""
    nested = (MapType, StructType, ArrayType, BinaryType)
    kept = [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]
    if not kept:
        raise ValueError("no column can be written to CSV")
    return kept


def export_csv(df: DataFrame, path: str, max_rows_per_file: int = MAX_CSV_ROWS, single_file: bool = False) -> list[str]:
    """CSV with header, empty text for NULL and ISO dates; files roll after ``max_rows_per_file`` rows.

    ``single_file`` writes with one task; it goes on in a next file too, so nothing is refused.
    """
    columns = flat_columns(df)
    flat = df.select(*columns)
    writer = (flat.coalesce(1) if single_file else flat).write.option("header", True).option("nullValue", "")
    writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.option("dateFormat", "yyyy-MM-dd").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path)
    return columns
