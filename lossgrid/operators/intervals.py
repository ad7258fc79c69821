"""Interval joins on keys: points inside intervals, without spreading intervals over days or months.

An interval of length up to 2**L is placed in the buckets of width 2**L that hold its ends, one or two whatever its length. A point
looks up one bucket per level that occurs, so the join is an equality on (keys, level, bucket) and each side grows by a constant
factor. Both ends belong to the interval; rows with a null key or bound have no partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _number(value: Column, kind: str) -> Column:
    """Days of a date, microseconds of a timestamp, or the whole number itself."""
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("bigint")
    raise ValueError(f"intervals over {kind} are not supported: use a date, a timestamp or a whole number")


def _level(length: Column) -> Column:
    """The smallest L with 2**L >= length + 1: an interval then touches at most two buckets."""
    return F.when(length <= 0, 0).otherwise(F.length(F.bin(length))).cast("int")


def bucketed(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals with ``_level`` and ``_bucket``, one or two rows each; empty ones are dropped."""
    kind = intervals.schema[start].dataType.simpleString()
    low, high = _number(F.col(start), kind), _number(F.col(end), kind)
    placed = intervals.where(F.col(start) <= F.col(end)).withColumn("_level", _level(high - low))
    first, last = F.expr("shiftright(_low, _level)"), F.expr("shiftright(_high, _level)")
    held = placed.withColumns({"_low": low, "_high": high}).withColumn("_bucket", F.explode(F.array_distinct(F.array(first, last))))
    return held.drop("_low", "_high")


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """Inner join of points and intervals on equal keys and start <= at <= end.

    Column names other than the keys must differ. The levels that occur, at most 64, are the only thing the driver reads. Spark
    guesses the sizes of both sides from the files below them, a row per level not counted, so both are sorted and merged
    instead of one being sent through the driver on such a guess.
    """
    kind = points.schema[at].dataType.simpleString()
    if kind != intervals.schema[start].dataType.simpleString() or kind != intervals.schema[end].dataType.simpleString():
        raise ValueError("points and bounds need one type")
    placed = bucketed(intervals.dropna(subset=keys), start, end)
    levels = sorted(r[0] for r in placed.select("_level").distinct().collect())
    none = F.array().cast("array<int>")
    looked = points.dropna(subset=[*keys, at]).withColumn("_at", _number(F.col(at), kind))
    looked = looked.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels]) if levels else none))
    looked = looked.withColumn("_bucket", F.expr("shiftright(_at, _level)")).drop("_at")
    return looked.hint("merge").join(placed.hint("merge"), [*keys, "_level", "_bucket"]).where(F.col(at).between(F.col(start), F.col(end))).drop("_level", "_bucket")
