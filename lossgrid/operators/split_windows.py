"""Windows along an order whose groups may be of any size: a hot group spans many tasks.

A plain window needs a whole group in one task. Here rows are dealt over ranges of (group, order), so a large group is cut into
several parts and small groups share one, and only what crosses a cut is exchanged: the last value before it (carried state), or
the few rows around it (halo). Parts then work alone. Where the cuts fall never shows in a result.

``order`` lists column names, each with " desc" if wanted. Nulls come first, last where descending. It must tell the rows of a
group apart; rows that it does not tell apart come in any order, as in a plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid.functions.columns import same_key
from lossgrid.session import materialise

PART, PLACE = "_part", "_place"


def _ordered(order: list[str]) -> list[Column]:
    return [F.col(o[:-5]).desc_nulls_last() if o.endswith(" desc") else F.col(o).asc_nulls_first() for o in order]


def dealt(df: DataFrame, by: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Rows with the number of their range of (group, order), ascending along each group, and their place in it, from 1.

    Written, as several branches read it and must agree on the ranges.
    """
    keys = [*[F.col(c).asc_nulls_first() for c in by], *_ordered(order)]
    cut = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    cut = materialise(cut.withColumn(PART, F.spark_partition_id()))
    return materialise(cut.withColumn(PLACE, F.row_number().over(Window.partitionBy(*by, PART).orderBy(*_ordered(order)))))


def _beside(rows: DataFrame, small: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Columns of a frame with at most one row per group and part beside the rows of that part."""
    renamed = small.select(*[F.col(c).alias(f"_s_{c}") for c in [*by, PART]], *columns)
    match = F.col(PART) == F.col(f"_s_{PART}")
    for c in by:
        match = match & same_key(F.col(c), F.col(f"_s_{c}"))
    return rows.join(renamed, match, "left").drop(*[f"_s_{c}" for c in [*by, PART]])


def along(df: DataFrame, by: list[str], order: list[str], filled: dict[str, str], summed: dict[str, str], parts: int | None = None) -> DataFrame:
    """Columns from ``filled`` (name: source), the last non-null value of the group up to and with each row, and from ``summed``, the
    sum of the non-null values so far, NULL before the first.

    Rows are dealt and written once for all of them and shuffled once more, to the windows of their parts. In a range at most one
    group goes on from the range before, so what is carried is a row per part at most, whatever the number of groups.
    """
    keys = [*[F.col(c).asc_nulls_first() for c in by], *_ordered(order)]
    cut = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    # the number is 2**33 times the partition's and the place in it, which goes on over all groups of the partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = materialise(cut.sortWithinPartitions(*keys).withColumns({PART: F.spark_partition_id(), PLACE: place}))
    last = [F.max_by(source, F.when(F.col(source).isNotNull(), F.col(PLACE))).alias(f"_own_{i}") for i, source in enumerate(filled.values())]
    total = [F.sum(source).alias(f"_sum_{i}") for i, source in enumerate(summed.values())]
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_own_{i}", ignorenulls=True).over(earlier).alias(f"_last_{i}") for i in range(len(filled))]
    carried += [F.sum(f"_sum_{i}").over(earlier).alias(f"_total_{i}") for i in range(len(summed))]
    ends = rows.groupBy(*by, PART).agg(*last, *total)
    later = ends.select(*by, PART, F.row_number().over(Window.partitionBy(*by).orderBy(PART)).alias("_nth"), *carried).where("_nth > 1").drop("_nth")
    inside = Window.partitionBy(*by, PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shown = rows.withColumns(
        {f"_in_last_{i}": F.last(source, ignorenulls=True).over(inside) for i, source in enumerate(filled.values())}
        | {f"_in_total_{i}": F.sum(source).over(inside) for i, source in enumerate(summed.values())}
    )
    names = [*[f"_last_{i}" for i in range(len(filled))], *[f"_total_{i}" for i in range(len(summed))]]
    joined = _beside(shown, materialise(later), by, names)
    out = {name: F.coalesce(f"_in_last_{i}", f"_last_{i}") for i, name in enumerate(filled)}
    for i, name in enumerate(summed):
        own, before = F.col(f"_in_total_{i}"), F.col(f"_total_{i}")
        out[name] = F.coalesce(own + before, own, before)
    return joined.withColumns(out).drop(*names, *[f"_in{c}" for c in names], PART, PLACE)


def forward_fill(df: DataFrame, by: list[str], order: list[str], column: str, into: str | None = None, parts: int | None = None) -> DataFrame:
    """The last non-null value of the group up to and with each row."""
    return along(df, by, order, {into or column: column}, {}, parts)


def running_sum(df: DataFrame, by: list[str], order: list[str], column: str, into: str, parts: int | None = None) -> DataFrame:
    """Sum of the non-null values of the group up to and with each row, NULL before the first."""
    return along(df, by, order, {}, {into: column}, parts)


def rolling(
    df: DataFrame, by: list[str], order: list[str], values: list[str], aggregates: dict[str, Column], before: int, after: int, parts: int | None = None,
) -> DataFrame:
    """Aggregates over the rows from ``before`` rows back to ``after`` rows ahead in the group.

    ``aggregates`` are aggregate expressions over ``values``. Each part borrows the last ``before`` rows before it and the
    first ``after`` rows behind it, from however many parts they lie in; at most ``before + after`` rows per group and part
    take part in that exchange.
    """
    rows = dealt(df, by, order, parts)
    ends = rows.groupBy(*by, PART).agg(F.max(PLACE).alias("_rows"))
    edges = _beside(rows.select(*by, PART, PLACE, *values), ends, by, ["_rows"])
    edges = edges.where((F.col(PLACE) <= after) | (F.col(PLACE) > F.col("_rows") - before) | (F.col(PLACE) == 1) | (F.col(PLACE) == F.col("_rows")))
    along = Window.partitionBy(*by).orderBy(PART, PLACE)
    row = F.struct(*[F.col(v).alias(v) for v in values])
    none = F.array().cast(f"array<{edges.select(row).schema[0].dataType.simpleString()}>")
    behind = F.collect_list(row).over(along.rowsBetween(-before, -1)) if before else none
    ahead = F.collect_list(row).over(along.rowsBetween(1, after)) if after else none
    seen = edges.withColumns({"_behind": behind, "_ahead": ahead})
    borrowed = seen.where(F.col(PLACE) == 1).select(*by, PART, F.posexplode("_behind").alias("_i", "_row"), F.size("_behind").alias("_n")).select(
        *by, PART, (F.col("_i") - F.col("_n") + 1).alias(PLACE), "_row.*"
    )
    borrowed = borrowed.unionByName(
        seen.where(F.col(PLACE) == F.col("_rows")).select(*by, PART, "_rows", F.posexplode("_ahead").alias("_i", "_row")).select(
            *by, PART, (F.col("_rows") + F.col("_i") + 1).alias(PLACE), "_row.*"
        )
    )
    whole = rows.withColumn("_own", F.lit(True)).unionByName(borrowed.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    around = Window.partitionBy(*by, PART).orderBy(PLACE).rowsBetween(-before, after)
    shown = whole.withColumns({name: aggregate.over(around) for name, aggregate in aggregates.items()})
    return shown.where("_own").drop("_own", PART, PLACE)
