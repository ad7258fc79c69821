"""Exact ranks, running totals and percentiles that never sort one whole group in one task.

A window ordered over a group needs that group in a single task. Here equal values are merged first and dealt
over ranges of (group, value), so a large group is cut into many buckets and small groups share one. Only bucket
totals and single buckets are ordered; where the cuts fall never shows in the result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid.functions.columns import same_key
from lossgrid.session import materialise


def running_totals(
    df: DataFrame,
    value: str,
    totals: dict[str, Column],
    by: list[str] | None = None,
    ranks: Callable[[Column], list[Column]] | None = None,
) -> DataFrame:
    """One row per (by, value) with each total, ``<total>_before`` over smaller values and ``<total>_all``.

    The merged values feed the bucket totals and the result, so they are written once. With ``ranks``,
    a function from the number of rows ``n`` to the ranks of interest, only buckets that hold one are ordered.
    """
    by = list(by or [])
    names = list(totals)
    merged = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(*[expr.alias(name) for name, expr in totals.items()])
    placed = materialise(merged.repartitionByRange(*by, value).withColumn("_bucket", F.spark_partition_id()))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket_totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(n).alias(n) for n in names])
    offsets = bucket_totals.select(
        *[F.col(c).alias(f"_off_{c}") for c in by],
        F.col("_bucket").alias("_off_bucket"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_offset") for n in names],
        *[F.sum(n).over(group).alias(f"{n}_all") for n in names],
        *([F.col("n").alias("_rows")] if ranks else []),
    )
    if ranks:
        first = F.col("_n_offset")
        held = [(first <= rank) & (rank < first + F.col("_rows")) for rank in ranks(F.col("n_all"))]
        offsets = offsets.where(reduce(lambda a, b: a | b, held)).drop("_rows")
    same_bucket = reduce(
        lambda a, b: a & b,
        [same_key(F.col(c), F.col(f"_off_{c}")) for c in by],
        F.col("_bucket") == F.col("_off_bucket"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(offsets, same_bucket).select(
        *by,
        value,
        *names,
        *[(F.col(f"_{n}_offset") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(f"{n}_before") for n in names],
        *[f"{n}_all" for n in names],
    )


def _ranked_features(
    df: DataFrame, columns: list[str], by: list[str], ranks: Callable[[Column], list[Column]] | None = None
) -> DataFrame:
    """Rows (by, feature, x, n, n_before, n_all) of the finite values of all columns."""
    long = df.select(
        *by,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])
        ).alias("cell"),
    ).select(*by, "cell.feature", "cell.x")
    finite = long.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf")))
    return running_totals(finite, "x", {"n": F.count("*")}, by + ["feature"], ranks=ranks)


def exact_percentiles(
    df: DataFrame, columns: list[str], probabilities: list[float], by: list[str] | None = None
) -> DataFrame:
    """Linear-interpolated percentiles: one row per (by, feature) with columns ``p0, p1, ...`` and ``n``.

    All columns are ranked in one pass. NULL and non-finite values are left out.
    """
    by = list(by or [])
    positions = [lambda n, p=float(p): F.lit(p) * (n - 1) for p in probabilities]
    ranked = _ranked_features(df, columns, by, lambda n: [f(place(n)) for place in positions for f in (F.floor, F.ceil)])

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= index) & (index < F.col("n_before") + F.col("n")), F.col("x")))

    aggregates = []
    for i, place in enumerate(positions):
        position = place(F.col("n_all"))
        aggregates += [at(F.floor(position)).alias(f"_low{i}"), at(F.ceil(position)).alias(f"_high{i}")]
    grouped = ranked.groupBy(*by, "feature").agg(F.max("n_all").alias("n"), *aggregates)
    fractions = [place(F.col("n")) for place in positions]
    return grouped.select(
        *by,
        "feature",
        "n",
        *[
            (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * (f - F.floor(f))).alias(f"p{i}")
            for i, f in enumerate(fractions)
        ],
    )


def values_at_ranks(df: DataFrame, value: str, ranks: list[int], by: list[str] | None = None) -> DataFrame:
    """Rows (by, value, rank) holding the value at each zero-based rank, counting every row."""
    by = list(by or [])
    ranked = running_totals(df, value, {"n": F.count("*")}, by, ranks=lambda n: [F.lit(int(r)) for r in ranks])
    wanted = F.filter(
        F.array(*[F.lit(int(r)).cast("bigint") for r in ranks]),
        lambda r: (r >= F.col("n_before")) & (r < F.col("n_before") + F.col("n")),
    )
    return ranked.select(*by, value, F.explode(wanted).alias("rank"))


def even_knots(df: DataFrame, columns: list[str], knots: int) -> DataFrame:
    """Rows (feature, knot, value): ``knots`` evenly spaced exact percentiles of every column.

    Each value works out by integer division which knots fall on it, so the cost does not grow with the knots.
    """
    steps = max(knots - 1, 1)
    ranked = _ranked_features(df, columns, [])
    last = F.greatest(F.col("n_all") - 1, F.lit(1))
    first_rank, end_rank = F.col("n_before"), F.col("n_before") + F.col("n")

    def knots_up_to(rank: Column) -> Column:
        """Number of knots k in 0..steps whose position k * last / steps is below ``rank``."""
        below = F.when(rank <= 0, 0).otherwise(F.floor((rank * steps - 1) / last) + 1)
        return F.least(below.cast("bigint"), F.lit(steps + 1))

    def knots_at_most(rank: Column) -> Column:
        at_most = F.when(rank < 0, 0).otherwise(F.floor(rank * steps / last) + 1)
        return F.least(at_most.cast("bigint"), F.lit(steps + 1))

    def spread(side: str, start: Column, end: Column) -> Column:
        numbers = F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda k: F.struct(k.alias("knot"), F.lit(side).alias("side")))

    low = spread("low", knots_up_to(first_rank), knots_up_to(end_rank))
    high = spread("high", knots_at_most(first_rank - 1), knots_at_most(end_rank - 1))
    placed = ranked.select("feature", "x", "n_all", F.explode(F.concat(low, high)).alias("k")).select("feature", "x", "n_all", "k.*")
    bounds = placed.groupBy("feature", "knot").agg(
        F.max("n_all").alias("n_all"),
        F.max(F.when(F.col("side") == "low", F.col("x"))).alias("low"),
        F.max(F.when(F.col("side") == "high", F.col("x"))).alias("high"),
    )
    position = F.col("knot") * (F.col("n_all") - 1) / steps
    return bounds.select("feature", "knot", (F.col("low") + (F.col("high") - F.col("low")) * (position - F.floor(position))).alias("value"))
