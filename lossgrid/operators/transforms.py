"""Feature and target transformers: fitting is an aggregate, transforming a projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.operators.order_stats import even_knots, exact_percentiles, running_totals

@dataclass(frozen=True)
class Fitted:
    """Fitted transformer: output columns per input column, and the inverse where there is one."""

    forward: dict[str, Callable[[Column], Column]]
    inverse: dict[str, Callable[[Column], Column]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: change(F.col(name)) for name, change in self.forward.items()})

    def invert(self, df: DataFrame, column: str, fitted_as: str | None = None) -> DataFrame:
        """Undo the transform on ``column``, for example on predictions of the target ``fitted_as``."""
        return df.withColumn(column, self.inverse[fitted_as or column](F.col(column)))


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL, so that fits leave it out."""
    x = F.col(column)
    return F.when(~F.isnan(x), x) if df.schema[column].dataType.typeName() in ("float", "double") else x


def _affine(shifts: dict[str, float], scales: dict[str, float]) -> Fitted:
    scales = {c: 1.0 if not scales[c] else float(scales[c]) for c in scales}
    shifts = {c: 0.0 if shifts[c] is None else shifts[c] for c in shifts}  # a column of NULLs stays one
    return Fitted(
        {c: (lambda x, s=float(shifts[c]), w=scales[c]: (x - F.lit(s)) / F.lit(w)) for c in shifts},
        {c: (lambda x, s=float(shifts[c]), w=scales[c]: x * F.lit(w) + F.lit(s)) for c in shifts},
    )


def fit_min_max(df: DataFrame, columns: list[str]) -> Fitted:
    row = df.agg(*[f(known(df, c)).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return _affine({c: row[f"lo_{c}"] for c in columns}, {c: (row[f"hi_{c}"] or 0) - (row[f"lo_{c}"] or 0) for c in columns})


def fit_standard(df: DataFrame, columns: list[str]) -> Fitted:
    row = df.agg(*[f(known(df, c)).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]).first()
    return _affine({c: row[f"mean_{c}"] for c in columns}, {c: row[f"sd_{c}"] for c in columns})


def percentile_rows(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float]]:
    """Exact percentiles of every column, one small row per column."""
    found = exact_percentiles(df, columns, probabilities).collect()
    return dict.fromkeys(columns, [None] * len(probabilities)) | {r["feature"]: [r[f"p{i}"] for i in range(len(probabilities))] for r in found}


def fit_robust(df: DataFrame, columns: list[str]) -> Fitted:
    points = percentile_rows(df, columns, [0.25, 0.5, 0.75])
    return _affine({c: points[c][1] for c in columns}, {c: (points[c][2] or 0) - (points[c][0] or 0) for c in columns})


def segment_robust_scales(df: DataFrame, columns: list[str], segments: list[str]) -> DataFrame:
    """Median and interquartile range (1 where it is zero) per segment and feature."""
    points = exact_percentiles(df, columns, [0.25, 0.5, 0.75], segments)
    spread = F.col("p2") - F.col("p0")
    return points.select(*segments, "feature", F.col("p1").alias("center"), F.when(spread == 0, 1.0).otherwise(spread).alias("scale"))


def fit_quantile(df: DataFrame, columns: list[str], quantiles: int = 1000) -> Fitted:
    """Map values to the uniform distribution through at most ``quantiles`` exact knots."""
    rows = df.agg(*[F.count(known(df, c)).alias(c) for c in columns]).first()
    counts = {c: max(1, min(quantiles, rows[c])) for c in columns}
    forward = {}
    for count in sorted(set(counts.values())):  # one ranking for all columns, but for those with fewer values than knots
        alike = [c for c in columns if counts[c] == count]
        found = {(r["feature"], r["knot"]): r["value"] for r in even_knots(df, alike, count).collect()}  # ``quantiles`` rows a column at most
        levels = [float(p) for p in np.linspace(0, 1, count)]
        forward |= {c: _quantile_map([found[c, k] for k in range(count)], levels) if (c, 0) in found else (lambda x: x.cast("double")) for c in alike}
    return Fitted({c: forward[c] for c in columns})


def _quantile_map(knots: list[float], levels: list[float]) -> Callable[[Column], Column]:
    @F.pandas_udf("double")
    def to_uniform(x: pd.Series) -> pd.Series:
        low = np.interp(x, knots, levels)
        high = np.interp(-x, [-k for k in reversed(knots)], [-p for p in reversed(levels)])
        return pd.Series(np.where(x.isna(), np.nan, 0.5 * (low - high)))

    return lambda x: to_uniform(x.cast("double"))


#: Most categories that become columns of their own.
MAX_CATEGORIES = 1000


def categories(df: DataFrame, column: str) -> list:
    """Sorted categories, one value each: they become the names of output columns. More than ``MAX_CATEGORIES`` raise."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()]
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} categories: use one_hot_vector, which makes two columns for any number")
    return sorted(found)


def one_hot_vector(df: DataFrame, column: str) -> DataFrame:
    """``column_size`` and ``column_index``: length of the indicator vector and the place of its single 1, for any number of categories.

    NULL has no place. This is the sparse form of ``one_hot``; nothing but two numbers per row is built.
    """
    codes = ordinal_codes(df, column).where(F.col(column).isNotNull())
    first = codes.agg(F.min("code")).scalar()
    size = codes.agg(F.count("*")).scalar()
    placed = df.join(codes, column, "left").withColumn(f"{column}_index", (F.col("code") - first).cast("bigint"))
    return placed.drop("code").withColumn(f"{column}_size", size)


def one_hot(df: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """Indicator column per category; for columns with very many categories there is ``one_hot_vector``."""
    values = categories(df, column) if values is None else values
    return df.select("*", *[(F.col(column) == v).cast("int").alias(f"{column}_{v}") for v in values])


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """(category, code) with codes by sorted category, for any number of categories."""
    ranked = running_totals(df.select(column).distinct(), column, {"n": F.count("*")})
    return ranked.select(column, F.col("n_before").alias("code"))


def ordinal(df: DataFrame, column: str) -> DataFrame:
    """Replace categories by their codes through an equi-join; the codes hold one row per category."""
    return df.join(ordinal_codes(df, column), column, "left").withColumnRenamed("code", f"{column}_code")


def fit_impute(df: DataFrame, columns: list[str], strategy: str, constant=None) -> Fitted:
    """Fill NULLs and NaN with the mean, median, most frequent (smallest on ties) or a constant value."""
    if strategy == "constant":
        values = dict.fromkeys(columns, constant)
    elif strategy == "mean":
        row = df.agg(*[F.avg(known(df, c)).alias(c) for c in columns]).first()
        values = row.asDict()
    elif strategy == "median":
        values = {c: p[0] for c, p in percentile_rows(df, columns, [0.5]).items()}
    elif strategy == "most_frequent":
        values = most_frequent_values(df, columns)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    floating = {c for c in columns if df.schema[c].dataType.typeName() in ("float", "double")}
    return Fitted({c: (lambda x, v=values[c], f=c in floating: F.coalesce(F.nanvl(x, F.lit(None).cast("double")) if f else x, F.lit(v))) for c in columns})


def most_frequent_values(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """The most frequent value of each column, the smallest on ties: one pass for all columns of a type, nothing is sorted."""
    values: dict[str, object] = dict.fromkeys(columns)
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    for kind in sorted(set(kinds.values())):
        alike = [c for c in columns if kinds[c] == kind]
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), known(df, c).alias("value")) for c in alike]))
        counts = df.select(cells.alias("cell")).select("cell.*").where(F.col("value").isNotNull()).groupBy("feature", "value").agg((-F.count("*")).alias("n"))
        values |= {r["feature"]: r["best"]["value"] for r in counts.groupBy("feature").agg(F.min(F.struct("n", "value")).alias("best")).collect()}
    return values


def fit_log1p(columns: list[str]) -> Fitted:
    return Fitted(dict.fromkeys(columns, F.log1p), dict.fromkeys(columns, F.expm1))


def fit_clip(
    df: DataFrame, columns: list[str], strategy: str = "percentile", lower: float | None = None, upper: float | None = None
) -> Fitted:
    """Clip to percentiles (default 1 and 99), to the median plus and minus half the range, or to fixed values."""
    if strategy == "percentile":
        levels = [(1.0 if lower is None else lower) / 100, (99.0 if upper is None else upper) / 100]
        bounds = {c: tuple(p) for c, p in percentile_rows(df, columns, levels).items()}
    elif strategy == "median_range":
        points = percentile_rows(df, columns, [0.0, 0.5, 1.0])
        bounds = {c: (None, None) if m is None else (m - (hi - lo) / 2, m + (hi - lo) / 2) for c, (lo, m, hi) in points.items()}
    elif strategy == "fixed_values":
        bounds = dict.fromkeys(columns, (float("-inf") if lower is None else lower, float("inf") if upper is None else upper))
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return Fitted(
        {c: (lambda x, b=bounds[c]: _clipped(x, *b)) for c in columns}
    )


def _clipped(x: Column, low: float | None, high: float | None) -> Column:
    """NULL and NaN stay; a bound that is NULL, of a column without values, does not clip."""
    inside = F.greatest(F.least(x, F.lit(high).cast("double")), F.lit(low).cast("double"))
    return F.when(x.isNull() | F.isnan(x.cast("double")), x).otherwise(inside)


Fit = Callable[[DataFrame, list[str]], Fitted]


def column_transformer(df: DataFrame, blocks: list[tuple[list[Fit], list[str]]], discard: list[str] | None = None) -> tuple[DataFrame, list[Fitted]]:
    """Fit chains of transformers on lists of features and apply them; other columns pass through."""
    named = [c for _, columns in blocks for c in columns]
    repeated = {c for c in named if named.count(c) > 1} | (set(named) & set(discard or []))
    if repeated:
        raise ValueError(f"features used twice: {sorted(repeated)}")
    fitted: list[list[Fitted]] = [[] for _ in blocks]
    for level in range(max((len(chain) for chain, _ in blocks), default=0)):
        # blocks share no feature, so equal steps of a level are fitted together: scans grow with levels and kinds of steps alone
        wanted: dict[Fit, list[int]] = {}
        for i, (chain, _) in enumerate(blocks):
            if level < len(chain):
                wanted.setdefault(chain[level], []).append(i)
        forward: dict[str, Callable[[Column], Column]] = {}
        for fit, places in wanted.items():
            step = fit(df, [c for i in places for c in blocks[i][1]])
            forward |= step.forward
            for i in places:
                fitted[i].append(Fitted({c: step.forward[c] for c in blocks[i][1]}, {c: step.inverse[c] for c in blocks[i][1] if c in step.inverse}))
        df = Fitted(forward).transform(df)
    return df.drop(*(discard or [])), [step for steps in fitted for step in steps]
