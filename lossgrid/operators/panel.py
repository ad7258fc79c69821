"""Panel forecasts: coefficients shared by all series, a shrunk offset per series, lagged and future regressors.

For every forecast step the model is y = a + w x + u[series], with penalties ``alpha`` on w and ``shrink`` on the offsets.
Given w, an offset is the mean residual of its series, shrunk; put back, the system for (a, w) needs only each series' sums of
products. So the fit is two aggregations, series by series and then over all of them, and one small solve per step.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.functions.columns import months_since
from lossgrid.operators import linear
from lossgrid.operators.quality import fail_if_any


def feature_names(lags: int, lagged: list[str], lagged_lags: int, future: list[str]) -> list[str]:
    return [*[f"y_lag{i}" for i in range(lags)], *[f"{r}_lag{i}" for r in lagged for i in range(lagged_lags)], *future]


def design(
    panel: DataFrame, series: str, time_col: str, target: str, lags: int, steps: int,
    lagged: list[str] | None = None, lagged_lags: int = 1, future: list[str] | None = None, ahead: DataFrame | None = None,
) -> DataFrame:
    """Rows (series, month, step, y, features): what is known of a month ``step`` months before it, and its own future regressors.

    Several rows of a month are averaged. Every observation is sent to the months that use it, so no window holds a series.
    ``ahead`` (series, month, future regressors) describes months after the history, one row each.
    """
    lagged, future = list(lagged or []), list(future or [])
    longest = max(lags, lagged_lags if lagged else 0)
    wanted = list(dict.fromkeys([*lagged, *future]))
    monthly = panel.groupBy(series, F.trunc(time_col, "MM").alias("month")).agg(F.avg(target).alias("y"), *[F.avg(r).alias(r) for r in wanted])
    if ahead is not None and future:
        rest = [F.lit(None).cast("double").alias(r) for r in wanted if r not in future]
        known = ahead.groupBy(series, F.trunc("month", "MM").alias("month")).agg(*[F.avg(r).alias(r) for r in future])
        later = linear.with_models(known, monthly.select(series, "month", F.lit(True).alias("_known")), [series, "month"], ["_known"]).where("_known is null")
        monthly = monthly.unionByName(later.select(series, "month", F.lit(None).cast("double").alias("y"), *future, *rest))
    sent = monthly.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")).select(
        "*", F.explode(F.sequence(F.lit(-1), F.lit(longest - 1)) if longest else F.array(F.lit(-1))).alias("_lag")
    )
    used = F.when(F.col("_lag") < 0, F.col("month")).otherwise(F.add_months("month", F.col("step") + F.col("_lag")))

    def at(lag: int, column: str) -> Column:
        return F.max(F.when(F.col("_lag") == lag, F.col(column)))

    return sent.withColumn("month", used).groupBy(series, "month", "step").agg(
        at(-1, "y").alias("y"), *[at(i, "y").alias(f"y_lag{i}") for i in range(lags)],
        *[at(i, r).alias(f"{r}_lag{i}") for r in lagged for i in range(lagged_lags)], *[at(-1, r).alias(r) for r in future],
    )


def _complete(features: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in ["y", *features]])


def panel_fit(
    panel: DataFrame, series: str, time_col: str, target: str, lags: int = 3, steps: int = 3, lagged: list[str] | None = None, lagged_lags: int = 1,
    future: list[str] | None = None, alpha: float = 1.0, shrink: float = 1.0,
) -> DataFrame:
    """One row per (series, step): ``coef`` (intercept first, the same for all series), ``offset`` and ``rows``.

    A series with fewer than three months raises. Months with a missing feature take no part; a series without any complete
    month has offset 0.
    """
    lengths = panel.groupBy(series).agg(F.count_distinct(F.trunc(time_col, "MM")).alias("n"))
    fail_if_any(lengths, F.col("n") < 3, "series with fewer than three months")
    features = feature_names(lags, list(lagged or []), lagged_lags, list(future or []))
    rows = design(panel, series, time_col, target, lags, steps, lagged, lagged_lags, future).where(_complete(features))
    size = len(features) + 2
    places = {pair: k for k, pair in enumerate((i, j) for i in range(size) for j in range(i, size))}
    sums = rows.groupBy(series, "step").agg(linear.moments(features, "y").alias("_sums"), F.count("*").alias("rows"))

    def cell(i: int, j: int) -> Column:
        return F.col("_sums")[places[i, j]]

    # sums over series of their products less those of their sums, shrunk
    shared = sums.groupBy("step").agg(F.array(*[
        F.sum(cell(i, j) - cell(0, i) * cell(0, j) / (F.col("rows") + shrink)) for i in range(size) for j in range(i, size)
    ]).alias("_shared"))

    @F.pandas_udf("array<double>")
    def solve(flats: pd.Series) -> pd.Series:
        def one(flat) -> list[float]:
            full = linear._square(np.asarray(flat, float), size)
            penalty = np.diag([0.0, *[alpha] * len(features)])
            return (np.linalg.pinv(full[:-1, :-1] + penalty, hermitian=True) @ full[:-1, -1]).tolist()

        return pd.Series([one(f) for f in flats])

    coefs = shared.select("step", solve("_shared").alias("coef"))
    every = lengths.select(series, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")).join(coefs, "step")
    residual = F.col("_sums")[places[0, size - 1]] - sum((F.element_at("coef", i + 1) * F.col("_sums")[places[0, i]] for i in range(size - 1)), F.lit(0.0))
    with_sums = linear.with_models(every, sums, [series, "step"], ["_sums", "rows"])
    return with_sums.select(series, "step", "coef", F.coalesce(residual / (F.col("rows") + shrink), F.lit(0.0)).alias("offset"), F.coalesce("rows", F.lit(0)).alias("rows"))


def panel_forecast(
    panel: DataFrame, models: DataFrame, series: str, time_col: str, target: str, lags: int = 3, steps: int = 3, lagged: list[str] | None = None,
    lagged_lags: int = 1, future: list[str] | None = None, ahead: DataFrame | None = None,
) -> DataFrame:
    """(series, month, prediction) of the next ``steps`` months; a month is the mean over the steps that can reach it.

    Raises for a series without a model and where ``ahead`` lacks a future regressor of one of these months. A month whose
    history has a gap in every lag window is NULL.
    """
    future = list(future or [])
    fail_if_any(linear.unseen_segments(panel, models, [series]), F.lit(True), "series without a model")
    last = panel.groupBy(series).agg(F.max(F.trunc(time_col, "MM")).alias("_last"))
    wanted = last.select(series, F.explode(F.expr(f"sequence(add_months(_last, 1), add_months(_last, {steps}), interval 1 month)")).alias("month"))
    if future:
        if ahead is None:
            raise ValueError("future regressors need the months ahead")
        known = ahead.where(reduce(lambda a, b: a & b, [F.col(r).isNotNull() for r in future])).select(series, F.trunc("month", "MM").alias("month")).distinct()
        covered = linear.with_models(wanted, known.withColumn("_known", F.lit(True)), [series, "month"], ["_known"])
        fail_if_any(covered, F.col("_known").isNull(), f"months ahead without {future}")
    features = feature_names(lags, list(lagged or []), lagged_lags, future)
    rows = design(panel, series, time_col, target, lags, steps, lagged, lagged_lags, future, ahead)
    dated = linear.with_models(rows, last, [series], ["_last"]).where((F.col("month") > F.col("_last")) & (months_since(F.col("month"), F.col("_last")) <= steps))
    scored = linear.with_models(dated, models, [series, "step"], ["coef", "offset"], "inner")
    means = scored.groupBy(series, "month").agg(F.avg(linear.dot(features) + F.col("offset")).alias("prediction"))
    return linear.with_models(wanted, means, [series, "month"], ["prediction"])
