"""Forecasts of monthly panels: trend with seasonality per cluster, and autoregression per series."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.functions.columns import months_since
from lossgrid.operators import linear
from lossgrid.operators.quality import fail_if_any, join_with_coverage

# Period in days and number of waves of the standard seasonalities.
SEASONALITIES = {"yearly_seasonality": (365.25, 10), "weekly_seasonality": (7.0, 3), "daily_seasonality": (1.0, 4)}
# Settings of a cluster that names none.
DEFAULTS = {"changepoint_range": "1.0", "changepoint_prior_scale": "0.05", "changepoint_nb_months_censored": "0"}
SEASONALITY_PRIOR = 10.0
REGRESSOR_PRIOR = 10.0

FIT_SCHEMA = (
    "first_day double, span double, level double, slope double, changepoints array<double>, bends array<double>, "
    "periods array<double>, sines array<double>, cosines array<double>, regressor_means array<double>, "
    "regressor_scales array<double>, regressor_coefs array<double>, scale double, rows bigint, noise double, bend_rate double, bend_size double"
)
SAMPLES, GAPS = 1000, 16


def _flag(config: dict, name: str) -> bool:
    return str(config.get(name, "")).lower() in ("true", "1")


def _waves(config: dict) -> list[float]:
    """Period of every sine and cosine pair."""
    orders = [value for name, value in SEASONALITIES.items() if _flag(config, name)]
    if config.get("seasonality_period") and config.get("seasonality_fourier_order"):
        orders.append((float(config["seasonality_period"]), int(float(config["seasonality_fourier_order"]))))
    return [period / k for period, order in orders for k in range(1, order + 1)]


def _changepoints(months: int, config: dict) -> np.ndarray:
    """Evenly spread trend breaks inside the leading share of the scaled history."""
    number = config.get("n_changepoints")
    if number is None and config.get("changepoint_nb_per_year"):
        used = max(1, months - int(float(config["changepoint_nb_months_censored"])))
        number = int(float(config["changepoint_nb_per_year"]) * used / 12)
    count = int(float(number or 0))
    return np.linspace(0, float(config["changepoint_range"]), count + 2)[1:-1]


def sparse_solution(gram: np.ndarray, cross: np.ndarray, ridge: np.ndarray, lasso: np.ndarray, sweeps: int = 400) -> np.ndarray:
    """Minimum of b'Gb/2 - c'b + sum(ridge b²)/2 + sum(lasso |b|), from sums of products alone.

    Coordinate descent finds which coefficients stay and their signs; for these the minimum is one linear system, and it is
    taken once its signs and the slopes of the others agree with it. Otherwise descent goes on from there.
    """
    full = gram + np.diag(ridge)
    beta, free = np.zeros(len(cross)), lasso == 0
    for _ in range(50):
        for _ in range(sweeps):
            before = beta.copy()
            for j in range(len(beta)):
                rest = cross[j] - full[j] @ beta + full[j, j] * beta[j]
                beta[j] = np.sign(rest) * max(abs(rest) - lasso[j], 0.0) / full[j, j] if full[j, j] > 0 else 0.0
            if np.abs(beta - before).max(initial=0.0) <= 1e-10 * max(np.abs(beta).max(initial=0.0), 1e-300):
                break
        kept = free | (beta != 0)
        signs = np.sign(beta)
        exact = np.zeros(len(beta))
        exact[kept] = np.linalg.lstsq(full[np.ix_(kept, kept)], cross[kept] - lasso[kept] * signs[kept], rcond=None)[0]
        slope = cross - full @ exact
        if (exact[kept & ~free] * signs[kept & ~free] > 0).all() and (np.abs(slope[~kept]) <= lasso[~kept] * (1 + 1e-9)).all():
            return exact
    return beta


def _fit_series(pdf: pd.DataFrame, keys: list[str], regressors: dict[str, float], sparse: bool = False) -> pd.DataFrame:
    """Penalised least squares of one monthly series; a prior scale becomes the penalty 1 / scale².

    With ``sparse``, the bends of the trend are penalised by |bend| / scale instead, so most of them are exactly zero, and
    the size of the noise is the one of the residuals, found in turns with the fit.
    """
    config = {**DEFAULTS, **{k: v for k, v in (pdf["config"].iloc[0] or {}).items() if v is not None}}
    days = pdf["day"].to_numpy(float)
    first, span = days.min(), max(days.max() - days.min(), 1.0)
    t = (days - first) / span
    breaks = _changepoints(int(round(span / 30.4375)) + 1, config)
    waves = np.array(_waves(config))
    # a series whose settings name regressors uses these alone, each with its own prior
    named = {k.removeprefix("regressor:"): float(v) for k, v in config.items() if k.startswith("regressor:")}
    regressors = {name: named.get(name, 0.0) for name in regressors} if named else regressors
    raw = pdf[list(regressors)].to_numpy(float).reshape(len(pdf), len(regressors))
    raw[:, [prior == 0 for prior in regressors.values()]] = 0.0
    y = pdf["y"].to_numpy(float)
    censored = int(float(config["changepoint_nb_months_censored"]))
    known = np.isfinite(y) & np.isfinite(raw).all(axis=1) & (pdf["months_left"].to_numpy(int) >= censored)
    means = raw[known].mean(axis=0) if known.any() else np.zeros(len(regressors))
    scales = raw[known].std(axis=0) if known.any() else np.ones(len(regressors))
    scales = np.where(scales == 0, 1.0, scales)
    angle = 2 * np.pi * days[:, None] / waves[None, :]
    design = np.hstack([
        np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - breaks[None, :], 0), np.sin(angle), np.cos(angle), (raw - means) / scales,
    ])
    priors = np.concatenate([
        [np.inf, 5.0], np.full(len(breaks), float(config["changepoint_prior_scale"])), np.full(2 * len(waves), SEASONALITY_PRIOR),
        np.array([p or 1.0 for p in regressors.values()], float),
    ])
    size = max(np.abs(y[known]).max(), 1e-12) if known.any() else 1.0
    x, noise = design[known], 0.05
    n, w = len(breaks), len(waves)
    products, cross, total = x.T @ x, x.T @ (y[known] / size), float(((y[known] / size) ** 2).sum())
    bends = np.zeros(len(priors), bool)
    bends[2 : 2 + n] = True

    def spread(beta: np.ndarray) -> float:
        """Size of the residuals, from the same sums."""
        return float(np.sqrt(max(total - 2 * beta @ cross + beta @ products @ beta, 0.0) / max(known.sum(), 1)))

    if sparse:
        for _ in range(20):
            beta = sparse_solution(products / noise**2, cross / noise**2, np.where(bends, 0.0, 1.0 / priors**2), np.where(bends, 1.0 / priors, 0.0))
            before, noise = noise, max(spread(beta), 1e-4)
            if abs(noise - before) <= 1e-3 * before:
                break
    else:
        beta = np.linalg.pinv(products / noise**2 + np.diag(1.0 / priors**2), hermitian=True) @ cross / noise**2
    row = {k: pdf[k].iloc[0] for k in keys} | {
        "first_day": first, "span": span, "level": beta[0], "slope": beta[1], "changepoints": breaks.tolist(), "bends": beta[2 : 2 + n].tolist(),
        "periods": waves.tolist(), "sines": beta[2 + n : 2 + n + w].tolist(), "cosines": beta[2 + n + w : 2 + n + 2 * w].tolist(),
        "regressor_means": means.tolist(), "regressor_scales": scales.tolist(), "regressor_coefs": beta[2 + n + 2 * w :].tolist(),
        "scale": float(size), "rows": int(known.sum()), "noise": spread(beta), "bend_rate": float(n), "bend_size": float(np.abs(beta[2 : 2 + n]).mean()) if n else 0.0,
    }
    return pd.DataFrame([row])


def _day(column: str) -> Column:
    return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("double")


def trend_seasonal_fit(
    panel: DataFrame,
    keys: list[str],
    time_col: str,
    target: str,
    regressors: dict[str, float] | None = None,
    configs: DataFrame | None = None,
    holidays: DataFrame | None = None,
    sparse: bool = False,
) -> DataFrame:
    """One fitted row per key; with ``sparse`` most bends of its trend are exactly zero.

    The panel is averaged to one row per key and date first, so the series a task holds is as long as
    the calendar and does not grow with the data. ``configs`` has the keys and a ``config`` map; entries
    ``regressor:<name>`` with a prior scale choose the regressors of a series among ``regressors`` (``holiday`` too).
    """
    regressors = dict(regressors or {})
    if holidays is not None:
        panel, regressors = with_holidays(panel, holidays, time_col), {**regressors, "holiday": REGRESSOR_PRIOR}
    monthly = panel.groupBy(*keys, F.to_date(time_col).alias("_date")).agg(
        F.avg(target).alias("y"), *[F.avg(r).alias(r) for r in regressors]
    )
    last = monthly.groupBy(*keys).agg(F.max("_date").alias("_last"))
    framed = linear.with_models(monthly, last, keys, ["_last"]).select(
        *keys, _day("_date").alias("day"), "y", *regressors, months_since(F.col("_last"), F.col("_date")).alias("months_left")
    )
    if configs is None:
        framed = framed.withColumn("config", F.lit(None).cast("map<string,string>"))
    else:
        framed = linear.with_models(framed, configs, keys, ["config"])
    key_schema = ", ".join(f"`{k}` {panel.schema[k].dataType.simpleString()}" for k in keys)
    return framed.groupBy(*keys).applyInPandas(lambda pdf: _fit_series(pdf, keys, regressors, sparse), f"{key_schema}, {FIT_SCHEMA}")


def with_holidays(df: DataFrame, holidays: DataFrame, time_col: str) -> DataFrame:
    """Indicator of the dates in ``holidays.date``."""
    marked = holidays.select(F.to_date("date").alias("_holiday")).distinct()
    joined = df.join(marked, F.to_date(time_col) == F.col("_holiday"), "left")
    return joined.withColumn("holiday", F.col("_holiday").isNotNull().cast("double")).drop("_holiday")


def trend_seasonal_predict(
    df: DataFrame, models: DataFrame, keys: list[str], time_col: str, regressors: list[str] | None = None, holidays: DataFrame | None = None,
    interval: float | None = None, samples: int = SAMPLES, seed: int = 42,
) -> DataFrame:
    """Forecast every row of ``df`` with the model of its key, as one projection; a key without a model raises.

    A missing regressor or date gives 0. ``interval`` (0.8, say) adds ``prediction_lower`` and ``prediction_upper``, see
    ``interval_offsets``.
    """
    names = list(regressors or [])
    if holidays is not None:
        df, names = with_holidays(df, holidays, time_col), [*names, "holiday"]
    columns = [c for c in models.columns if c not in keys]
    joined = linear.with_models(df, models, keys, columns)
    day = _day(time_col)
    t = (day - F.col("first_day")) / F.col("span")

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda a, b: a + b)

    bends = total(F.zip_with("changepoints", "bends", lambda s, d: F.greatest(t - s, F.lit(0.0)) * d))
    sines = total(F.zip_with("periods", "sines", lambda p, a: a * F.sin(day * (2 * float(np.pi)) / p)))
    cosines = total(F.zip_with("periods", "cosines", lambda p, a: a * F.cos(day * (2 * float(np.pi)) / p)))
    effects = sum(
        (
            F.element_at("regressor_coefs", i + 1) * (F.col(r) - F.element_at("regressor_means", i + 1)) / F.element_at("regressor_scales", i + 1)
            for i, r in enumerate(names)
        ),
        F.lit(0.0),
    )
    value = (F.col("level") + F.col("slope") * t + bends + sines + cosines + effects) * F.col("scale")
    labels = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    unknown = F.raise_error(F.concat(F.lit("no model for "), labels)).cast("double")
    predicted = joined.withColumn("prediction", F.when(F.col("scale").isNull(), unknown).otherwise(F.coalesce(value, F.lit(0.0)))).drop(*columns)
    if interval is None:
        return predicted
    offsets = interval_offsets(df.select(*keys, F.to_date(time_col).alias("_date")).distinct(), models, keys, interval, samples, seed)
    held = linear.with_models(predicted.withColumn("_date", F.to_date(time_col)), offsets, [*keys, "_date"], ["_low", "_high"])
    lower, upper = F.col("prediction") + F.coalesce("_low", F.lit(0.0)), F.col("prediction") + F.coalesce("_high", F.lit(0.0))
    return held.withColumn("prediction_lower", lower).withColumn("prediction_upper", upper).drop("_date", "_low", "_high")


def bend_paths(times: np.ndarray, rate: float, size: float, samples: int, seed: int) -> np.ndarray:
    """Trend change at each time after the history (1 is its end) in ``samples`` seeded futures: rows are futures.

    Bends come at random times, ``rate`` of them per length of the history, with Laplace sizes of mean ``size``. A future
    is drawn in blocks of bends until it reaches the last time, so a time's values do not depend on the other times.
    """
    out, at, block = np.zeros((samples, len(times))), np.ones(samples), 0
    while rate > 0 and size > 0 and len(times) and at.min() < times.max():
        rng = np.random.default_rng([seed, block])
        places = at[:, None] + np.cumsum(rng.exponential(1 / rate, (samples, GAPS)), axis=1)
        bends = rng.laplace(0, size, (samples, GAPS))
        for k in range(GAPS):
            out += bends[:, k, None] * np.maximum(times[None, :] - places[:, k, None], 0)
        at, block = places[:, -1], block + 1
    return out


def interval_offsets(dates: DataFrame, models: DataFrame, keys: list[str], interval: float, samples: int = SAMPLES, seed: int = 42) -> DataFrame:
    """(keys, _date, _low, _high): how far the bounds of a forecast lie from it, in units of the target.

    Within the history the spread is the noise of the fit; after it, seeded future bends as frequent and as large as the
    fitted ones are added. A task holds the distinct dates of one key, so at most a calendar.
    """
    edges = [(1 - interval) / 2, (1 + interval) / 2]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        name = ":".join(str(one[k]) for k in keys)
        mixed = zlib.crc32(f"{seed}:{name}".encode())
        days = (pd.to_datetime(pdf["_date"]) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(float)
        times = (days - one["first_day"]) / one["span"]
        paths = bend_paths(times, one["bend_rate"], one["bend_size"], samples, mixed)
        paths += np.random.default_rng([mixed, 1, 1]).normal(0, one["noise"], (samples, 1))
        low, high = np.quantile(paths, edges, axis=0) * one["scale"]
        return pdf[[*keys, "_date"]].assign(_low=low, _high=high)

    schema = ", ".join(f"`{k}` {dates.schema[k].dataType.simpleString()}" for k in keys)
    joined = linear.with_models(dates.where("_date is not null"), models, keys, ["first_day", "span", "scale", "noise", "bend_rate", "bend_size"], "inner")
    return joined.groupBy(*keys).applyInPandas(run, f"{schema}, _date date, _low double, _high double")


# --- autoregression -----------------------------------------------------------------------------------


def lagged_panel(panel: DataFrame, series: str, time_col: str, target: str, lags: int, steps: int) -> DataFrame:
    """Rows (series, month, step) with the target and the ``lags`` values known ``step`` months before.

    Every observation is sent to the months that use it, so a long series is spread over its months and no
    window holds it.
    """
    month = F.trunc(time_col, "MM")
    monthly = panel.groupBy(series, month.alias("month")).agg(F.avg(target).alias("y"))
    step = monthly.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    sent = step.select(series, "month", "y", "step", F.explode(F.sequence(F.lit(-1), F.lit(lags - 1))).alias("lag"))
    used = F.when(F.col("lag") < 0, F.col("month")).otherwise(F.add_months("month", F.col("step") + F.col("lag")))
    return (
        sent.withColumn("month", used)
        .groupBy(series, "month", "step")
        .agg(
            F.max(F.when(F.col("lag") == -1, F.col("y"))).alias("y"),
            *[F.max(F.when(F.col("lag") == i, F.col("y"))).alias(f"lag{i}") for i in range(lags)],
        )
    )


def ar_fit(
    panel: DataFrame, series: str, time_col: str, target: str, lags: int = 3, steps: int = 3, alpha: float = 1.0,
    regressors: DataFrame | None = None, regressor_names: list[str] | None = None,
) -> DataFrame:
    """One ridge autoregression per series and forecast step; a series with fewer than three months raises, as does a month without regressors."""
    names = list(regressor_names or [])
    lengths = panel.groupBy(series).agg(F.count_distinct(F.trunc(time_col, "MM")).alias("n"))
    fail_if_any(lengths, F.col("n") < 3, "series with fewer than three months")
    rows = lagged_panel(panel, series, time_col, target, lags, steps)
    if names:
        rows = join_with_coverage(rows.where("y is not null"), regressors.select("month", *names), ["month"])
    return linear.segment_fit(rows, [series, "step"], [*[f"lag{i}" for i in range(lags)], *names], "y", alpha)


def ar_forecast(
    panel: DataFrame, models: DataFrame, series: str, time_col: str, target: str, lags: int = 3, steps: int = 3,
    regressors: DataFrame | None = None, regressor_names: list[str] | None = None,
) -> DataFrame:
    """Forecast the next ``steps`` months; a month is the mean over the steps that can reach it."""
    names = list(regressor_names or [])
    unknown = linear.unseen_segments(panel, models, [series])
    fail_if_any(unknown, F.lit(True), "series without a model")
    last = panel.groupBy(series).agg(F.max(F.trunc(time_col, "MM")).alias("_last"))
    rows = lagged_panel(panel, series, time_col, target, lags, steps)
    future = linear.with_models(rows, last, [series], ["_last"]).where(
        (F.col("month") > F.col("_last")) & (months_since(F.col("month"), F.col("_last")) <= steps)
    )
    if names:
        future = join_with_coverage(future, regressors.select("month", *names), ["month"])
    scored = linear.with_models(future, models, [series, "step"], ["coef"], "inner")
    features = [*[f"lag{i}" for i in range(lags)], *names]
    return scored.withColumn("value", linear.dot(features)).groupBy(series, "month").agg(F.avg("value").alias("prediction"))
