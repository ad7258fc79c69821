"""Cross-validation and successive halving of ridge models from one pass of sums, and tuning of tree learners."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.operators import linear


def sample_space(space: dict[str, tuple], number: int, seed: int) -> list[dict[str, float]]:
    """Configurations drawn from ranges ``(kind, low, high[, step])`` of kind uniform, loguniform, quniform or int."""
    rng = np.random.default_rng(seed)
    drawn = []
    for _ in range(number):
        config = {}
        for name, (kind, low, high, *step) in space.items():
            if kind == "uniform":
                config[name] = float(rng.uniform(low, high))
            elif kind == "loguniform":
                config[name] = float(math.exp(rng.uniform(math.log(low), math.log(high))))
            elif kind == "quniform":
                config[name] = float(round(rng.uniform(low, high) / step[0]) * step[0])
            elif kind == "int":
                config[name] = int(rng.integers(low, high))
            else:
                raise ValueError(f"unknown range {kind}")
        drawn.append(config)
    return drawn


def _add(arrays: list) -> np.ndarray:
    return np.sum([np.asarray(a, dtype=float) for a in arrays], axis=0)


def _mean_fold_rmse(folds: list[np.ndarray], size: int, alpha: float) -> float:
    """Mean over folds of the error of the model fitted on the other folds."""
    total, scores = _add(folds), []
    for held in folds:
        coefficients = linear.ridge_solution(total - held, size, alpha)
        scores.append(math.sqrt(linear.squared_error(held, size, coefficients) / max(held[0], 1.0)))
    return float(np.mean(scores))


def cross_validate(
    df: DataFrame, fold_col: str, features: list[str], target: str, alphas: list[float], by: list[str] | None = None
) -> DataFrame:
    """Mean fold error of every ridge penalty, the best one and its refit on all rows.

    The data is read once whatever the number of configurations: each fold sends one array of sums, and training sums are
    the total minus the fold.
    """
    by, size = list(by or []), len(features) + 2

    @F.pandas_udf("double")
    def score(folds: pd.Series, alpha: pd.Series) -> pd.Series:
        return pd.Series([_mean_fold_rmse([np.asarray(f, dtype=float) for f in fs], size, a) for fs, a in zip(folds, alpha)])

    @F.pandas_udf("array<double>")
    def refit(folds: pd.Series, alpha: pd.Series) -> pd.Series:
        return pd.Series([linear.ridge_solution(_add(list(fs)), size, a).tolist() for fs, a in zip(folds, alpha)])

    sums = df.groupBy(*by, fold_col).agg(linear.moments(features, target).alias("_sums"))
    per_group = sums.groupBy(*by).agg(F.collect_list("_sums").alias("_folds"))  # one entry per fold
    tried = per_group.select("*", F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha"))
    scored = tried.withColumn("rmse", score("_folds", "alpha"))
    best = scored.groupBy(*by).agg(F.min(F.struct("rmse", "alpha")).alias("_best"))
    marked = linear.with_models(scored, best, by, ["_best"]) if by else scored.withColumn("_best", best.scalar())
    return marked.select(
        *by, "alpha", "rmse", (F.col("_best.alpha") == F.col("alpha")).alias("best"), refit("_folds", "alpha").alias("coef")
    )


def successive_halving(
    df: DataFrame, keys: list[str], fold_col: str, features: list[str], target: str, alphas: list[float], factor: int = 3, seed: int = 0
) -> DataFrame:
    """Best share of the configurations per rung, each rung seeing ``factor`` times the rows of the one before.

    The samples are nested hash samples, so every row belongs to the first rung that sees it and all rungs
    come from one pass.
    """
    rungs = max(1, math.ceil(math.log(len(alphas), factor))) + 1 if len(alphas) > 1 else 1
    size = len(features) + 2
    place = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 13), 16, 10)
    share = place.cast("double") / float(16**13)
    rung: Column = F.lit(rungs - 1)
    for r in range(rungs - 2, -1, -1):
        rung = F.when(share < factor ** float(r - rungs + 1), r).otherwise(rung)
    sums = df.groupBy(rung.alias("_rung"), fold_col).agg(linear.moments(features, target).alias("_sums"))
    packed = sums.agg(F.collect_list(F.struct("_rung", F.col(fold_col).alias("_fold"), "_sums")).alias("_cells"))

    @F.pandas_udf("array<struct<alpha:double,rung:int,rmse:double>>")
    def race(cells: pd.Series) -> pd.Series:
        return pd.Series([_race(list(row), size, alphas, rungs, factor) for row in cells])

    return packed.select(F.explode(race("_cells")).alias("r")).select("r.alpha", "r.rung", "r.rmse")


def _race(cells: list, size: int, alphas: list[float], rungs: int, factor: int) -> list[dict]:
    """Last rung and score of every configuration."""
    alive, results = [float(a) for a in alphas], {}
    for rung in range(rungs):
        folds: dict = {}
        for cell in cells:
            if cell["_rung"] <= rung:
                folds.setdefault(cell["_fold"], []).append(cell["_sums"])
        held = [_add(parts) for _, parts in sorted(folds.items())]
        scores = {a: _mean_fold_rmse(held, size, a) if len(held) > 1 else float("inf") for a in alive}
        results |= {a: {"alpha": a, "rung": rung, "rmse": scores[a]} for a in alive}
        alive = sorted(alive, key=lambda a: (scores[a], a))[: max(1, math.ceil(len(alive) / factor))]
    return [results[float(a)] for a in alphas]
