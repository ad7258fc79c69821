"""Linear models from sums of products.

A least-squares fit needs only the sums of products of its columns. Spark adds them up with partial
aggregation, so a segment with a third of all rows costs no more than the others, and one tiny solve per segment follows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.functions.columns import same_key


def moments(features: list[str], target: str, weight: Column | None = None) -> Column:
    """Aggregate: upper triangle of the products of (1, features, target) as one array."""
    cells = [F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(target).cast("double")]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*features, target]])
    factor = F.when(complete, F.lit(1.0) if weight is None else weight)
    products = [cells[i] * cells[j] for i in range(len(cells)) for j in range(i, len(cells))]
    return F.array(*[F.coalesce(F.sum(factor * p), F.lit(0.0)) for p in products])


def _square(flat, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = flat
    return full + np.triu(full, 1).T


def ridge_solution(flat, size: int, alpha: float) -> np.ndarray:
    """Intercept and coefficients of the ridge fit; the intercept is not penalised."""
    full = _square(np.asarray(flat, dtype=float), size)
    rows = full[0, 0]
    if rows <= 0:
        return np.zeros(size - 1)
    means = full[0, 1:] / rows
    centred = full[1:, 1:] - rows * np.outer(means, means)
    xx, xy = centred[:-1, :-1], centred[:-1, -1]
    slope = np.linalg.pinv(xx + alpha * np.eye(size - 2), hermitian=True) @ xy if size > 2 else np.zeros(0)
    return np.concatenate([[means[-1] - means[:-1] @ slope], slope])


def squared_error(flat, size: int, coefficients) -> float:
    """Sum of squared errors of given coefficients, from the same sums."""
    full = _square(np.asarray(flat, dtype=float), size)
    signed = np.concatenate([coefficients, [-1.0]])
    return float(max(signed @ full @ signed, 0.0))


def solve(sums: Column, features: int, alpha: float | Column) -> Column:
    """Coefficients (intercept first) of each row of sums."""
    size = features + 2

    @F.pandas_udf("array<double>")
    def run(flat: pd.Series, penalty: pd.Series) -> pd.Series:
        return pd.Series([ridge_solution(f, size, p).tolist() for f, p in zip(flat, penalty)])

    return run(sums, alpha if isinstance(alpha, Column) else F.lit(float(alpha)))


def segment_fit(df: DataFrame, segments: list[str], features: list[str], target: str, alpha: float = 0.0) -> DataFrame:
    """One ridge model per segment: segment columns, rows used and ``coef`` with the intercept first."""
    sums = df.groupBy(*segments).agg(moments(features, target).alias("_sums"))
    return sums.select(
        *segments, F.element_at("_sums", 1).cast("bigint").alias("rows"), solve(F.col("_sums"), len(features), alpha).alias("coef")
    )


def dot(features: list[str], coef: str = "coef") -> Column:
    """Intercept plus coefficients times features."""
    return sum(
        (F.element_at(coef, i + 2) * F.col(c).cast("double") for i, c in enumerate(features)), F.element_at(coef, 1)
    )


def on_segments(segments: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [same_key(F.col(s), F.col(f"{prefix}{s}")) for s in segments])


def with_models(df: DataFrame, models: DataFrame, segments: list[str], columns: list[str], how: str = "left") -> DataFrame:
    """Model columns beside the rows of their segment."""
    keyed = models.select(*[F.col(s).alias(f"_m_{s}") for s in segments], *columns)
    return df.join(keyed, on_segments(segments, "_m_"), how).drop(*[f"_m_{s}" for s in segments])


def unseen_segments(df: DataFrame, models: DataFrame, segments: list[str]) -> DataFrame:
    keyed = models.select(*[F.col(s).alias(f"_m_{s}") for s in segments])
    return df.select(*segments).distinct().join(keyed, on_segments(segments, "_m_"), "left_anti")


def segment_predict(df: DataFrame, models: DataFrame, segments: list[str], features: list[str], check: bool = True) -> DataFrame:
    """Predict every row with the model of its segment; a segment without a model raises when the rows are read.

    The check is part of the same pass. A segment with a large share of the rows is split by Spark's skew handling of the
    join, as only the few models are on the other side.
    """
    joined = with_models(df, models, segments, ["coef"])
    value = dot(features)
    if check:
        names = F.concat_ws(", ", *[F.col(s).cast("string") for s in segments])
        missing = F.raise_error(F.concat(F.lit("no model for segment "), names))
        value = F.when(F.col("coef").isNull(), missing).otherwise(value)
    return joined.withColumn("prediction", value).drop("coef")


def segment_config(segment_rows: DataFrame, configs: DataFrame, segments: list[str], default: str) -> DataFrame:
    """Configuration of each segment: by its tuple text, its values joined by ``__`` or its single value, else the default."""
    values = [F.col(s).cast("string") for s in segments]
    quoted = F.concat_ws(", ", *[F.concat(F.lit("'"), v, F.lit("'")) for v in values])
    tuple_text = F.concat(F.lit("("), quoted, F.lit(",)" if len(segments) == 1 else ")"))
    names = F.array(tuple_text, F.concat_ws("__", *values))
    named = segment_rows.select(*segments).distinct().select(*segments, F.posexplode(names).alias("_rank", "_name"))
    keyed = configs.select(F.col("segment_key").alias("_name"), "config")
    found = named.join(keyed, "_name", "left").groupBy(*segments)
    best = F.min(F.when(F.col("config").isNotNull(), F.struct("_rank", "config")))
    return found.agg(F.coalesce(best["config"], F.lit(default)).alias("config"))
