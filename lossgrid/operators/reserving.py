"""Reserving models: chain ladder and the per-segment robust regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid import constants as K
from lossgrid.functions.columns import ratio
from lossgrid.operators import linear
from lossgrid.operators.transforms import segment_robust_scales
from lossgrid.session import materialise


def age_to_age(triangle: DataFrame, cumulative: str, segments: list[str], occurrence: str = K.OCCURRENCE_COL, lag: str = "lag") -> DataFrame:
    """Ratio of the next cumulative value to the current one, NULL without a next value or a positive current one."""
    along = Window.partitionBy(*segments, occurrence).orderBy(lag)
    following = F.lead(cumulative).over(along)
    return triangle.withColumn("ratio", F.when(F.col(cumulative) > 0, ratio(following, F.col(cumulative))))


def chain_ladder_fit(
    triangle: DataFrame, cumulative: str, segments: list[str], occurrence: str = K.OCCURRENCE_COL, lag: str = "lag"
) -> DataFrame:
    """Mean age-to-age factor per segment and lag, and the factor to ultimate as the product over later lags."""
    ratios = age_to_age(triangle, cumulative, segments, occurrence, lag)
    means = ratios.groupBy(*segments, lag).agg(F.coalesce(F.avg("ratio"), F.lit(1.0)).alias("factor"))
    from_here = Window.partitionBy(*segments).orderBy(F.desc(lag)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return means.withColumn("to_ultimate", F.product("factor").over(from_here))


def chain_ladder_predict(df: DataFrame, factors: DataFrame, cumulative: str, segments: list[str], lag: str = "lag") -> DataFrame:
    """Cumulative times the factor to ultimate; an unknown segment or lag has factor 1."""
    keyed = linear.with_models(df, factors, [*segments, lag], ["to_ultimate"])
    factor = F.coalesce(F.col("to_ultimate"), F.lit(1.0))
    return keyed.withColumn("prediction", F.col(cumulative) * factor).drop("to_ultimate")


# Settings of the robust regression.
HUBER_DELTA = 1.5


def _scaled(df: DataFrame, features: list[str], target: str, segments: list[str]) -> tuple[DataFrame, DataFrame]:
    """Robust-scaled rows and the scales per segment, as a map of at most one entry per column.

    The scales are written, so their join knows their size: few of them go to the rows, not the rows to them.
    """
    columns = [*features, target]
    long = segment_robust_scales(df, columns, segments)
    scales = materialise(long.groupBy(*segments).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("center", "scale")))).alias("scales")
    ))
    return linear.with_models(df, scales, segments, ["scales"], "inner").select(
        *segments, *[_standard(c).alias(c) for c in columns]
    ), scales


def _standard(column: str) -> Column:
    scale = F.element_at("scales", F.lit(column))
    return (F.col(column) - scale["center"]) / scale["scale"]


def huber_fit(
    df: DataFrame,
    features: list[str],
    target: str,
    segments: list[str],
    delta: float = HUBER_DELTA,
    alpha: float = 1e-3,
    rounds: int = 15,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Huber regression per segment on robust-scaled columns, by reweighted sums of products.

    ``rounds`` and ``converged`` tell per segment whether the last round still moved its coefficients.
    Each round is one aggregate over the scaled rows and a small solve; the scaled rows and the models of
    each round are written to the shared folder, so a lost executor replays one round only.
    """
    rows = materialise(df.dropna(subset=[*features, target]).select(*segments, *features, target))
    scaled, scales = _scaled(rows, features, target, segments)
    scaled = materialise(scaled)
    models = materialise(linear.segment_fit(scaled, segments, features, target, alpha))
    used = 0
    for used in range(1, rounds + 1):
        error = F.abs(F.col(target) - linear.dot(features))
        weight = F.when(error <= delta, 1.0).otherwise(F.lit(delta) / error)
        weighted = linear.with_models(scaled, models, segments, ["coef"], "inner").withColumn("_weight", weight)
        sums = weighted.groupBy(*segments).agg(
            linear.moments(features, target, F.col("_weight")).alias("_sums"), F.count("*").alias("rows"), F.first("coef").alias("_old")
        )
        solved = sums.select(*segments, "rows", "_old", linear.solve(F.col("_sums"), len(features), alpha).alias("coef"))
        step = F.array_max(F.zip_with("coef", "_old", lambda a, b: F.abs(a - b)))
        models = materialise(solved.withColumn("step", step).drop("_old"))
        if (models.agg(F.max("step")).first()[0] or 0.0) < tolerance:
            break
    if used:
        models = models.withColumn("converged", F.coalesce(F.col("step") < tolerance, F.lit(True))).drop("step")
    else:
        models = models.withColumn("converged", F.lit(False))
    return linear.with_models(models.withColumn("rounds", F.lit(used)), scales, segments, ["scales"], "inner")


def huber_predict(df: DataFrame, models: DataFrame, features: list[str], target: str, segments: list[str]) -> DataFrame:
    """Predictions in the units of the target; NULL for a segment without a model."""
    joined = linear.with_models(df, models, segments, ["coef", "scales"])
    value = sum(
        (F.element_at("coef", i + 2) * _standard(c) for i, c in enumerate(features)), F.element_at("coef", 1)
    )
    scale = F.element_at("scales", F.lit(target))
    return joined.withColumn("prediction", value * scale["scale"] + scale["center"]).drop("coef", "scales")
