"""Train, validate and batch-score a segmented model as Spark jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lossgrid.operators import linear, splits
from lossgrid.sources import sinks


def batch_score(
    df: DataFrame, models: DataFrame, segments: list[str], features: list[str], targets: list[str], date_col: str, train_size: float,
    model_id: str, scored_at: Column,
) -> DataFrame:
    """All rows with their split, prediction, model id and time, in one pass over the data."""
    labelled = splits.time_split(df, date_col, train_size)
    scored = linear.segment_predict(labelled, models, segments, features)
    return scored.select(
        *segments, date_col, *features, *targets, "split_name", "prediction", F.lit(model_id).alias("model_id"), scored_at.alias("ts")
    )


def append_scores(scored: DataFrame, path: str) -> DataFrame:
    sinks.append_table(scored, path)
    return sinks.read_appended(scored.sparkSession, path)


def score_learners(
    df: DataFrame, predictors: dict[str, Callable[[DataFrame], DataFrame]], keys: list[str], date_col: str, train_size: float, model_id: str, scored_at: Column,
    classes: dict[str, list] | None = None,
) -> DataFrame:
    """Rows of all splits scored for each target by any fitted learner: one row per (row, target), in one pass.

    A predictor adds ``prediction``, and ``probability`` by class for a classifier, whose labels ``classes`` names in order.
    The target's own value, the prediction and the probabilities (a map from label) come as text and map, so that targets of
    different types share one table. Rows without a prediction stay.
    """
    labelled = splits.time_split(df, date_col, train_size)
    parts = []
    for target, predict in predictors.items():
        scored = predict(labelled)
        names = (classes or {}).get(target)
        probability = F.lit(None).cast("map<string,double>")
        if names is not None:
            probability = F.when(F.col("probability").isNotNull(), F.map_from_arrays(F.array(*[F.lit(str(n)) for n in names]), "probability"))
        parts.append(scored.select(
            *keys, date_col, "split_name", F.lit(target).alias("target"), F.col(target).cast("string").alias("actual"), F.col("prediction").cast("string").alias("prediction"),
            probability.alias("probability"), F.lit(model_id).alias("model_id"), scored_at.alias("ts"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
