"""Scores, metric gates, metric tables and batch scoring. Every score is one aggregate."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid.functions.columns import probability_map, ratio
from lossgrid.operators.order_stats import running_totals

HIGHER_IS_BETTER = {
    "rmse": False, "mse": False, "r2": True, "explained_variance": True, "accuracy": True, "precision": True,
    "recall": True, "f1": True, "roc_auc": True, "false_positives": False, "false_negatives": False,
}


def regression_metrics(df: DataFrame, truth: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """rmse, mse, r2 and explained variance."""
    y, error = F.col(truth).cast("double"), F.col(truth).cast("double") - F.col(prediction)
    sums = df.groupBy(*(by or [])).agg(
        F.avg(error * error).alias("mse"), F.var_pop(error).alias("_var_error"), F.var_pop(y).alias("_var_y")
    )
    return sums.select(
        *(by or []),
        F.sqrt("mse").alias("rmse"),
        "mse",
        (1 - ratio(F.col("mse"), F.col("_var_y"))).alias("r2"),
        (1 - ratio(F.col("_var_error"), F.col("_var_y"))).alias("explained_variance"),
    )


def classification_metrics(df: DataFrame, truth: str, prediction: str, positive=1) -> DataFrame:
    """Binary scores from one confusion count; false counts are zero when a single label occurs."""
    pairs = df.where(F.col(truth).isNotNull() & F.col(prediction).isNotNull())
    others = [F.when(F.col(c) != F.lit(positive), F.col(c)) for c in (truth, prediction)]
    t, p = F.col(truth) == F.lit(positive), F.col(prediction) == F.lit(positive)
    counts = pairs.agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"),
        F.least(F.min(truth), F.min(prediction)).alias("_low"), F.greatest(F.max(truth), F.max(prediction)).alias("_high"),
        F.least(*[F.min(c) for c in others]).alias("_lowest"), F.greatest(*[F.max(c) for c in others]).alias("_highest"),
    )
    one_other = F.coalesce(F.col("_lowest") == F.col("_highest"), F.lit(True))
    counts = counts.where(F.when(one_other, True).otherwise(F.raise_error(F.lit("binary scores need two labels"))))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    one_label = F.col("_low") == F.col("_high")
    return counts.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        F.when(one_label, 0).otherwise(fp).alias("false_positives"),
        F.when(one_label, 0).otherwise(fn).alias("false_negatives"),
    )


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the curve as the share of (positive, negative) pairs in the right order, ties counting half."""
    totals = running_totals(
        df, score, {"pos": F.count_if(F.col(truth) == 1).cast("double"), "neg": F.count_if(F.col(truth) == 0).cast("double")}
    )
    return totals.agg(
        ratio(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)), F.max("pos_all") * F.max("neg_all")).alias("roc_auc")
    )


def threshold_sweep(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Scores at the thresholds 0.01 to 0.99, from a histogram of the score and its running sums.

    A row is positive at a threshold when its score is greater, so its bin is the number of thresholds below it.
    """
    below = F.least(F.greatest(F.ceil(F.round(F.col(score) * 100, 9)) - 1, F.lit(0)), F.lit(99)).cast("int")
    bins = df.groupBy(below.alias("bin")).agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))
    # 100 bins at most: the windows below see no data rows
    grid = df.sparkSession.range(0, 100).select(F.col("id").cast("int").alias("bin"))
    dense = grid.join(bins, "bin", "left").fillna(0)
    from_here = Window.partitionBy(F.lit(0)).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    counted = dense.select(
        (F.col("bin") / 100).alias("threshold"),
        F.sum("pos").over(from_here).alias("tp"),
        F.sum("neg").over(from_here).alias("fp"),
        F.sum("pos").over(everything).alias("_pos"),
        F.sum("neg").over(everything).alias("_neg"),
    ).where("threshold > 0")
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("_pos") - tp, F.col("_neg") - fp
    return counted.select(
        "threshold",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
    )


def best_threshold(sweep: DataFrame, metric: str) -> DataFrame:
    """Threshold with the best score, the smallest one on ties."""
    best = F.desc(metric) if HIGHER_IS_BETTER[metric] else F.asc(metric)
    return sweep.orderBy(best, "threshold").limit(1).select("threshold", F.col(metric).alias("score"))


OPERATORS = {">=": operator.ge, "<=": operator.le, ">": operator.gt, "<": operator.lt, "==": operator.eq}


def gate_report(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules (metric_name, op, bound) with the value and the outcome of each."""
    value, bound = F.col("metric_value"), F.col("bound")
    holds = F.lit(None).cast("boolean")
    for symbol, compare in OPERATORS.items():
        holds = F.when(F.col("op") == symbol, compare(value, bound)).otherwise(holds)
    found = metrics.select("metric_name", "metric_value", F.lit(True).alias("_found"))
    outcome = (
        F.when(F.col("_found").isNull(), "missing metric")
        .when(~F.col("op").isin(list(OPERATORS)), "unknown operator")
        .when(value.isNull() | F.isnan(value), "not a number")
        .when(holds, "passed")
        .otherwise("failed")
    )
    return rules.join(found, "metric_name", "left").select("metric_name", "op", "bound", "metric_value", outcome.alias("outcome"))


def metric_gate(metrics: DataFrame, rules: DataFrame) -> None:
    """Raise with all failures when a rule does not hold. The report has one row per rule."""
    failures = gate_report(metrics, rules).where(F.col("outcome") != "passed").collect()
    if failures:
        raise ValueError("; ".join(f"{r.metric_name} {r.op} {r.bound}: {r.outcome}" for r in failures))


def tall_metrics(wide: DataFrame, names: list[str], stamps: dict[str, Column]) -> DataFrame:
    """One row per metric with the run stamps; non-finite values become NULL."""
    cells = F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("double").alias("value")) for n in names])
    tall = wide.select(F.explode(cells).alias("cell"))
    value = F.col("cell.value")
    finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    return tall.select(*[c.alias(n) for n, c in stamps.items()], "cell.metric_name", finite.alias("metric_value"))


def with_probabilities(df: DataFrame, classes: list[str], columns: list[str]) -> DataFrame:
    """Prediction (class of the highest probability), probability map and its JSON text."""
    if len(classes) != len(columns):
        raise ValueError("one probability column per class is needed")
    probabilities = F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), F.array(*[F.col(c).cast("double") for c in columns]))
    best = F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])
    label = F.coalesce(*[F.when(F.col(c) == best, F.lit(name)) for name, c in zip(classes, columns)])
    return df.withColumn("prediction", label).withColumn("prediction_proba", probabilities).withColumn("proba_json", F.to_json("prediction_proba"))


def parsed_probabilities(df: DataFrame, column: str) -> DataFrame:
    """Rows with ``prediction_proba`` as a map, whatever form ``column`` has."""
    return df.withColumn("prediction_proba", probability_map(F.col(column), df.schema[column].dataType.simpleString()))


def baseline_table(scored: DataFrame, label: str, model_id: str, label_type: str) -> DataFrame:
    """Test predictions with label and model id, the probability text parsed to a map."""
    return scored.where(F.col("split_name") == "test").select(
        "*",
        F.from_json("proba_json", "map<string,double>").alias("probability"),
        F.lit(model_id).alias("model_id"),
    ).withColumns({label: F.col(label).cast(label_type), "prediction": F.col("prediction").cast(label_type)})


def chosen_versions(registry: DataFrame, alias: str) -> DataFrame:
    """Version per model: the one with the alias, else the numerically latest."""
    version = F.col("version").try_cast("int")  # a version that is no number does not count
    return registry.groupBy("model_name").agg(
        F.max(version).alias("latest"), F.coalesce(F.max(F.when(F.col("alias") == alias, version)), F.max(version)).alias("chosen")
    )
