"""Tabular learners on Spark ML with one interface for fitting, early stopping, tuning and scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrid.session import materialise

LEARNERS = {
    ("classification", "random_forest"): RandomForestClassifier,
    ("classification", "logistic"): LogisticRegression,
    ("classification", "gradient_boosting"): GBTClassifier,
    ("regression", "random_forest"): RandomForestRegressor,
    ("regression", "ridge"): LinearRegression,
    ("regression", "gradient_boosting"): GBTRegressor,
}


def complete(features: list[str], df: DataFrame) -> Column:
    """Whether a row has every feature; NaN counts as missing."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (~F.isnan(c) if c in floating else F.lit(True)) for c in features], F.lit(True))


def _stages(features: list[str], label: str, task: str, kind: str, params: dict) -> tuple[VectorAssembler, object]:
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    return assembler, LEARNERS[task, kind](featuresCol="_features", labelCol=label, **params)


def fit_learner(df: DataFrame, features: list[str], label: str, task: str, kind: str, **params) -> PipelineModel:
    """Fit on the rows that have every feature and the label."""
    usable = df.where(complete(features, df) & F.col(label).isNotNull())
    return Pipeline(stages=list(_stages(features, label, task, kind, params))).fit(usable)


def fit_early_stopping(
    df: DataFrame, features: list[str], label: str, task: str, split_col: str = "split_name", tolerance: float = 0.01, **params
) -> PipelineModel:
    """Boosting that stops when the validation rows no longer improve; only train and validation rows are used."""
    used = df.where(F.col(split_col).isin("train", "val")).select(*features, label, (F.col(split_col) == "val").alias("_validation"))
    used = materialise(used)  # every boosting round reads the rows again
    return fit_learner(
        used, features, label, task, "gradient_boosting", validationIndicatorCol="_validation", validationTol=tolerance, **params
    )


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Every row with ``prediction`` and, for classifiers, the ``probability`` array; both NULL where a feature is missing."""
    whole = complete(model.stages[0].getInputCols(), df)
    scored = model.transform(df.withColumn("_complete", whole)).withColumn("prediction", F.when(F.col("_complete"), F.col("prediction")))
    if "probability" in scored.columns:
        scored = scored.withColumn("probability", F.when(F.col("_complete"), vector_to_array("probability")))
    return scored.drop("_features", "rawPrediction", "_complete")


#: Metrics a search may use, and the evaluator of each.
BINARY_METRICS, REGRESSION_METRICS, LABEL_METRICS = ("areaUnderROC", "areaUnderPR"), ("rmse", "mse", "mae", "r2", "var"), ("accuracy", "f1", "logLoss", "hammingLoss")


def _evaluator(label: str, task: str, metric: str | None) -> Evaluator:
    metric = metric or ("areaUnderROC" if task == "classification" else "rmse")
    if metric in BINARY_METRICS:
        return BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    if metric in LABEL_METRICS:
        return MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    if metric in REGRESSION_METRICS:
        return RegressionEvaluator(labelCol=label, metricName=metric)
    raise ValueError(f"unknown metric {metric}")


def tune_learner(
    df: DataFrame, features: list[str], label: str, task: str, kind: str, grid: dict[str, list], folds: int = 3, fold_col: str = "",
    metric: str | None = None, **params,
) -> CrossValidatorModel:
    """Best learner of a parameter grid by mean score over the folds; the metric knows whether more of it is better.

    ``fold_col`` takes the folds from a column, so stratified or time folds work alike. Rows without a feature or the label
    are left out.
    """
    assembler, estimator = _stages(features, label, task, kind, params)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    validator = CrossValidator(
        estimator=Pipeline(stages=[assembler, estimator]), estimatorParamMaps=builder.build(), evaluator=_evaluator(label, task, metric),
        numFolds=folds, seed=1, foldCol=fold_col, parallelism=2,
    )
    return validator.fit(df.where(complete(features, df) & F.col(label).isNotNull()))


def search_table(spark: SparkSession, tuned: CrossValidatorModel) -> DataFrame:
    """One row per configuration: its parameters as a map, the mean score, and whether it is the best."""
    best = (max if tuned.getEvaluator().isLargerBetter() else min)(tuned.avgMetrics)
    rows = [({p.name: str(v) for p, v in grid.items()}, float(m), bool(m == best)) for grid, m in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics)]
    return spark.createDataFrame(rows, "params map<string,string>, score double, best boolean")
