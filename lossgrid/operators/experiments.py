"""Experiment grid and duplicate models, as small DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrid.functions.columns import clean_name, short_id

CONFIG_SCHEMA = (
    "run_type string, model_type string, per_lag boolean, segmentations array<array<string>>, years array<int>, "
    "targets array<string>, features array<array<string>>, configs array<map<string,string>>"
)


def config_frame(spark: SparkSession, configs: list[dict]) -> DataFrame:
    return spark.createDataFrame(configs, CONFIG_SCHEMA)


# Settings of a network that its label shows, in order.
NETWORK_SETTINGS = ["activation", "learning_rate", "loss", "epochs", "batch_size"]


def config_label(model_type: Column, config: Column) -> Column:
    """What the experiment name says of the model: the type, and of a network its layers with the output layer and settings."""
    layers = F.regexp_replace(config["unit_per_layer"], r"\]$", ", 1]")
    network = F.concat(F.lit(" | NeuralNetworkConfig - "), layers, *[F.concat(F.lit(" - "), config[name]) for name in NETWORK_SETTINGS])
    return F.when(model_type == "neural_network", network).when(model_type == "chain_ladder", " | ChainLadderConfig").otherwise("model name not defined")


def experiment_grid(configs: DataFrame, windows: list[tuple]) -> DataFrame:
    """One row per run type, model type, segmentation, years, target, features, model config and time window.

    Model names are a hash of all that makes the model, so the same model of two run types has one name:
    ``merge_duplicate_models`` joins the two rows.
    """
    grid = configs.withColumn(
        "window", F.explode(F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(p).alias("preauth")) for a, b, p in windows]))
    )
    for name, many in {
        "segmentation": "segmentations", "training_years": "years", "target": "targets", "feature_set": "features", "model_config": "configs",
    }.items():
        grid = grid.withColumn(name, F.explode(many)).drop(many)
    features = F.array_sort(F.array_distinct("feature_set"))
    label = config_label(F.col("model_type"), F.col("model_config"))
    experiment = F.concat(F.lit("PRED | "), F.array_join(features, " - "), label, F.lit("_"), F.col("training_years").cast("string"))
    keys = F.when(F.col("per_lag"), F.concat("segmentation", F.array(F.lit("lag")))).otherwise(F.col("segmentation"))
    # How names are put together.
    tail = F.concat(
        F.lit("__years_"), F.col("training_years").cast("string"), F.lit("__start_"), "window.start", F.lit("__end_"), "window.end",
        F.lit("__"), F.array_join("segmentation", "_"),
    )
    table = clean_name(F.concat(F.lit("ibnr_gold"), tail))
    full_name = F.concat(
        F.regexp_replace(table, "ibnr_gold", "ibnr"), F.lit("_type_"), "model_type", F.lit("_target_"), "target", F.lit("__start_"), "window.start",
        F.lit("__end_"), "window.end", F.lit("_features_"), F.array_join(features, "_"),
    )
    aggregated = F.concat(F.lit("ibnr_aggregated__preauth_"), F.translate("window.preauth", "-", "_"), F.lit("__"), F.coalesce(F.nullif(F.array_join("segmentation", "_"), F.lit("")), F.lit("none")))
    return grid.select(
        clean_name(F.concat(F.lit("ibnr_"), short_id(full_name))).alias("model_name"), full_name.alias("model_full_name"), table.alias("table_name"), clean_name(aggregated).alias("aggregated_table_name"), "run_type", "model_type", "training_years", "target",
        features.alias("features"), "segmentation", keys.alias("prediction_keys"), "model_config",
        experiment.alias("experiment_without_target"), F.concat_ws("_", experiment, "target").alias("full_experiment"),
        F.col("window.start").alias("start_date"), F.col("window.end").alias("end_date"),
        (F.col("run_type") == "ibnr_standalone").alias("ibnr_standalone"), (F.col("run_type") == "ibnr_inflation").alias("ibnr_inflation"),
    )


def gold_tables(grid: DataFrame) -> DataFrame:
    """The gold tables the models need, one row each."""
    return grid.select("table_name", "segmentation", "aggregated_table_name", "training_years", "start_date", "end_date").distinct()


def aggregated_tables(grid: DataFrame) -> DataFrame:
    """The aggregated tables under the gold tables, one row each."""
    return grid.select(F.col("aggregated_table_name").alias("table_name"), "segmentation").distinct()


def merged_models(models: DataFrame, name: str, flags: list[str]) -> DataFrame:
    """``merge_duplicate_models`` that raises when a merge is not allowed."""
    merged = merge_duplicate_models(models, name, flags)
    refused = F.raise_error(F.concat(F.lit("model name used by different models: "), F.col(name)))
    return merged.where(F.when(F.col("allowed"), True).otherwise(refused)).drop("allowed")


def merge_duplicate_models(models: DataFrame, name: str, flags: list[str]) -> DataFrame:
    """One row per model name with the flags OR-ed, and whether the merge is allowed.

    A name may occur once, or twice as a pair that sets one flag each and agrees in every other column.
    """
    rest = [c for c in models.columns if c not in [name, *flags]]
    as_text = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("")
    one_flag_each = [F.count_if(F.col(f)) == 1 for f in flags]
    paired = (F.count("*") == 2) & (F.min(as_text) == F.max(as_text))
    # exactly one row sets each flag, and no row sets none or both
    exclusive = F.min(sum((F.col(f).cast("int") for f in flags), F.lit(0))) == 1
    for condition in one_flag_each:
        paired = paired & condition
    return models.groupBy(name).agg(
        *[F.any_value(c).alias(c) if "map<" in models.schema[c].dataType.simpleString() else F.min(c).alias(c) for c in rest],
        *[F.bool_or(F.col(f)).alias(f) for f in flags],
        ((F.count("*") == 1) | (paired & exclusive)).alias("allowed"),
    )
