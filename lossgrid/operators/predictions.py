"""Post-processing of model outputs: latest rows, staleness, coalescing, smoothed prices, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid import constants as K
from lossgrid.functions.columns import normalise_target, ratio

# Age at which a prediction is stale, and the keys over which targets are coalesced.
STALE_HOURS = 8
COALESCE_KEYS = ["experiment_without_target", "segment_key"]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The greatest row of each key by ``order`` and then by all other columns that have an order.

    Spark keeps the first row per key of every task before it shuffles (window group limit), so a key with a large
    share of the rows sends one row per task. Maps may be among the columns; they do not take part in the order.
    """
    rest = [F.col(f.name).desc_nulls_last() for f in df.schema.fields if f.name not in keys and "map<" not in f.dataType.simpleString()]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order], *rest))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_predictions(payload: DataFrame, keys: list[str], targets: list[str] = K.TARGETS) -> DataFrame:
    """Latest inference row per model and key, with the prediction in the column of its target."""
    latest = latest_per_key(payload.where("is_inference"), ["model_name", *keys], [F.col("ts")])
    return latest.withColumns(
        {f"{t}_predicted": F.when(F.col("target") == t, F.col("prediction")) for t in targets}
        | {"treatment_date": F.to_date("treatment_date")}
    ).drop("prediction")


def latest_by_model(payload: DataFrame, models: DataFrame, key_columns: list[str]) -> DataFrame:
    """Latest inference row per model and key, where each model names its own keys.

    ``models`` has model_name, ``prediction_keys`` (an array of names out of ``key_columns``) and what is known of the
    model, such as target, run flags and config; its columns replace those of the payload. Payload rows of models it does
    not name are left out. Key columns the payload lacks are NULL.
    """
    known = [c for c in models.columns if c != "model_name"]
    rows = ensure_columns(payload.where("is_inference").drop(*known), dict.fromkeys(key_columns, "string"))
    joined = rows.join(models, "model_name")
    own = {f"_key_{c}": F.when(F.array_contains("prediction_keys", c), F.col(c).cast("string")) for c in key_columns}
    latest = latest_per_key(joined.withColumns(own), ["model_name", *own], [F.col("ts")])
    return latest.drop(*own)


def drop_stale(df: DataFrame, hours: int = STALE_HOURS) -> DataFrame:
    """Rows less than ``hours`` older than the newest row; the newest time is a scalar, not a window over all rows."""
    newest = df.agg(F.max("ts").alias("ts")).scalar()
    return df.where(newest.cast("timestamp").cast("long") - F.col("ts").cast("timestamp").cast("long") < hours * 3600)


def coalesce_targets(df: DataFrame, run_type: str, targets: list[str] = K.TARGETS) -> DataFrame:
    """Give every row of a (experiment, segment key) the non-null prediction of each target."""
    columns = [f"{t}_predicted" for t in targets]
    run = df.where(F.col(run_type))
    return run.drop(*columns).join(non_null_values(run, COALESCE_KEYS, columns), COALESCE_KEYS)


def non_null_values(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The non-null value of each column per key; the greatest one where several rows carry a value."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def first_full_experiment(df: DataFrame, target: str) -> DataFrame:
    """Smallest experiment name that contains the target and has its cumulative."""
    cumulative = target.replace("ultimate", "cumulative")
    named = df.where(F.col(cumulative).isNotNull() & F.col("full_experiment").contains(target))
    return named.agg(F.min("full_experiment").alias("full_experiment"))


def smoothed_price(df: DataFrame, target: str) -> DataFrame:
    """Five-row centred mean of amount per count along the occurrence months, for lags above four."""
    experiment = first_full_experiment(df, target).scalar()
    cumulative = target.replace("ultimate", "cumulative")
    price = ratio(F.col("cumulative_amount_paid"), F.col(cumulative))
    around = Window.partitionBy("segment", "target").orderBy("treatment_date", "lag").rowsBetween(-2, 2)
    return (
        df.where(F.col("full_experiment") == experiment)
        .withColumn("price_smoothed", F.avg(price).over(around))
        .where(F.col("lag") > 4)
        .select("segment", "treatment_date", "target", "lag", F.col("price_smoothed").alias(f"price_smoothed_{target}"))
    )


def export_predictions(df: DataFrame, count_targets: list[str] = K.COUNT_TARGETS) -> DataFrame:
    """Add the smoothed price, filled along falling lags of a visible month, and the amount of count targets."""
    keys = ["segment", "treatment_date", "lag", "target"]
    priced = df
    for target in count_targets:
        priced = priced.join(smoothed_price(df, target), keys, "left")
    columns = [f"price_smoothed_{t}" for t in count_targets]
    falling = (
        Window.partitionBy("segment", "VisibleDate", "target")
        .orderBy(F.desc("lag"), "full_experiment", "treatment_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    priced = (
        priced.withColumn("price_smoothed", F.coalesce(*columns))
        .drop(*columns)
        .withColumn("VisibleDate", F.add_months("treatment_date", F.col("lag").cast("int")))
        .withColumn("price_smoothed", F.last("price_smoothed", ignorenulls=True).over(falling))
    )
    amount = ensure_columns(priced, {"ultimate_amount_paid_predicted": "double"})
    value = F.col("ultimate_amount_paid_predicted")
    for target in count_targets:
        value = F.when(F.col("target") == target, F.col(f"{target}_predicted") * F.col("price_smoothed")).otherwise(value)
    return amount.withColumn("ultimate_amount_paid_predicted", value)


# --- schema normalisation -------------------------------------------------------------------------------


def rename_first(df: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Rename the first present variant of each wanted column that is missing."""
    renames = {}
    for wanted, variants in names.items():
        found = next((v for v in variants if v in df.columns and v not in renames), None)
        if wanted not in df.columns and found:
            renames[found] = wanted
    return df.withColumnsRenamed(renames)


def ensure_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add missing columns as typed NULLs."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items() if name not in df.columns})


# Names a payload writer may use.
PAYLOAD_NAMES = {
    "year_month_date": ["YearMonthDate", "TreatmentDate", "treatment_date", "ds"],
    "cluster_id": ["ClusterId", "segment", "Segment"],
    "prediction": ["Prediction", "yhat"],
    "prediction_lower": ["prediction_interval_lower", "yhat_lower", "PredictionLower"],
    "prediction_upper": ["prediction_interval_upper", "yhat_upper", "PredictionUpper"],
}


def normalise_payload(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Forecast payload with fixed names, types and defaults."""
    named = rename_first(df, PAYLOAD_NAMES)
    if "cluster_id" not in named.columns:
        named = named.withColumn("cluster_id", F.lit("_no_cluster"))
    if "ts" not in named.columns:
        named = named.withColumn("ts", now if now is not None else F.current_timestamp())
    named = ensure_columns(
        named,
        {
            "year_month_date": "date",
            "prediction": "double",
            "prediction_lower": "double",
            "prediction_upper": "double",
            "is_inference": "boolean",
        },
    )
    return named.withColumns(
        {
            "year_month_date": F.to_date("year_month_date"),
            "prediction": F.col("prediction").cast("double"),
            "prediction_lower": F.col("prediction_lower").cast("double"),
            "prediction_upper": F.col("prediction_upper").cast("double"),
            "is_inference": F.coalesce(F.col("is_inference").cast("boolean"), F.lit(True)),
            "ts": F.col("ts").cast("timestamp"),
        }
    )


def latest_forecasts(payload: DataFrame, keys: list[str]) -> DataFrame:
    """Latest inference forecast per key; a row without a time counts as the oldest, rows without a month are dropped."""
    rows = payload.where(F.col("is_inference") & F.col("year_month_date").isNotNull())
    return latest_per_key(rows, keys, [F.col("ts")])


# Columns of the actuals and of the export, with the names they may arrive under.
ACTUAL_NAMES = {
    "YearMonthDate": ["year_month_date"],
    "NumberMembers": ["nb_member"],
    "NumberClaims": ["nb_claim"],
    "AmountPaid": ["amount_paid"],
    "NumberInvoices": ["nb_invoice"],
    "Frequency_claims": ["frequency_claim"],
    "Severity_claims": ["severity_claim"],
    "BC": ["burning_cost"],
    "CPI": ["cpi"],
    "price_CPI": ["price_cpi"],
    "Frequency_invoices": ["frequency_invoice"],
    "Severity_invoices": ["severity_invoice"],
    "SeenMonth": ["seen_month"],
}
CLUSTER_NAMES = {
    "cluster_id": ["ClusterId", "segment"],
    "MajorICDGroupingDescription": ["major_icd_grouping_description"],
    "AgeBucket": ["age_bucket"],
    "UKMemberRegion": ["uk_member_region"],
    "PolicySubType": ["policy_sub_type"],
}
EXPORT_TARGETS = ["BC", "Frequency_claims", "Severity_claims"]
EXPORT_COLUMNS = [
    "YearMonthDate", "NumberMembers", "NumberClaims", "AmountPaid", "NumberInvoices", "Frequency_claims", "Severity_claims",
    "BC", "CPI", "price_CPI", "BC_pred", "BC_pred_lower", "BC_pred_upper", "Frequency_claims_pred",
    "Frequency_claims_pred_lower", "Frequency_claims_pred_upper", "Severity_claims_pred", "Severity_claims_pred_lower",
    "Severity_claims_pred_upper", "segment", "model_name", "Frequency_invoices", "Severity_invoices", "SeenMonth", "origin",
    "model_config", "MajorICDGroupingDescription", "AgeBucket", "UKMemberRegion", "PolicySubType",
]


def normalise_actuals(gold: DataFrame) -> DataFrame:
    """The fourteen columns of observed cluster months, typed NULL where absent."""
    kinds = {c: "double" for c in ACTUAL_NAMES} | {"YearMonthDate": "date", "SeenMonth": "string", "cluster_id": "string"}
    named = ensure_columns(rename_first(gold, ACTUAL_NAMES), kinds)
    return named.select("cluster_id", *[F.col(c).cast(kinds[c]).alias(c) for c in ACTUAL_NAMES])


def normalise_clusters(clusters: DataFrame) -> DataFrame:
    """One row per cluster with its dimensions; of several rows the smallest is taken."""
    named = ensure_columns(rename_first(clusters, CLUSTER_NAMES), {c: "string" for c in CLUSTER_NAMES})
    dims = [c for c in CLUSTER_NAMES if c != "cluster_id"]
    return named.groupBy("cluster_id").agg(F.min(F.struct(*dims)).alias("dims")).select("cluster_id", "dims.*")


def pivot_forecasts(forecasts: DataFrame) -> DataFrame:
    """One row per (cluster, month, origin) with value and bounds of the three targets; the burning-cost model names the row."""
    label = normalise_target(F.col("target"))

    def of(target: str, column: str) -> Column:
        return F.max(F.when(label == target, F.col(column)))

    values = {"_pred": "prediction", "_pred_lower": "prediction_lower", "_pred_upper": "prediction_upper"}
    return forecasts.groupBy("cluster_id", "year_month_date", "origin").agg(
        *[of(t, column).alias(t + suffix) for t in EXPORT_TARGETS for suffix, column in values.items()],
        *[F.coalesce(of("BC", c), F.max(c)).alias(c) for c in ("model_name", "model_config")],
    )


def with_actuals(forecasts: DataFrame, gold: DataFrame) -> DataFrame:
    """Observed columns beside the forecasts of the same cluster and day; the key is computed before the join."""
    actuals = normalise_actuals(gold).withColumnRenamed("YearMonthDate", "year_month_date")
    keyed = forecasts.withColumn("year_month_date", F.to_date("year_month_date"))
    return keyed.join(actuals, ["cluster_id", "year_month_date"], "left")


def export_forecasts(forecasts: DataFrame, gold: DataFrame, clusters: DataFrame) -> DataFrame:
    """Pivoted forecasts beside the observed months and the cluster dimensions, in the fixed export layout."""
    return (
        with_actuals(pivot_forecasts(forecasts), gold)
        .join(normalise_clusters(clusters), "cluster_id", "left")
        .withColumn("segment", F.col("cluster_id"))
        .withColumnRenamed("year_month_date", "YearMonthDate")
        .select(*EXPORT_COLUMNS)
    )
