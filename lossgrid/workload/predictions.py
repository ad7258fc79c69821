"""Queries over model outputs and the experiment grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrid.constants import TARGETS
from lossgrid.functions.columns import normalise_target, short_id
from lossgrid.operators import experiments, predictions
from lossgrid.plans.inflation import reserving_export
from lossgrid.sources import staging
from lossgrid.workload.portfolio import inflation_run
from lossgrid.workload.query import Query

KEYS = ["PolicySubType", "MajorICDGroupingDescription", "lag"]
PRED = "ultimate_amount_paid_predicted:d ultimate_nb_claim_paid_predicted:d ultimate_nb_invoice_paid_predicted:d"
CUMULATIVE = "cumulative_amount_paid:d cumulative_nb_claim_paid:i cumulative_nb_invoice_paid:i"

STEPS = {
    "st_latest": """
        SELECT * EXCLUDE (rn, prediction), CASE WHEN target = 'ultimate_amount_paid' THEN prediction END AS ultimate_amount_paid_predicted,
               CASE WHEN target = 'ultimate_nb_claim_paid' THEN prediction END AS ultimate_nb_claim_paid_predicted,
               CASE WHEN target = 'ultimate_nb_invoice_paid' THEN prediction END AS ultimate_nb_invoice_paid_predicted
        FROM (SELECT *, row_number() OVER (PARTITION BY model_name, PolicySubType, MajorICDGroupingDescription, lag ORDER BY ts DESC) AS rn
              FROM stg_reserving_payload WHERE is_inference) x WHERE rn = 1""",
    "st_fresh": "SELECT * FROM st_latest WHERE epoch((SELECT max(ts) FROM st_latest)) - epoch(ts) < 8 * 3600",
    "st_coalesced": """
        SELECT f.* EXCLUDE (ultimate_amount_paid_predicted, ultimate_nb_claim_paid_predicted, ultimate_nb_invoice_paid_predicted), g.* EXCLUDE (e, k)
        FROM st_fresh f JOIN (SELECT experiment_without_target AS e, segment_key AS k, max(ultimate_amount_paid_predicted) AS ultimate_amount_paid_predicted,
                     max(ultimate_nb_claim_paid_predicted) AS ultimate_nb_claim_paid_predicted, max(ultimate_nb_invoice_paid_predicted) AS ultimate_nb_invoice_paid_predicted
              FROM st_fresh WHERE ibnr_inflation GROUP BY 1, 2) g ON g.e = f.experiment_without_target AND g.k = f.segment_key
        WHERE f.ibnr_inflation""",
    "st_price_claim": """
        SELECT segment, treatment_date, target, lag, price FROM (
            SELECT *, avg(cumulative_amount_paid / nullif(CAST(cumulative_nb_claim_paid AS DOUBLE), 0)) OVER (PARTITION BY segment, target ORDER BY treatment_date, lag ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS price
            FROM st_coalesced WHERE full_experiment = (SELECT min(full_experiment) FROM st_coalesced WHERE full_experiment LIKE '%ultimate_nb_claim_paid%')) x WHERE lag > 4""",
    "st_price_invoice": """
        SELECT segment, treatment_date, target, lag, price FROM (
            SELECT *, avg(cumulative_amount_paid / nullif(CAST(cumulative_nb_invoice_paid AS DOUBLE), 0)) OVER (PARTITION BY segment, target ORDER BY treatment_date, lag ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS price
            FROM st_coalesced WHERE full_experiment = (SELECT min(full_experiment) FROM st_coalesced WHERE full_experiment LIKE '%ultimate_nb_invoice_paid%')) x WHERE lag > 4""",
    "st_export": """
        SELECT * EXCLUDE (ultimate_amount_paid_predicted), CASE target WHEN 'ultimate_nb_claim_paid' THEN ultimate_nb_claim_paid_predicted * price_smoothed
               WHEN 'ultimate_nb_invoice_paid' THEN ultimate_nb_invoice_paid_predicted * price_smoothed ELSE ultimate_amount_paid_predicted END AS ultimate_amount_paid_predicted
        FROM (SELECT * EXCLUDE (raw_price), last_value(raw_price IGNORE NULLS) OVER (PARTITION BY segment, VisibleDate, target ORDER BY lag DESC, full_experiment, treatment_date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_smoothed
              FROM (SELECT c.*, coalesce(p.price, i.price) AS raw_price, CAST(c.treatment_date + to_months(CAST(c.lag AS INT)) AS DATE) AS VisibleDate FROM st_coalesced c
                    LEFT JOIN st_price_claim p USING (segment, treatment_date, lag, target) LEFT JOIN st_price_invoice i USING (segment, treatment_date, lag, target)) x) y""",
    "st_forecasts": """
        SELECT * EXCLUDE (rn), concat('prior:', origin) AS model_config
        FROM (SELECT *, row_number() OVER (PARTITION BY model_name, cluster_id, year_month_date ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
              FROM stg_forecast_payload WHERE is_inference AND year_month_date IS NOT NULL) x WHERE rn = 1""",
    "st_labelled": """
        SELECT *, CASE WHEN clean IN ('burning_cost', 'bc') THEN 'BC' WHEN clean IN ('frequency_claim', 'frequency_claims') THEN 'Frequency_claims'
                       WHEN clean IN ('severity_claim', 'severity_claims') THEN 'Severity_claims' ELSE target END AS label
        FROM (SELECT *, regexp_replace(lower(trim(target)), '[^a-z0-9]+', '_', 'g') AS clean FROM st_forecasts) x""",
}


def _payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(spark, sf_dir, "reserving_payload")


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions.drop_stale(predictions.latest_predictions(_payload(spark, sf_dir), KEYS))


def _coalesced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions.coalesce_targets(_fresh(spark, sf_dir), "ibnr_inflation")


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = predictions.normalise_payload(staging.stage(spark, sf_dir, "forecast_payload"))
    keys = ["model_name", "cluster_id", "year_month_date"]
    # the event number decides between rows of the same time
    rows = payload.select(*keys, "ts", "event_id", *[c for c in payload.columns if c not in [*keys, "ts", "event_id"]])
    return predictions.latest_forecasts(rows, keys).withColumn("model_config", F.concat(F.lit("prior:"), "origin"))


def _renamed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staging.read_table(spark, sf_dir, "events")
    odd = events.select(
        "event_id", F.col("event_type").alias("Segment"), F.col("ts").cast("date").alias("ds"), F.col("value").alias("yhat"),
        (F.col("value") - 1).alias("yhat_lower"), F.col("ts"),
    )
    return predictions.normalise_payload(odd)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = staging.read_table(spark, sf_dir, "part")
    models = part.select(
        F.concat(F.lit("m"), (F.col("p_partkey") % 1501).cast("string")).alias("model_name"),
        F.col("p_type").alias("target"),
        (F.col("p_partkey") % 2 == 0).alias("ibnr_standalone"),
        (F.col("p_partkey") % 2 == 1).alias("ibnr_inflation"),
    )
    return experiments.merge_duplicate_models(models, "model_name", ["ibnr_standalone", "ibnr_inflation"])


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations read from the tables: one model type per market segment, targets from its order priorities."""
    orders = staging.read_table(spark, sf_dir, "orders")
    customer = staging.read_table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    configs = joined.groupBy("c_mktsegment").agg(
        F.sort_array(F.collect_set("o_orderpriority")).alias("targets"), F.sort_array(F.collect_set(F.year("o_orderdate"))).alias("years")
    )
    frame = configs.select(
        F.lit("ibnr_standalone").alias("run_type"), F.when(F.length("c_mktsegment") > 8, "neural_network").otherwise("chain_ladder").alias("model_type"), F.col("c_mktsegment").alias("_segment"),
        (F.length("c_mktsegment") > 8).alias("per_lag"), F.array(F.array(F.lit("PolicySubType"), F.lit("SystemID")), F.array(F.lit("PolicySubType"))).alias("segmentations"),
        "years", "targets", F.array(F.array(F.lit("b"), F.lit("a"), F.lit("b")), F.array(F.lit("c"))).alias("features"),
        F.array(F.create_map(*[F.lit(x) for x in ("unit_per_layer", "[64, 32]", "activation", "relu", "learning_rate", "0.1", "loss", "mse", "epochs", "5", "batch_size", "8")])).alias("configs"),
    )
    both = frame.unionByName(frame.withColumn("run_type", F.lit("ibnr_inflation")))
    # two market segments share a model type; a target set of one of them is enough
    one_each = both.groupBy("run_type", "model_type", "per_lag").agg(
        F.min("segmentations").alias("segmentations"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("years")))).alias("years"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("targets")))).alias("targets"), F.min("features").alias("features"),
        F.any_value("configs").alias("configs"),
    )
    return experiments.experiment_grid(one_each, [("2000-08-01", "2001-07-01", "2001-08-01"), ("2000-01-01", "2000-12-01", "2001-01-01")])


def _merged_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = _grid(spark, sf_dir).drop("run_type", "prediction_keys", "segmentation", "features")
    return experiments.merged_models(grid, "model_name", ["ibnr_standalone", "ibnr_inflation"])


def _per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models with and without the lag among their keys, over a payload that carries a map."""
    payload = _payload(spark, sf_dir).select(
        "model_name", "PolicySubType", "MajorICDGroupingDescription", "lag", "treatment_date", "prediction", "ts", "is_inference",
        F.create_map(F.lit("0"), F.col("prediction")).alias("prediction_proba"),
    )
    names = _payload(spark, sf_dir).select("model_name", "target").distinct()
    lagged = F.array(*[F.lit(k) for k in KEYS])
    models = names.where("model_name not like '%invoice%'").select(
        "model_name", F.when(F.col("target") == "ultimate_amount_paid", lagged).otherwise(F.slice(lagged, 1, 2)).alias("prediction_keys"), "target",
        F.create_map(F.lit("label"), F.col("target")).alias("model_config"),
    )
    found = predictions.latest_by_model(payload, models, KEYS)
    return found.withColumn("p0", F.col("prediction_proba")["0"]).withColumn("label", F.col("model_config")["label"])


EXPORT_SHOW = (
    "YearMonthDate:t NumberMembers:d NumberClaims:d AmountPaid:d NumberInvoices:d Frequency_claims:d Severity_claims:d BC:d CPI:d price_CPI:d "
    "BC_pred:d BC_pred_lower:d BC_pred_upper:d Frequency_claims_pred:d Frequency_claims_pred_lower:d Frequency_claims_pred_upper:d "
    "Severity_claims_pred:d Severity_claims_pred_lower:d Severity_claims_pred_upper:d segment:s model_name:s Frequency_invoices:d Severity_invoices:d "
    "SeenMonth:s origin:s model_config:s MajorICDGroupingDescription:s AgeBucket:s UKMemberRegion:s PolicySubType:s"
)


def _pivot_sql() -> str:
    cells = []
    for label in ["BC", "Frequency_claims", "Severity_claims"]:
        for suffix, column in {"_pred": "prediction", "_pred_lower": "prediction_lower", "_pred_upper": "prediction_upper"}.items():
            cells.append(f"max({column}) FILTER (WHERE label = '{label}') AS {label}{suffix}")
    for column in ["model_name", "model_config"]:
        cells.append(f"coalesce(max({column}) FILTER (WHERE label = 'BC'), max({column})) AS {column}")
    return f"SELECT cluster_id, year_month_date, origin, {', '.join(cells)} FROM st_labelled GROUP BY 1, 2, 3"


STEPS["st_pivoted"] = _pivot_sql()

QUERIES = {
    "pr1_latest_prediction": Query(
        lambda s, d: predictions.latest_predictions(_payload(s, d), KEYS),
        f"model_name:s segment_key:s target:s treatment_date:t lag:i {CUMULATIVE} {PRED} ts:ts",
        "SELECT * FROM st_latest",
    ),
    "pr1_per_model": Query(
        _per_model,
        "model_name:s PolicySubType:s MajorICDGroupingDescription:s lag:i treatment_date:t prediction:d p0:d target:s label:s ts:ts",
        """SELECT *, prediction AS p0, target AS label FROM (
               SELECT *, row_number() OVER (PARTITION BY model_name, PolicySubType, MajorICDGroupingDescription, CASE WHEN target = 'ultimate_amount_paid' THEN lag END
                                            ORDER BY ts DESC, lag DESC, treatment_date DESC) AS rn
               FROM stg_reserving_payload WHERE is_inference AND target <> 'ultimate_nb_invoice_paid') x WHERE rn = 1""",
    ),
    "wn1_latest_event": Query(
        lambda s, d: predictions.latest_per_key(
            staging.stage(s, d, "payload").where("is_inference"), ["model_name", "segment", "lag"], [F.col("ts")]
        ),
        "model_name:s segment:i lag:i event_id:i prediction:d ts:ts",
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name, segment, lag ORDER BY ts DESC, event_id DESC) AS rn FROM stg_payload WHERE is_inference) x WHERE rn = 1",
    ),
    "pr2_staleness_gate": Query(
        _fresh, f"model_name:s segment_key:s target:s {PRED} ts:ts", "SELECT * FROM st_fresh"
    ),
    "wn5_staleness_events": Query(
        lambda s, d: predictions.drop_stale(staging.read_table(s, d, "events"), 48),
        "event_id:i ts:ts value:d",
        "SELECT * FROM events WHERE CAST(epoch(date_trunc('second', (SELECT max(ts) FROM events))) AS BIGINT) - CAST(epoch(date_trunc('second', ts)) AS BIGINT) < 48 * 3600",
    ),
    "pr3_coalesce_targets": Query(
        _coalesced, f"model_name:s segment_key:s target:s lag:i {CUMULATIVE} {PRED}", "SELECT * FROM st_coalesced"
    ),
    "ag4_first_non_null": Query(
        lambda s, d: predictions.non_null_values(_fresh(s, d).where("ibnr_inflation"), predictions.COALESCE_KEYS, [f"{t}_predicted" for t in TARGETS]),
        f"experiment_without_target:s segment_key:s {PRED}",
        """SELECT experiment_without_target, segment_key, max(ultimate_amount_paid_predicted) AS ultimate_amount_paid_predicted,
                  max(ultimate_nb_claim_paid_predicted) AS ultimate_nb_claim_paid_predicted, max(ultimate_nb_invoice_paid_predicted) AS ultimate_nb_invoice_paid_predicted
           FROM st_fresh WHERE ibnr_inflation GROUP BY 1, 2""",
    ),
    "wn3_centred_mean": Query(
        lambda s, d: predictions.smoothed_price(_coalesced(s, d), "ultimate_nb_invoice_paid").withColumnRenamed("price_smoothed_ultimate_nb_invoice_paid", "price"),
        "segment:s treatment_date:t target:s lag:i price:d",
        "SELECT * FROM st_price_invoice",
    ),
    "wn4_forward_fill": Query(
        lambda s, d: reserving_export(_payload(s, d), "ibnr_inflation"),
        "segment:s target:s VisibleDate:t lag:i full_experiment:s treatment_date:t price_smoothed:d",
        "SELECT * FROM st_export",
    ),
    "pr4_first_experiment": Query(
        lambda s, d: predictions.first_full_experiment(_coalesced(s, d), "ultimate_nb_claim_paid"),
        "full_experiment:s",
        "SELECT min(full_experiment) AS full_experiment FROM st_coalesced WHERE cumulative_nb_claim_paid IS NOT NULL AND full_experiment LIKE '%ultimate_nb_claim_paid%'",
    ),
    "pr5_smoothed_price": Query(
        lambda s, d: predictions.smoothed_price(_coalesced(s, d), "ultimate_nb_claim_paid").withColumnRenamed("price_smoothed_ultimate_nb_claim_paid", "price"),
        "segment:s treatment_date:t target:s lag:i price:d",
        "SELECT * FROM st_price_claim",
    ),
    "pr6_export": Query(
        lambda s, d: reserving_export(_payload(s, d), "ibnr_inflation"),
        f"model_name:s segment:s segment_key:s target:s treatment_date:t VisibleDate:t lag:i price_smoothed:d {CUMULATIVE} {PRED}",
        "SELECT * FROM st_export",
    ),
    "pr7_normalise_payload": Query(
        _renamed_payload,
        "event_id:i cluster_id:s year_month_date:t prediction:d prediction_lower:d prediction_upper:d is_inference:b ts:ts",
        "SELECT event_id, event_type AS cluster_id, CAST(ts AS DATE) AS year_month_date, value AS prediction, value - 1 AS prediction_lower, "
        "CAST(NULL AS DOUBLE) AS prediction_upper, TRUE AS is_inference, ts FROM events",
    ),
    "pr8_latest_forecast": Query(
        _forecasts,
        "model_name:s cluster_id:s year_month_date:t target:s origin:s prediction:d prediction_lower:d prediction_upper:d ts:ts model_config:s",
        "SELECT * FROM st_forecasts",
    ),
    "prj3_normalise_target": Query(
        lambda s, d: _forecasts(s, d).withColumn("label", normalise_target(F.col("target"))),
        "model_name:s cluster_id:s year_month_date:t target:s label:s",
        "SELECT * FROM st_labelled",
    ),
    "ag5_pivot_forecasts": Query(
        lambda s, d: predictions.pivot_forecasts(_forecasts(s, d)),
        "cluster_id:s year_month_date:t origin:s BC_pred:d BC_pred_lower:d BC_pred_upper:d Frequency_claims_pred:d Severity_claims_pred:d Severity_claims_pred_upper:d model_name:s model_config:s",
        "SELECT * FROM st_pivoted",
    ),
    "jn7_forecast_actuals": Query(
        lambda s, d: predictions.with_actuals(_forecasts(s, d), inflation_run(s, d).gold()),
        "model_name:s cluster_id:s year_month_date:t prediction:d BC:d NumberMembers:d",
        """SELECT f.*, g.burning_cost AS BC, g.nb_member AS NumberMembers FROM st_forecasts f
           LEFT JOIN st_inflation_gold g ON g.cluster_id = f.cluster_id AND g.year_month_date = f.year_month_date""",
    ),
    "pr9_forecast_export": Query(
        lambda s, d: predictions.export_forecasts(_forecasts(s, d), inflation_run(s, d).gold(), staging.stage(s, d, "clusters")),
        EXPORT_SHOW,
        """SELECT p.year_month_date AS YearMonthDate, nb_member AS NumberMembers, nb_claim AS NumberClaims, amount_paid AS AmountPaid, nb_invoice AS NumberInvoices,
                  frequency_claim AS Frequency_claims, severity_claim AS Severity_claims, burning_cost AS BC, CPI, price_CPI, p.* EXCLUDE (cluster_id, year_month_date),
                  p.cluster_id AS segment, frequency_invoice AS Frequency_invoices, severity_invoice AS Severity_invoices, SeenMonth,
                  MajorICDGroupingDescription, AgeBucket, UKMemberRegion, PolicySubType
           FROM st_pivoted p LEFT JOIN st_inflation_gold g ON g.cluster_id = p.cluster_id AND g.year_month_date = p.year_month_date
           LEFT JOIN (SELECT cluster_id, MajorICDGroupingDescription, AgeBucket, UKMemberRegion, PolicySubType, row_number() OVER (PARTITION BY cluster_id
                             ORDER BY MajorICDGroupingDescription NULLS FIRST, AgeBucket NULLS FIRST, UKMemberRegion NULLS FIRST, PolicySubType NULLS FIRST) AS rn
                      FROM st_cluster_dims) c ON c.cluster_id = p.cluster_id AND c.rn = 1""",
    ),
    "ex1_experiment_grid": Query(
        _merged_grid,
        "model_name:s table_name:s aggregated_table_name:s model_type:s training_years:i target:s experiment_without_target:s full_experiment:s start_date:s end_date:s ibnr_standalone:b ibnr_inflation:b",
        """SELECT lower(replace(concat('ibnr_', substr(translate(base64(unhex(sha256(concat(replace(table_name, 'ibnr_gold', 'ibnr'), '_type_', model_type, '_target_', target, '__start_', start_date, '__end_', end_date,
                      '_features_', replace(features, ' - ', '_'))))), '+/', '-_'), 1, 6)), '-', '_')) AS model_name, table_name,
                  lower(concat('ibnr_aggregated__preauth_', replace(preauth, '-', '_'), '__', segmentation)) AS aggregated_table_name, model_type, training_years, target,
                  concat('PRED | ', features, label, '_', training_years) AS experiment_without_target, concat('PRED | ', features, label, '_', training_years, '_', target) AS full_experiment,
                  start_date, end_date, TRUE AS ibnr_standalone, TRUE AS ibnr_inflation
           FROM (SELECT lower(replace(concat('ibnr_gold__years_', training_years, '__start_', start_date, '__end_', end_date, '__', segmentation), '-', '_')) AS table_name, *,
                        CASE model_type WHEN 'chain_ladder' THEN ' | ChainLadderConfig' ELSE ' | NeuralNetworkConfig - [64, 32, 1] - relu - 0.1 - mse - 5 - 8' END AS label FROM
                 (SELECT DISTINCT CASE WHEN length(c_mktsegment) > 8 THEN 'neural_network' ELSE 'chain_ladder' END AS model_type, o_orderpriority AS target FROM orders JOIN customer ON o_custkey = c_custkey) t
                 JOIN (SELECT DISTINCT CASE WHEN length(c_mktsegment) > 8 THEN 'neural_network' ELSE 'chain_ladder' END AS model_type, year(o_orderdate) AS training_years FROM orders JOIN customer ON o_custkey = c_custkey) y USING (model_type)
                 CROSS JOIN (VALUES ('PolicySubType_SystemID'), ('PolicySubType')) s(segmentation) CROSS JOIN (VALUES ('a - b'), ('c')) f(features)
                 CROSS JOIN (VALUES ('2000-08-01', '2001-07-01', '2001-08-01'), ('2000-01-01', '2000-12-01', '2001-01-01')) w(start_date, end_date, preauth)) x""",
    ),
    "ex1_tables": Query(
        lambda s, d: experiments.gold_tables(_grid(s, d)).select("table_name", "aggregated_table_name").join(
            experiments.aggregated_tables(_grid(s, d)).select(F.col("table_name").alias("aggregated_table_name")), "aggregated_table_name"),
        "table_name:s aggregated_table_name:s",
        """SELECT DISTINCT lower(replace(concat('ibnr_gold__years_', y, '__start_', a, '__end_', b, '__', g), '-', '_')) AS table_name,
                  lower(concat('ibnr_aggregated__preauth_', replace(p, '-', '_'), '__', g)) AS aggregated_table_name
           FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey) o CROSS JOIN (VALUES ('PolicySubType_SystemID'), ('PolicySubType')) s(g)
           CROSS JOIN (VALUES ('2000-08-01', '2001-07-01', '2001-08-01'), ('2000-01-01', '2000-12-01', '2001-01-01')) w(a, b, p)""",
    ),
    "ex2_short_id": Query(
        lambda s, d: staging.read_table(s, d, "part").select("p_partkey", short_id(F.col("p_name")).alias("short_id")),
        "p_partkey:i short_id:s",
        "SELECT p_partkey, substr(translate(base64(unhex(sha256(p_name))), '+/', '-_'), 1, 6) AS short_id FROM part",
    ),
    "ex4_merge_duplicates": Query(
        _pairs,
        "model_name:s target:s ibnr_standalone:b ibnr_inflation:b allowed:b",
        """SELECT concat('m', p_partkey % 1501) AS model_name, min(p_type) AS target, bool_or(p_partkey % 2 = 0) AS ibnr_standalone, bool_or(p_partkey % 2 = 1) AS ibnr_inflation,
                  count(*) = 1 OR (count(*) = 2 AND count(DISTINCT p_type) = 1 AND count(*) FILTER (WHERE p_partkey % 2 = 0) = 1) AS allowed FROM part GROUP BY 1""",
    ),
}
