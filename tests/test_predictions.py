from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lossgrid.operators import experiments, predictions


def test_latest_row_wins_and_nulls_lose(spark):
    rows = [("k", datetime(2020, 1, 1), 1.0), ("k", datetime(2020, 1, 2), 2.0), ("k", None, 9.0), ("n", None, 3.0)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, v double")
    assert {r["key"]: r["v"] for r in predictions.latest_per_key(df, ["key"], [F.col("ts")]).collect()} == {"k": 2.0, "n": 3.0}


def test_eight_hours_are_stale(spark):
    rows = [(h, datetime(2020, 1, 1, h, 30)) for h in (0, 1, 2, 9)]
    kept = predictions.drop_stale(spark.createDataFrame(rows, "h int, ts timestamp"))
    assert sorted(r["h"] for r in kept.collect()) == [2, 9]


def test_payload_defaults(spark):
    df = spark.createDataFrame([("c1", "2020-01-01", 3.0)], "segment string, ds string, yhat double")
    row = predictions.normalise_payload(df, F.lit(datetime(2020, 5, 5))).first()
    assert (row["cluster_id"], row["year_month_date"], row["prediction"], row["prediction_lower"], row["is_inference"]) == ("c1", date(2020, 1, 1), 3.0, None, True)


def test_existing_names_are_not_replaced(spark):
    df = spark.createDataFrame([("a", "b")], "cluster_id string, segment string")
    assert predictions.rename_first(df, predictions.PAYLOAD_NAMES).columns == ["cluster_id", "segment"]


def test_burning_cost_model_names_the_row(spark):
    rows = [("c", date(2020, 1, 1), "o", "BC", 1.0, "m_bc"), ("c", date(2020, 1, 1), "o", "severity_claim", 2.0, "z")]
    df = spark.createDataFrame(rows, "cluster_id string, year_month_date date, origin string, target string, prediction double, model_name string").withColumns(
        {"prediction_lower": F.col("prediction"), "prediction_upper": F.col("prediction"), "model_config": F.lit("{}")}
    )
    row = predictions.pivot_forecasts(df).first()
    assert (row["BC_pred"], row["Severity_claims_pred"], row["Frequency_claims_pred"], row["model_name"]) == (1.0, 2.0, None, "m_bc")


def test_price_fills_from_higher_lags(spark):
    months = [date(2020, m, 1) for m in range(1, 13)]
    rows = [
        ("PRED | e_ultimate_nb_claim_paid", "PRED | e", "ultimate_nb_claim_paid", "s", m, 12 - i, 100.0 * (i + 1), 10, 10, 5.0, None, None)
        for i, m in enumerate(months)
    ]
    df = spark.createDataFrame(
        rows,
        "full_experiment string, experiment_without_target string, target string, segment string, treatment_date date, lag int, cumulative_amount_paid double, "
        "cumulative_nb_claim_paid int, cumulative_nb_invoice_paid int, ultimate_nb_claim_paid_predicted double, ultimate_nb_invoice_paid_predicted double, ultimate_amount_paid_predicted double",
    )
    out = {r["lag"]: r for r in predictions.export_predictions(df).collect()}
    # all rows are visible in the same month, so low lags take the price of lag five
    assert out[12]["price_smoothed"] == pytest.approx((10 + 20 + 30) / 3)
    assert out[5]["price_smoothed"] == pytest.approx(80.0)
    assert out[1]["price_smoothed"] == pytest.approx(80.0)
    assert out[1]["ultimate_amount_paid_predicted"] == pytest.approx(400.0)


def test_duplicate_models(spark):
    rows = [
        ("once", "t", True, False), ("pair", "t", True, False), ("pair", "t", False, True), ("differs", "t", True, False), ("differs", "u", False, True),
        ("same flag", "t", True, False), ("same flag", "t", True, False), ("both flags", "t", True, True), ("both flags", "t", False, False),
    ]
    df = spark.createDataFrame(rows, "model_name string, target string, a boolean, b boolean")
    merged = {r["model_name"]: (r["a"], r["b"], r["allowed"]) for r in experiments.merge_duplicate_models(df, "model_name", ["a", "b"]).collect()}
    assert merged["once"] == (True, False, True) and merged["pair"] == (True, True, True)
    assert not any(merged[k][2] for k in ("differs", "same flag", "both flags"))


def test_grid_size(spark):
    # The shape of the default experiment configuration.
    segs, nn = [["PolicySubType", "SystemID"]], [{"layers": "32-16"}]
    configs = [
        {"run_type": "ibnr_standalone", "model_type": "chain_ladder", "per_lag": False, "segmentations": segs, "years": [1, 3, 5, 7], "targets": ["ultimate_amount_paid"], "features": [["a"], ["a", "m"]], "configs": [{"lag_col": "lag"}]},
        {"run_type": "ibnr_standalone", "model_type": "neural_network", "per_lag": True, "segmentations": segs, "years": [3, 5, 7], "targets": ["t1", "t2"], "features": [["a"], ["a", "b"], ["a", "b", "c"]], "configs": nn},
        {"run_type": "ibnr_inflation", "model_type": "neural_network", "per_lag": True, "segmentations": [["PolicySubType", "MajorICDGroupingDescription"]], "years": [3], "targets": ["t1", "t2", "t3"], "features": [["a"]], "configs": nn},
    ]
    grid = experiments.experiment_grid(experiments.config_frame(spark, configs), [("2025-01-01", "2025-12-01", "2026-01-01")])
    assert grid.count() == 29 and grid.select("model_name").distinct().count() == 29
    assert grid.where("model_type = 'neural_network'").first()["prediction_keys"][-1] == "lag"
