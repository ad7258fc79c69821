from datetime import date

from pyspark.sql import functions as F

from lossgrid.functions import columns as C
from lossgrid.functions.calendar import claims_windows, inflation_window, month_shift
from lossgrid.operators import conform


def test_null_policy_type_is_dropped_and_null_family_kept(spark):
    rows = [
        ("kept", "Individual", "Corporate", None), ("null type", "Individual", None, None), ("trust", "Other", "Trust", "CORE"),
        ("family part", "Individual", "Corporate", "A SAGA B"), ("sub type", "Other", "Corporate", "CORE"),
    ]
    df = spark.createDataFrame([(*r, date(2010, 1, 1)) for r in rows], "id string, PolicySubType string, PolicyType string, ProductFamily string, CoverStartDate date")
    kept = {r["id"]: r["PolicySubType"] for r in conform.filter_policies(df).collect()}
    assert kept == {"kept": "Individual", "trust": "Trust"}


def test_rows_before_birth_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, date(2000, 5, 1), date(2000, 5, 2)), (2, date(2000, 5, 2), date(2000, 5, 2)), (3, date(2021, 5, 1), date(2000, 5, 2)), (4, date(2021, 5, 2), None)],
        "id int, event date, DateOfBirth date",
    )
    aged = {r["id"]: (r["Age"], r["AgeBucket"]) for r in conform.with_age(df, "event").collect()}
    assert aged == {2: (0, "0_20"), 3: (20, "0_20")}


def test_missing_dates_get_the_fixed_lags(spark):
    df = spark.createDataFrame(
        [(date(2020, 1, 31), date(2020, 3, 1), None)], "treatment_date date, reception_date date, payment_date date"
    )
    row = conform.add_lag_features(df).first()
    assert row["lag_treatment_reception"] == 2 and row["daily_lag_treatment_reception"] == 30
    assert row["lag_treatment_payment"] == 99 and row["daily_lag_treatment_payment"] == 36135
    assert row["treatment_date"] == date(2020, 1, 1) and row["treatment_date_full"] == date(2020, 1, 31)


def test_payment_before_treatment_is_dropped(spark):
    rows = [("ok", date(2020, 1, 2), date(2020, 1, 2)), ("early", date(2020, 1, 2), date(2020, 1, 1)), ("open", date(2020, 1, 2), None), ("now", date(2020, 3, 1), None)]
    df = spark.createDataFrame(
        [(k, "ACS", "Paid", None, t, p) for k, t, p in rows],
        "InvoiceKey string, System string, InvoiceStatus string, MajorICDGroupingDescription string, TreatmentDate date, PaidDate date",
    )
    kept = conform.filter_invoicebase(df, "2020-03-15")
    assert {r["invoice_id"] for r in kept.collect()} == {"ok", "open"}
    assert kept.first()["MajorICDGroupingDescription"] == "Unknown"


def test_target_names_ignore_case_and_signs(spark):
    names = ["Burning Cost", "BC", " frequency-claims", "SEVERITY_CLAIM", "Other"]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    labels = [r[0] for r in df.select(C.normalise_target(F.col("t"))).collect()]
    assert labels == ["BC", "BC", "Frequency_claims", "Severity_claims", "Other"]


def test_calendars():
    assert month_shift(date(2026, 1, 31), -1) == date(2025, 12, 1)
    window = claims_windows(date(2026, 3, 15))[0]
    assert (window.start, window.end, window.max_lags, window.preauth_before) == (date(2025, 3, 1), date(2026, 2, 1), 12, date(2026, 3, 1))
    forecast = inflation_window(date(2026, 3, 15))
    assert (forecast.inference_begin, forecast.inference_end) == (date(2026, 3, 1), date(2029, 2, 1))


def test_unequal_custom_windows_are_refused():
    import pytest

    with pytest.raises(ValueError):
        claims_windows(date(2026, 1, 1), [(date(2025, 1, 1), date(2025, 12, 1)), (date(2025, 1, 1), date(2025, 6, 1))])
