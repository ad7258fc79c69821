"""Queries over the claims run: sources, data quality, conforming layer, triangles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrid.functions import columns as C
from lossgrid.operators import conform, quality, triangle
from lossgrid.plans.claims import ClaimsRun
from lossgrid.sources import staging
from lossgrid.workload.query import Query
from lossgrid.workload.steps import (
    AS_OF, CLAIMS_END, CLAIMS_START, CUT_OFF, EARLIEST, SEGMENTS, age_sql, bucket_sql, month_sql, months_sql,
)


def claims_run(spark: SparkSession, sf_dir: str, share: tuple[int, int] | None = None) -> ClaimsRun:
    """The run over all invoices, or over those of one (number, of how many) share of the orders."""
    def source(name: str) -> DataFrame:
        return staging.stage_share(spark, sf_dir, name, *share) if share else staging.stage(spark, sf_dir, name)

    return ClaimsRun(source, AS_OF, EARLIEST, first_preauth_year=1995)


def gold(spark: SparkSession, sf_dir: str, years: int = 5) -> DataFrame:
    return claims_run(spark, sf_dir).gold(SEGMENTS, CLAIMS_START, CLAIMS_END, CUT_OFF, years)


def _dq_invoicebase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.add_dq_flags(staging.stage(spark, sf_dir, "invoicebase"), ["InvoiceKey"])


def _dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_report(_dq_invoicebase(spark, sf_dir), quality.key_rules(["InvoiceKey"]))


def _triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = claims_run(spark, sf_dir).lagged_invoices().where(F.col("payment_date").isNotNull())
    return triangle.loss_triangle(invoices, "lag_treatment_payment", SEGMENTS).withColumnRenamed("lag_treatment_payment", "lag")


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running distinct claims per month and lag, each claim counted at the lag it is first paid."""
    invoices = claims_run(spark, sf_dir).lagged_invoices()
    return triangle.running_distinct(invoices, ["SystemID"], "claim_id", "lag_treatment_reception")


def _ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = staging.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("event"))
    members = staging.stage(spark, sf_dir, "members").select(F.col("MemberID").alias("o_custkey"), "DateOfBirth")
    return conform.with_age(orders.join(members, "o_custkey"), "event")


def _raw_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = staging.stage(spark, sf_dir, "invoicebase").withColumnsRenamed(conform.INVOICE_NAMES)
    return conform.add_lag_features(base)


TRIANGLE_COLUMNS = (
    "treatment_date:t lag:i PolicySubType:s SystemID:s cumulative_amount:d cumulative_nb_claim:i cumulative_nb_invoice:i "
    "ultimate_amount:d ultimate_nb_claim:i ultimate_nb_invoice:i"
)
FEATURE_COLUMNS = (
    "PolicySubType:s SystemID:s treatment_date:t lag:i cumulative_amount_paid:d cumulative_nb_claim_paid:i cumulative_nb_invoice_paid:i "
    "ultimate_amount_paid:d ultimate_nb_claim_paid:d ultimate_nb_invoice_paid:d cumulative_amount_received:d "
    "cumulative_nb_claim_received_but_not_paid:i cumulative_nb_invoice_received_but_not_paid:i avg_monthly_processing_time:d "
    "avg_processing_time_w1:d avg_processing_time_w2:d avg_processing_time_w3:d avg_processing_time_w4:d nb_preauth:i treatment_date_month:i"
)
LAG_COLUMNS = (
    "invoice_id:s claim_id:i SystemID:s PolicySubType:s UKMemberRegion:s AgeBucket:s MajorICDGroupingDescription:s amount_paid:d "
    "daily_lag_treatment_reception:i daily_lag_treatment_payment:i daily_lag_reception_payment:i lag_treatment_reception:i "
    "lag_treatment_payment:i lag_reception_payment:i treatment_date:t treatment_date_full:t treatment_date_month:i reception_date_month:i"
)

QUERIES = {
    "dq1_flags": Query(
        _dq_invoicebase,
        "InvoiceKey:s SystemID:s AmountPaid:d tie1:i tie2:i tie4:t InvoiceKey_null_dq_flag:b duplicated_row_dq_flag:b valid_row:b",
        "SELECT * FROM dq_invoicebase",
    ),
    "dq2_valid_rows": Query(
        lambda s, d: quality.first_copies(staging.stage(s, d, "invoicebase"), ["InvoiceKey"]),
        "InvoiceKey:s SystemID:s TreatmentDate:t PaidDate:t AmountPaid:d tie1:i tie2:i",
        "SELECT * FROM dq_invoicebase WHERE valid_row",
    ),
    "dq3_quarantine": Query(
        lambda s, d: quality.quarantine(_dq_invoicebase(s, d)),
        "InvoiceKey:s SystemID:s TreatmentDate:t PaidDate:t AmountPaid:d tie1:i tie2:i duplicated_row_dq_flag:b",
        "SELECT * FROM dq_invoicebase WHERE NOT valid_row",
    ),
    "dq4_counts": Query(
        lambda s, d: quality.dq_counts(_dq_invoicebase(s, d), ["InvoiceKey"]),
        "InvoiceKey_null_dq_flag:i duplicated_row_dq_flag:i",
        "SELECT coalesce(sum(CAST(InvoiceKey_null_dq_flag AS INT)), 0) AS InvoiceKey_null_dq_flag, "
        "coalesce(sum(CAST(duplicated_row_dq_flag AS INT)), 0) AS duplicated_row_dq_flag FROM dq_invoicebase WHERE NOT valid_row",
    ),
    "dq5_rule_report": Query(
        _dq_report,
        "rule:s passed:i failed:i",
        "SELECT 'InvoiceKey_null_records' AS rule, count(*) FILTER (WHERE NOT InvoiceKey_null_dq_flag) AS passed, "
        "count(*) FILTER (WHERE InvoiceKey_null_dq_flag) AS failed FROM dq_invoicebase UNION ALL "
        "SELECT 'duplicated_records', count(*) FILTER (WHERE NOT duplicated_row_dq_flag), count(*) FILTER (WHERE duplicated_row_dq_flag) FROM dq_invoicebase",
    ),
    "flt1_policies": Query(
        lambda s, d: claims_run(s, d).policies(),
        "PolicyID:i SystemID:s HistoryID:s PolicySubType:s PolicyType:s ProductFamily:s CoverStartDate:t",
        "SELECT * FROM st_policies",
    ),
    "flt2_invoicebase": Query(
        lambda s, d: claims_run(s, d).invoicebase(),
        "invoice_id:s SystemID:s System:s treatment_date:t reception_date:t payment_date:t amount_paid:d MajorICDGroupingDescription:s InvoiceStatus:s",
        "SELECT * FROM st_invoicebase",
    ),
    "flt3_preauthbase": Query(
        lambda s, d: conform.filter_preauthbase(staging.stage(s, d, "preauthbase"), CUT_OFF, 1995),
        "PreAuthTreatmentKey:i claim_id:i SystemID:s TreatmentEffectiveDate:t TreatmentEffectiveDate_full:t",
        "SELECT * FROM st_preauthbase",
    ),
    "flt4_null_default": Query(
        lambda s, d: conform.fill_defaults(
            staging.stage(s, d, "invoicebase"), {"MajorICDGroupingDescription": "Unknown", "AmountPaid": 0.0}
        ),
        "InvoiceKey:s MajorICDGroupingDescription:s AmountPaid:d tie1:i tie2:i",
        "SELECT InvoiceKey, coalesce(MajorICDGroupingDescription, 'Unknown') AS MajorICDGroupingDescription, "
        "coalesce(AmountPaid, 0) AS AmountPaid, tie1, tie2 FROM stg_invoicebase",
    ),
    "prj1_members": Query(
        lambda s, d: claims_run(s, d).members(),
        "member_id:i PolicyID:i SystemID:s HistoryID:s PostCode:s DateOfBirth:t",
        "SELECT * FROM st_members",
    ),
    "prj4_suffix_rename": Query(
        lambda s, d: triangle.suffix_columns(
            staging.read_table(s, d, "orders").groupBy("o_orderstatus").agg(
                F.sum("o_totalprice").alias("cumulative_amount"), F.max("o_totalprice").alias("ultimate_amount"), F.count("*").alias("rows")
            ),
            ["cumulative", "ultimate"],
            "_paid",
        ),
        "o_orderstatus:s cumulative_amount_paid:d ultimate_amount_paid:d rows:i",
        "SELECT o_orderstatus, sum(o_totalprice) AS cumulative_amount_paid, max(o_totalprice) AS ultimate_amount_paid, count(*) AS rows FROM orders GROUP BY 1",
    ),
    "jn1_claim_contract": Query(
        lambda s, d: conform.build_claimcontract(
            conform.clean_claimlink(staging.stage(s, d, "claimlink")), claims_run(s, d).contracts()
        ),
        "claim_id:i PolicySubType:s DateOfBirth:t UKMemberRegion:s",
        "SELECT l.ClaimKey AS claim_id, c.PolicySubType, c.DateOfBirth, c.UKMemberRegion FROM stg_claimlink l JOIN st_contracts c "
        "ON c.member_id = l.MemberID AND c.SystemID = l.SystemLink AND c.HistoryID = l.HistoryID AND c.PolicyID = l.PolicyID",
    ),
    "jn2_contracts": Query(
        lambda s, d: claims_run(s, d).contracts(),
        "member_id:i PolicyID:i SystemID:s HistoryID:s PolicySubType:s DateOfBirth:t UKMemberRegion:s",
        "SELECT * FROM st_contracts",
    ),
    "fe1_age_bucket": Query(
        _ages,
        "o_orderkey:i Age:i AgeBucket:s",
        f"""SELECT o_orderkey, Age, {bucket_sql("Age")} AS AgeBucket
            FROM (SELECT o_orderkey, {age_sql("CAST(o_orderdate AS DATE)", "DateOfBirth")} AS Age FROM orders JOIN stg_members ON MemberID = o_custkey) x
            WHERE Age >= 0""",
    ),
    "fe2_outward_postcode": Query(
        lambda s, d: staging.stage(s, d, "members").select("MemberID", C.outward_postcode(F.col("PostCode")).alias("outward")),
        "MemberID:i outward:s",
        "SELECT MemberID, split_part(PostCode, ' ', 1) AS outward FROM stg_members",
    ),
    "fe3_claim_id": Query(
        lambda s, d: claims_run(s, d).invoicelink(),
        "invoice_id:s claim_id:i member_id:i PolicyID:i",
        "SELECT * FROM st_invoicelink",
    ),
    "fe4_lag_features": Query(
        _raw_lags,
        "invoice_id:s tie1:i tie2:i daily_lag_treatment_reception:i daily_lag_treatment_payment:i daily_lag_reception_payment:i "
        "lag_treatment_reception:i lag_treatment_payment:i lag_reception_payment:i treatment_date:t reception_date:t payment_date:t "
        "treatment_date_full:t treatment_date_month:i reception_date_month:i",
        f"""SELECT InvoiceKey AS invoice_id, tie1, tie2, coalesce(DateReceived - TreatmentDate, 36135) AS daily_lag_treatment_reception,
                   coalesce(PaidDate - TreatmentDate, 36135) AS daily_lag_treatment_payment, coalesce(PaidDate - DateReceived, 36135) AS daily_lag_reception_payment,
                   coalesce({months_sql("DateReceived", "TreatmentDate")}, 99) AS lag_treatment_reception,
                   coalesce({months_sql("PaidDate", "TreatmentDate")}, 99) AS lag_treatment_payment,
                   coalesce({months_sql("PaidDate", "DateReceived")}, 99) AS lag_reception_payment,
                   {month_sql("TreatmentDate")} AS treatment_date, {month_sql("DateReceived")} AS reception_date, {month_sql("PaidDate")} AS payment_date,
                   TreatmentDate AS treatment_date_full, month(TreatmentDate) AS treatment_date_month, month(DateReceived) AS reception_date_month
            FROM stg_invoicebase""",
    ),
    "fe4_invoices": Query(lambda s, d: claims_run(s, d).lagged_invoices(), LAG_COLUMNS, "SELECT * FROM st_lags"),
    "fe5_loss_triangle": Query(_triangle, TRIANGLE_COLUMNS, "SELECT * FROM st_paid"),
    "fe6_feature_table": Query(
        lambda s, d: claims_run(s, d).features(SEGMENTS, CUT_OFF), FEATURE_COLUMNS, "SELECT * FROM st_features"
    ),
    "fe7_monthly_processing": Query(
        lambda s, d: triangle.processing_times(claims_run(s, d).lagged_invoices()),
        "payment_date:t avg_monthly_processing_time:d",
        "SELECT * FROM st_months",
    ),
    "fe8_weekly_processing": Query(
        lambda s, d: triangle.processing_times(claims_run(s, d).lagged_invoices()),
        "payment_date:t avg_processing_time_w1:d avg_processing_time_w2:d avg_processing_time_w3:d avg_processing_time_w4:d",
        "SELECT m.payment_date, w.* EXCLUDE (payment_date) FROM st_months m LEFT JOIN st_weeks w USING (payment_date)",
    ),
    "fe9_preauth_counts": Query(
        lambda s, d: triangle.preauth_counts(claims_run(s, d).preauth(CUT_OFF), SEGMENTS),
        "TreatmentEffectiveDate:t PolicySubType:s SystemID:s nb_preauth:i",
        "SELECT * FROM st_preauth_counts",
    ),
    "fe10_gold": Query(
        gold, FEATURE_COLUMNS + " segment:s segment_key:s is_inference:b", "SELECT * FROM st_gold"
    ),
    "jn3_paid_received": Query(
        lambda s, d: triangle.paid_and_received(claims_run(s, d).lagged_invoices(), SEGMENTS),
        "PolicySubType:s SystemID:s treatment_date:t lag:i cumulative_amount_paid:d cumulative_nb_invoice_paid:i ultimate_amount_paid:d cumulative_amount_received:d",
        """SELECT PolicySubType, SystemID, treatment_date, lag, coalesce(p.cumulative_amount, 0) AS cumulative_amount_paid,
                  coalesce(p.cumulative_nb_invoice, 0) AS cumulative_nb_invoice_paid, p.ultimate_amount AS ultimate_amount_paid,
                  coalesce(r.cumulative_amount, 0) AS cumulative_amount_received
           FROM st_paid p FULL JOIN st_received r USING (PolicySubType, SystemID, treatment_date, lag)""",
    ),
    "jn4_month_lag_grid": Query(
        lambda s, d: triangle.cumulative_cells(
            claims_run(s, d).lagged_invoices(), {"all": (F.col("lag_treatment_reception"), F.lit(True))}, SEGMENTS
        ),
        "treatment_date:t lag:i PolicySubType:s SystemID:s",
        f"""SELECT * FROM (SELECT DISTINCT treatment_date, PolicySubType, SystemID FROM st_lags WHERE lag_treatment_reception BETWEEN 0 AND 36) g
            CROSS JOIN (SELECT DISTINCT lag_treatment_reception AS lag FROM st_lags WHERE lag_treatment_reception BETWEEN 0 AND 36) l""",
    ),
    "jn5_triangular_join": Query(
        lambda s, d: triangle.loss_triangle(claims_run(s, d).lagged_invoices(), "lag_treatment_reception", SEGMENTS)
        .withColumnRenamed("lag_treatment_reception", "lag"),
        TRIANGLE_COLUMNS,
        "SELECT * FROM st_received",
    ),
    "wn8_running_distinct": Query(
        _seen,
        "treatment_date:t SystemID:s lag:i seen:i",
        """SELECT a.treatment_date, a.SystemID, a.lag, count(DISTINCT b.claim_id) AS seen
           FROM (SELECT DISTINCT treatment_date, SystemID, lag_treatment_reception AS lag FROM st_lags) a
           JOIN st_lags b ON a.treatment_date = b.treatment_date AND a.SystemID = b.SystemID AND b.lag_treatment_reception <= a.lag GROUP BY ALL""",
    ),
}
