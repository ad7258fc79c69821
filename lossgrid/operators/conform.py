"""Cleaning of the source tables and the contract, invoice and pre-authorisation tables built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lossgrid import constants as K
from lossgrid.functions.columns import age_bucket, age_years, months_since, outward_postcode

# Invoice columns of the source and their names in all later tables.
INVOICE_NAMES = {
    "TreatmentDate": "treatment_date",
    "PaidDate": "payment_date",
    "DateReceived": "reception_date",
    "AmountPaid": "amount_paid",
    "InvoiceKey": "invoice_id",
}


def filter_policies(df: DataFrame, earliest: str = K.EARLIEST_DATE) -> DataFrame:
    """Business filter of policies.

    A trust, or a policy without a type, takes the sub-type "Trust"; the type filter then drops the NULL
    types again because NULL is in no list.
    """
    family = F.col("ProductFamily")
    excluded = family.isin(K.EXCLUDED_PRODUCT_FAMILIES)
    for part in K.EXCLUDED_PRODUCT_FAMILY_PARTS:
        excluded = excluded | family.contains(part)
    is_trust = F.coalesce(F.col("PolicyType") == "Trust", F.lit(True))
    return (
        df.withColumn("PolicySubType", F.when(is_trust, "Trust").otherwise(F.col("PolicySubType")))
        .where(~F.col("PolicyType").isin(K.EXCLUDED_POLICY_TYPES))
        .where(family.isNull() | ~excluded)
        .where(F.col("PolicySubType").isin(K.KEPT_POLICY_SUB_TYPES))
        .where(F.to_date("CoverStartDate") >= F.lit(earliest).cast("date"))
    )


def clean_members(df: DataFrame) -> DataFrame:
    return df.withColumn("PostCode", outward_postcode(F.col("PostCode"))).withColumnRenamed("MemberID", "member_id")


def clean_geography(df: DataFrame) -> DataFrame:
    return df.select("PostCode", F.col("UkRegion").alias("UKMemberRegion"))


def filter_invoicebase(df: DataFrame, as_of: str, earliest: str = K.EARLIEST_DATE) -> DataFrame:
    """Invoices of the kept systems and statuses, treated before the month of ``as_of``, not paid before treatment."""
    month_start = F.trunc(F.lit(as_of).cast("date"), "MM")
    treated, paid = F.col("treatment_date"), F.col("payment_date")
    return (
        df.withColumnsRenamed(INVOICE_NAMES)
        .fillna({"MajorICDGroupingDescription": "Unknown"})
        .where(F.col("System").isin(K.KEPT_SYSTEMS) & F.col("InvoiceStatus").isin(K.KEPT_INVOICE_STATUSES))
        .where((F.to_date(treated) >= F.lit(earliest).cast("date")) & (F.to_date(treated) < month_start))
        .where(paid.isNull() | (treated <= paid))
    )


def clean_invoicelink(df: DataFrame) -> DataFrame:
    """Invoice to member link; an invoice without a claim counts as a claim of its member."""
    member = F.col("MemberID")
    return df.select(
        F.col("InvoiceKey").alias("invoice_id"),
        F.coalesce(F.col("ClaimKey"), member).alias("claim_id"),
        "SystemLink",
        member.alias("member_id"),
        "HistoryID",
        "PolicyID",
    )


def filter_preauthbase(df: DataFrame, before: str, first_year: int = K.FIRST_PREAUTH_YEAR) -> DataFrame:
    """Earliest, accepted pre-authorisations effective before the cut-off, keyed by month."""
    effective = F.col("TreatmentEffectiveDate")
    return (
        df.where(F.col("TreatmentEarliestRecord") == "Yes")
        .where(~F.col("TreatmentDecisionCategory").isin(K.REJECTED_PREAUTH_DECISIONS))
        .where((F.year(effective) >= first_year) & (effective < F.lit(before).cast("date")))
        .withColumnsRenamed({"SystemId": "SystemID", "ClaimKey": "claim_id"})
        .withColumn("TreatmentEffectiveDate_full", effective)
        .withColumn("TreatmentEffectiveDate", F.trunc(effective, "MM"))
    )


def clean_claimlink(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("ClaimKey").alias("claim_id"), "SystemLink", "PolicyID", "HistoryID", F.col("MemberID").alias("member_id")
    )


def build_contracts(policies: DataFrame, members: DataFrame, geography: DataFrame) -> DataFrame:
    """Members with their region, restricted to the kept policies."""
    located = members.join(geography, "PostCode", "left").fillna({"UKMemberRegion": "Unknown"})
    return policies.withColumnRenamed("HistoryID", "PolicyHistoryID").join(
        located, ["PolicyID", "SystemID", "PolicyHistoryID"]
    )


def with_age(df: DataFrame, event_col: str) -> DataFrame:
    """Add Age and AgeBucket at the event; rows born after the event or without a birth date are dropped."""
    return (
        df.where(F.to_date("DateOfBirth") <= F.to_date(event_col))
        .withColumn("Age", age_years(F.col(event_col), F.col("DateOfBirth")))
        .withColumn("AgeBucket", age_bucket(F.col("Age")))
    )


def build_invoices(invoicebase: DataFrame, invoicelink: DataFrame, contracts: DataFrame) -> DataFrame:
    """Invoices with the contract dimensions of their member.

    An invoice without a contract has no birth date, hence no age, and would be dropped by the age filter;
    the link is therefore joined inner.
    """
    insured = contracts.select(
        "member_id",
        F.col("SystemID").alias("SystemLink"),
        "HistoryID",
        "PolicyID",
        "PolicySubType",
        "DateOfBirth",
        "UKMemberRegion",
    )
    # both invoice tables are partitioned by their key already, so they meet before the member join
    linked = invoicebase.join(invoicelink, "invoice_id").join(insured, ["member_id", "SystemLink", "HistoryID", "PolicyID"])
    return with_age(linked, "treatment_date")


def build_claimcontract(claimlink: DataFrame, contracts: DataFrame) -> DataFrame:
    insured = contracts.withColumnRenamed("SystemID", "SystemLink")
    joined = claimlink.join(insured, ["member_id", "SystemLink", "HistoryID", "PolicyID"])
    return joined.select("claim_id", "PolicySubType", "DateOfBirth", "UKMemberRegion")


def build_preauth(preauthbase: DataFrame, claimcontract: DataFrame) -> DataFrame:
    return with_age(preauthbase.join(claimcontract, "claim_id"), "TreatmentEffectiveDate")


def _days_between(later: str, earlier: str) -> Column:
    return F.coalesce(F.date_diff(later, earlier), F.lit(K.MISSING_DAY_LAG))


def _months_between(later: str, earlier: str) -> Column:
    return F.coalesce(months_since(F.col(later), F.col(earlier)), F.lit(K.MISSING_MONTH_LAG))


def add_lag_features(df: DataFrame) -> DataFrame:
    """Day and month lags between treatment, reception and payment; the dates become months and keep ``_full`` copies."""
    treated, received, paid = "treatment_date", "reception_date", "payment_date"
    lags = df.withColumns(
        {
            "daily_lag_treatment_reception": _days_between(received, treated),
            "daily_lag_treatment_payment": _days_between(paid, treated),
            "daily_lag_reception_payment": _days_between(paid, received),
            "lag_treatment_reception": _months_between(received, treated),
            "lag_treatment_payment": _months_between(paid, treated),
            "lag_reception_payment": _months_between(paid, received),
            "treatment_date_month": F.month(treated),
            "reception_date_month": F.month(received),
        }
    )
    dates = [treated, received, paid]
    return lags.withColumns({f"{c}_full": F.col(c) for c in dates}).withColumns({c: F.trunc(c, "MM") for c in dates})


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna(defaults)
