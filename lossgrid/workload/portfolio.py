"""Queries over the inflation portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossgrid.operators import portfolio, predictions, quality
from lossgrid.plans.inflation import InflationRun
from lossgrid.session import materialise
from lossgrid.sources import catalog, staging
from lossgrid.workload.claims import claims_run
from lossgrid.workload.query import Query
from lossgrid.workload.steps import AS_OF, CUT_OFF, age_sql, bucket_sql, month_sql

TRAINING_BEGIN = "1997-01-01"
DIMS = "PolicySubType, AgeBucket, UKMemberRegion, SystemID, MajorICDGroupingDescription"
DIM_COLUMNS = "PolicySubType:s AgeBucket:s UKMemberRegion:s SystemID:s MajorICDGroupingDescription:s"
RATIO_COLUMNS = "frequency_claim:d severity_claim:d frequency_invoice:d severity_invoice:d burning_cost:d"
SERIES_COLUMNS = f"cluster_id:s year_month_date:t nb_member:i amount_paid:d nb_claim:d nb_invoice:d {RATIO_COLUMNS}"
RATIO_SQL = """nb_claim / nullif(CAST(nb_member AS DOUBLE), 0) AS frequency_claim, amount_paid / nullif(CAST(nb_claim AS DOUBLE), 0) AS severity_claim,
    nb_invoice / nullif(CAST(nb_member AS DOUBLE), 0) AS frequency_invoice, amount_paid / nullif(CAST(nb_invoice AS DOUBLE), 0) AS severity_invoice,
    amount_paid / nullif(CAST(nb_member AS DOUBLE), 0) AS burning_cost"""


def _fixed(dim: str) -> str:
    return f"(c.{dim} IS NULL OR c.{dim} = f.{dim})"


STEPS = {
    "st_versions": f"""
        SELECT c.*, v.VersionStartDate, CASE WHEN row_number() OVER (PARTITION BY v.PolicyID, v.MemberID ORDER BY v.VersionStartDate DESC, v.VersionEndDate DESC NULLS LAST) = 1
               THEN DATE '{AS_OF}' ELSE v.VersionEndDate END AS VersionEndDate
        FROM stg_contract_versions v JOIN st_contracts c ON c.member_id = v.MemberID AND c.PolicyID = v.PolicyID""",
    "st_member_months": f"""
        SELECT *, {bucket_sql("Age")} AS AgeBucket
        FROM (SELECT v.member_id, v.PolicyID, v.PolicySubType, v.UKMemberRegion, a.YearMonthDate AS year_month_date, v.VersionStartDate,
                     {age_sql("a.YearMonthDate", "v.DateOfBirth")} AS Age
              FROM st_versions v JOIN stg_active_members a ON a.MemberID = v.member_id AND a.PolicyID = v.PolicyID
              WHERE v.VersionStartDate <= a.YearMonthDate AND v.VersionEndDate >= a.YearMonthDate AND a.YearMonthDate < DATE '{CUT_OFF}') x
        WHERE Age >= 0""",
    "st_census": """
        SELECT year_month_date, PolicySubType, AgeBucket, UKMemberRegion, count(DISTINCT member_id) AS nb_member FROM st_member_months GROUP BY ALL""",
    "st_cube": """
        SELECT year_month_date, CASE WHEN grouping(PolicySubType) = 1 THEN '_' ELSE PolicySubType END AS PolicySubType,
               CASE WHEN grouping(AgeBucket) = 1 THEN '_' ELSE AgeBucket END AS AgeBucket,
               CASE WHEN grouping(UKMemberRegion) = 1 THEN '_' ELSE UKMemberRegion END AS UKMemberRegion, count(DISTINCT member_id) AS nb_member
        FROM st_member_months GROUP BY year_month_date, CUBE (PolicySubType, AgeBucket, UKMemberRegion)""",
    "st_invoice_months": f"""
        SELECT {month_sql("treatment_date")} AS year_month_date, {DIMS}, coalesce(sum(amount_paid), 0) AS amount_paid,
               count(DISTINCT claim_id) AS nb_claim, count(invoice_id) AS nb_invoice
        FROM st_invoices WHERE payment_date IS NOT NULL AND payment_date < DATE '{CUT_OFF}' GROUP BY ALL""",
    "st_coefficients": """
        SELECT *, ultimate_amount_paid_predicted / nullif(CAST(cumulative_amount_paid AS DOUBLE), 0) AS coef_amount,
               ultimate_nb_claim_paid_predicted / nullif(CAST(cumulative_nb_claim_paid AS DOUBLE), 0) AS coef_nb_claim,
               ultimate_nb_invoice_paid_predicted / nullif(CAST(cumulative_nb_invoice_paid AS DOUBLE), 0) AS coef_nb_invoice
        FROM st_export WHERE full_experiment = (SELECT min(full_experiment) FROM st_export)""",
    "st_inflated": f"""
        SELECT year_month_date, {DIMS}, CASE WHEN a.coef IS NOT NULL THEN amount_paid * a.coef ELSE amount_paid END AS amount_paid,
               CASE WHEN c.coef IS NOT NULL THEN nb_claim * c.coef ELSE nb_claim END AS nb_claim,
               CASE WHEN n.coef IS NOT NULL THEN nb_invoice * n.coef ELSE nb_invoice END AS nb_invoice
        FROM st_invoice_months
        FULL JOIN (SELECT PolicySubType, MajorICDGroupingDescription, treatment_date AS year_month_date, coef_amount AS coef FROM st_coefficients WHERE target = 'ultimate_amount_paid') a
          USING (PolicySubType, MajorICDGroupingDescription, year_month_date)
        FULL JOIN (SELECT PolicySubType, MajorICDGroupingDescription, treatment_date AS year_month_date, coef_nb_claim AS coef FROM st_coefficients WHERE target = 'ultimate_nb_claim_paid') c
          USING (PolicySubType, MajorICDGroupingDescription, year_month_date)
        FULL JOIN (SELECT PolicySubType, MajorICDGroupingDescription, treatment_date AS year_month_date, coef_nb_invoice AS coef FROM st_coefficients WHERE target = 'ultimate_nb_invoice_paid') n
          USING (PolicySubType, MajorICDGroupingDescription, year_month_date)""",
    "st_portfolio": f"""
        SELECT g.*, coalesce(i.amount_paid, 0) AS amount_paid, coalesce(i.nb_claim, 0) AS nb_claim, coalesce(i.nb_invoice, 0) AS nb_invoice
        FROM (SELECT * FROM st_cube CROSS JOIN (SELECT DISTINCT SystemID, MajorICDGroupingDescription FROM st_invoice_months) d) g
        LEFT JOIN st_invoice_months i USING (year_month_date, {DIMS})""",
    "st_cluster_dims": "SELECT DISTINCT cluster_id, PolicySubType, AgeBucket, UKMemberRegion, MajorICDGroupingDescription FROM stg_clusters",
    "st_cluster_claims": f"""
        SELECT c.cluster_id, f.year_month_date, sum(f.amount_paid) AS amount_paid, sum(f.nb_claim) AS nb_claim, sum(f.nb_invoice) AS nb_invoice
        FROM st_cluster_dims c JOIN st_portfolio f ON {" AND ".join(_fixed(d) for d in ["PolicySubType", "AgeBucket", "UKMemberRegion", "MajorICDGroupingDescription"])}
        WHERE f.PolicySubType <> '_' AND f.AgeBucket <> '_' AND f.UKMemberRegion <> '_' GROUP BY 1, 2""",
    "st_cluster_members": """
        SELECT cluster_id, year_month_date, sum(nb_member) AS nb_member
        FROM (SELECT DISTINCT c.cluster_id, f.year_month_date, f.PolicySubType, f.AgeBucket, f.UKMemberRegion, f.nb_member
              FROM st_cluster_dims c JOIN st_portfolio f ON f.PolicySubType = coalesce(c.PolicySubType, '_') AND f.AgeBucket = coalesce(c.AgeBucket, '_')
               AND f.UKMemberRegion = coalesce(c.UKMemberRegion, '_') AND (c.MajorICDGroupingDescription IS NULL OR c.MajorICDGroupingDescription = f.MajorICDGroupingDescription)) x
        GROUP BY 1, 2""",
    "st_series": f"""
        SELECT *, {RATIO_SQL}
        FROM (SELECT m.*, coalesce(c.amount_paid, 0) AS amount_paid, coalesce(c.nb_claim, 0) AS nb_claim, coalesce(c.nb_invoice, 0) AS nb_invoice
              FROM st_cluster_members m LEFT JOIN st_cluster_claims c USING (cluster_id, year_month_date)) x""",
    "st_inflated_series": "",
    "st_vintage": "SELECT * FROM stg_external_regressors WHERE SeenMonth = '2001_07'",
    "st_inflation_gold": f"""
        SELECT s.*, r.CPI, r.price_CPI, r.SeenMonth FROM st_series s JOIN st_vintage r ON r.YearMonthDate = s.year_month_date
        WHERE s.year_month_date >= DATE '{TRAINING_BEGIN}'""",
}


def _on_inflated(step: str) -> str:
    """A step of the plain run with the compensated invoice months and their dependants."""
    return STEPS[step].replace("st_invoice_months", "st_inflated").replace("st_portfolio", "st_inflated_portfolio")


STEPS["st_inflated_portfolio"] = _on_inflated("st_portfolio")
STEPS["st_inflated_claims"] = _on_inflated("st_cluster_claims")
STEPS["st_inflated_members"] = _on_inflated("st_cluster_members")
STEPS["st_inflated_series"] = (
    STEPS["st_series"].replace("st_cluster_members", "st_inflated_members").replace("st_cluster_claims", "st_inflated_claims")
)


def inflation_run(spark: SparkSession, sf_dir: str) -> InflationRun:
    def source(name: str) -> DataFrame:
        return staging.stage(spark, sf_dir, name)

    shares = staging.invoice_shares(spark, sf_dir)
    runs = [claims_run(spark, sf_dir, (k, shares)) for k in range(shares)] if shares > 1 else []
    return InflationRun(source, claims_run(spark, sf_dir), AS_OF, CUT_OFF, TRAINING_BEGIN, "2001-07-01", runs)


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cube, facts and clusters are written one after the other, so the shuffles of one are gone before those of the next."""
    run = inflation_run(spark, sf_dir)
    clusters = materialise(portfolio.cluster_dims(run.source("clusters")))
    return portfolio.cluster_members(materialise(run.census_cube(write=True)), run.facts(), clusters, ["MajorICDGroupingDescription"])


def _inflated(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = inflation_run(spark, sf_dir)
    return portfolio.apply_coefficients(run.invoice_months(), run.coefficients(), [["PolicySubType", "MajorICDGroupingDescription"]])


def _dq_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [portfolio.MONTH, "PolicySubType", "AgeBucket", "UKMemberRegion", "SystemID", "MajorICDGroupingDescription"]
    return quality.dq_counts(quality.add_dq_flags(inflation_run(spark, sf_dir).dense(), keys), keys)


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = inflation_run(spark, sf_dir).series()
    months = catalog.vintage_scan(staging.stage(spark, sf_dir, "external_regressors"), "2001-06-01")
    return quality.uncovered_keys(series, months.withColumnRenamed("YearMonthDate", portfolio.MONTH), [portfolio.MONTH])


def _regressor_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = inflation_run(spark, sf_dir)
    totals = run.census_cube().groupBy(portfolio.MONTH).agg(F.max("nb_member").alias("nb_member"))
    joined = totals.join(run.vintage().withColumnRenamed("YearMonthDate", portfolio.MONTH), portfolio.MONTH)
    return quality.missing_regressors(joined, ["CPI", "price_CPI"], portfolio.MONTH)


def _market_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = staging.read_table(spark, sf_dir, "lineitem")
    return portfolio.grouping_sets_total(
        lines, ["l_linenumber"], ["l_returnflag", "l_linestatus"], {"quantity": F.sum("l_quantity"), "lines": F.count("*")}
    )


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = portfolio.cluster_dims(staging.stage(spark, sf_dir, "clusters"))
    return portfolio.non_null_profile(clusters)


def _any_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = inflation_run(spark, sf_dir).census_cube()
    return portfolio.marker_probe(cube)


QUERIES = {
    "ag3_grouping_sets": Query(
        _market_cube,
        "l_linenumber:i l_returnflag:s l_linestatus:s dims_kept:i quantity:d lines:i",
        """SELECT l_linenumber, l_returnflag, l_linestatus, (1 - grouping(l_returnflag)) + 2 * (1 - grouping(l_linestatus)) AS dims_kept,
                  sum(l_quantity) AS quantity, count(*) AS lines FROM lineitem GROUP BY l_linenumber, CUBE (l_returnflag, l_linestatus)""",
    ),
    "ag7_non_null_profile": Query(
        _profile,
        "cluster_id:i PolicySubType:i AgeBucket:i UKMemberRegion:i SystemID:i MajorICDGroupingDescription:i",
        "SELECT count(cluster_id) AS cluster_id, count(PolicySubType) AS PolicySubType, count(AgeBucket) AS AgeBucket, count(UKMemberRegion) AS UKMemberRegion, "
        "0 AS SystemID, count(MajorICDGroupingDescription) AS MajorICDGroupingDescription FROM st_cluster_dims",
    ),
    "ag8_marker_probe": Query(
        _any_rows,
        "PolicySubType:b AgeBucket:b UKMemberRegion:b",
        "SELECT bool_or(PolicySubType = '_') AS PolicySubType, bool_or(AgeBucket = '_') AS AgeBucket, bool_or(UKMemberRegion = '_') AS UKMemberRegion FROM st_cube",
    ),
    "pf1_active_version": Query(
        lambda s, d: portfolio.active_version(inflation_run(s, d).contract_versions(), AS_OF),
        "member_id:i PolicyID:i VersionStartDate:t VersionEndDate:t",
        "SELECT * FROM st_versions",
    ),
    "jn6_valid_version": Query(
        lambda s, d: inflation_run(s, d).member_months(),
        "member_id:i PolicyID:i year_month_date:t VersionStartDate:t PolicySubType:s UKMemberRegion:s AgeBucket:s",
        "SELECT * FROM st_member_months",
    ),
    "pf2_monthly_census": Query(
        lambda s, d: portfolio.monthly_census(inflation_run(s, d).member_months()),
        "year_month_date:t PolicySubType:s AgeBucket:s UKMemberRegion:s nb_member:i",
        "SELECT * FROM st_census",
    ),
    "pf3_census_cube": Query(
        lambda s, d: inflation_run(s, d).census_cube(),
        "year_month_date:t PolicySubType:s AgeBucket:s UKMemberRegion:s nb_member:i",
        "SELECT * FROM st_cube",
    ),
    "pf4_monthly_invoices": Query(
        lambda s, d: inflation_run(s, d).invoice_months(),
        f"year_month_date:t {DIM_COLUMNS} amount_paid:d nb_claim:i nb_invoice:i",
        "SELECT * FROM st_invoice_months",
    ),
    "pf5_coefficients": Query(
        lambda s, d: inflation_run(s, d).coefficients(),
        "full_experiment:s segment:s target:s treatment_date:t lag:i coef_amount:d coef_nb_claim:d coef_nb_invoice:d",
        "SELECT regexp_replace(full_experiment, 'nb_invoice|nb_claim|Amount|Charge', '', 'g') AS full_experiment, * EXCLUDE (full_experiment) FROM st_coefficients",
    ),
    "pf6_apply_coefficients": Query(
        _inflated, f"year_month_date:t {DIM_COLUMNS} amount_paid:d nb_claim:d nb_invoice:d", "SELECT * FROM st_inflated"
    ),
    "pf7_dense_portfolio": Query(
        lambda s, d: inflation_run(s, d).dense(),
        f"year_month_date:t {DIM_COLUMNS} nb_member:i amount_paid:d nb_claim:d nb_invoice:d",
        "SELECT * FROM st_portfolio",
    ),
    "pf7_portfolio_dq": Query(
        _dq_portfolio,
        "year_month_date_null_dq_flag:i PolicySubType_null_dq_flag:i duplicated_row_dq_flag:i",
        f"SELECT count(*) - count(year_month_date) AS year_month_date_null_dq_flag, count(*) - count(PolicySubType) AS PolicySubType_null_dq_flag, "
        f"count(*) - count(DISTINCT (year_month_date, {DIMS})) AS duplicated_row_dq_flag FROM st_portfolio",
    ),
    "pf8_ratios": Query(
        lambda s, d: portfolio.add_ratios(inflation_run(s, d).dense()),
        f"year_month_date:t {DIM_COLUMNS} {RATIO_COLUMNS}",
        f"SELECT *, {RATIO_SQL} FROM st_portfolio",
    ),
    "pf9_cluster_series": Query(lambda s, d: inflation_run(s, d).series(), SERIES_COLUMNS, "SELECT * FROM st_series"),
    "ag9_cluster_members": Query(
        _members,
        "cluster_id:s year_month_date:t nb_member:i",
        "SELECT * FROM st_cluster_members",
    ),
    "pf9_compensated_series": Query(
        lambda s, d: inflation_run(s, d).series(compensate=True),
        SERIES_COLUMNS,
        "SELECT * FROM st_inflated_series",
    ),
    "jn8_wildcard_join": Query(
        lambda s, d: portfolio.cluster_claims(
            inflation_run(s, d).census_cube(), inflation_run(s, d).facts(), portfolio.cluster_dims(staging.stage(s, d, "clusters")),
            ["PolicySubType", "AgeBucket", "UKMemberRegion", "MajorICDGroupingDescription"],
        ),
        "cluster_id:s year_month_date:t amount_paid:d nb_claim:d nb_invoice:d",
        "SELECT * FROM st_cluster_claims",
    ),
    "pf10_inflation_gold": Query(
        lambda s, d: inflation_run(s, d).gold(),
        f"{SERIES_COLUMNS} CPI:d price_CPI:d SeenMonth:s",
        "SELECT * FROM st_inflation_gold",
    ),
    "pf11_model_grid": Query(
        lambda s, d: portfolio.model_grid(staging.stage(s, d, "clusters")),
        "model_name:s target:s scenario:s cluster_id:s model_config:s",
        """SELECT DISTINCT lower(concat('inflation_', translate(substr(base64(unhex(sha256(concat('inflation_scenario_', scenario, '_target_', target)))), 1, 6), '+/', '__'))) AS model_name,
                  target, scenario, cluster_id, model_config FROM stg_clusters""",
    ),
    "src3_vintage": Query(
        lambda s, d: inflation_run(s, d).vintage(), "SeenMonth:s YearMonthDate:t CPI:d price_CPI:d", "SELECT * FROM st_vintage"
    ),
    "dq6_regressor_guard": Query(
        _regressor_guard,
        "year_month_date:t CPI:b price_CPI:b invalid:b",
        "SELECT year_month_date, CPI IS NULL AS CPI, price_CPI IS NULL AS price_CPI, CPI IS NULL OR price_CPI IS NULL AS invalid "
        "FROM (SELECT DISTINCT year_month_date FROM st_census) m JOIN st_vintage ON YearMonthDate = year_month_date",
    ),
    "dq7_join_coverage": Query(
        _coverage,
        "year_month_date:t rows:i",
        "SELECT year_month_date, count(*) AS rows FROM st_series WHERE year_month_date NOT IN "
        "(SELECT YearMonthDate FROM stg_external_regressors WHERE SeenMonth = '2001_06') GROUP BY 1",
    ),
    "pr10_actuals": Query(
        lambda s, d: predictions.normalise_actuals(inflation_run(s, d).gold()),
        "cluster_id:s YearMonthDate:t NumberMembers:d NumberClaims:d AmountPaid:d NumberInvoices:d Frequency_claims:d Severity_claims:d BC:d CPI:d price_CPI:d Frequency_invoices:d Severity_invoices:d SeenMonth:s",
        """SELECT cluster_id, year_month_date AS YearMonthDate, nb_member AS NumberMembers, nb_claim AS NumberClaims, amount_paid AS AmountPaid, nb_invoice AS NumberInvoices,
                  frequency_claim AS Frequency_claims, severity_claim AS Severity_claims, burning_cost AS BC, CPI, price_CPI,
                  frequency_invoice AS Frequency_invoices, severity_invoice AS Severity_invoices, SeenMonth FROM st_inflation_gold""",
    ),
    "pr10_cluster_dims": Query(
        lambda s, d: predictions.normalise_clusters(staging.stage(s, d, "clusters")),
        "cluster_id:s MajorICDGroupingDescription:s AgeBucket:s UKMemberRegion:s PolicySubType:s",
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY MajorICDGroupingDescription NULLS FIRST, AgeBucket NULLS FIRST,
                  UKMemberRegion NULLS FIRST, PolicySubType NULLS FIRST) AS rn FROM st_cluster_dims) x WHERE rn = 1""",
    ),
}
