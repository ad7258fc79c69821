"""Claims model staged from the order tables, as SQL that Spark and other engines read alike.

``{table}`` stands for an input table. Every statement covers its whole tables.
"""

from __future__ import annotations

import string
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

STATEMENTS = {
    "invoicebase": """
        SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS InvoiceKey,
               l_returnflag AS SystemID,
               CASE WHEN l_linenumber = 7 THEN 'OTHER' WHEN l_linenumber % 2 = 0 THEN 'CIMA' ELSE 'ACS' END AS System,
               CAST(o_orderdate AS DATE) AS TreatmentDate,
               CAST(o_orderdate AS DATE) + CAST(l_partkey % 45 AS INT) AS DateReceived,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS PaidDate,
               l_extendedprice * (1 - l_discount) AS AmountPaid,
               CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE p_type END AS MajorICDGroupingDescription,
               CASE WHEN l_linestatus = 'F' THEN 'Paid' WHEN l_suppkey % 10 = 0 THEN 'Rejected' ELSE 'Pending' END AS InvoiceStatus,
               l_partkey AS tie1, l_suppkey AS tie2, l_extendedprice AS tie3, CAST(l_shipdate AS DATE) AS tie4,
               l_quantity AS tie5, l_tax AS tie6, l_discount AS tie7, l_linestatus AS tie8
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "invoicelink": """
        SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS InvoiceKey,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS ClaimKey,
               'S' AS SystemLink, o_custkey AS MemberID, 'H' AS HistoryID, o_custkey % 97 AS PolicyID
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "policies": """
        SELECT PolicyID, 'S' AS SystemID, 'H' AS HistoryID,
               CASE PolicyID % 5 WHEN 0 THEN 'Employee (LC)' WHEN 1 THEN 'Employee (SME)' WHEN 2 THEN 'Individual' WHEN 3 THEN 'Trust' ELSE 'Other' END AS PolicySubType,
               CASE PolicyID % 13 WHEN 0 THEN 'SAGA' WHEN 1 THEN 'Trust' WHEN 2 THEN NULL WHEN 3 THEN 'Dental' ELSE 'Corporate' END AS PolicyType,
               CASE PolicyID % 17 WHEN 0 THEN 'JERSEY' WHEN 1 THEN 'X IHP Y' WHEN 2 THEN NULL ELSE 'CORE' END AS ProductFamily,
               CAST('1994-01-01' AS DATE) + CAST(PolicyID * 40 AS INT) AS CoverStartDate
        FROM (SELECT DISTINCT c_custkey % 97 AS PolicyID FROM {customer}) p""",
    "members": """
        SELECT c_custkey AS MemberID, c_custkey % 97 AS PolicyID, 'S' AS SystemID, 'H' AS HistoryID, 'H' AS PolicyHistoryID,
               concat('N', CAST(c_nationkey AS STRING), ' ', CAST(c_custkey AS STRING)) AS PostCode,
               CAST('1930-01-01' AS DATE) + CAST((c_custkey * 7919) % 25000 AS INT) AS DateOfBirth
        FROM {customer}""",
    "geography": """
        SELECT concat(CASE WHEN n_nationkey = 24 THEN 'X' ELSE 'N' END, CAST(n_nationkey AS STRING)) AS PostCode, r_name AS UkRegion
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "preauthbase": """
        SELECT o_orderkey AS PreAuthTreatmentKey, 0 AS PreAuthTreatmentHistoryKey, o_orderkey AS ClaimKey,
               CASE WHEN o_orderkey % 3 = 0 THEN 'A' WHEN o_orderkey % 3 = 1 THEN 'N' ELSE 'R' END AS SystemId,
               CAST(o_orderdate AS DATE) AS TreatmentEffectiveDate,
               CASE o_orderpriority WHEN '5-LOW' THEN 'Rejected' WHEN '4-NOT SPECIFIED' THEN 'Ignore' ELSE 'Approved' END AS TreatmentDecisionCategory,
               CASE WHEN o_orderkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS TreatmentEarliestRecord
        FROM {orders}""",
    "claimlink": """
        SELECT o_orderkey AS ClaimKey, 'S' AS SystemLink, o_custkey % 97 AS PolicyID, 'H' AS HistoryID, o_custkey AS MemberID
        FROM {orders}""",
    "contract_versions": """
        SELECT o_custkey AS MemberID, o_custkey % 97 AS PolicyID, d AS VersionStartDate,
               lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS VersionEndDate
        FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM {orders}) x
        UNION ALL
        SELECT o_custkey, o_custkey % 97, max(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + 10 FROM {orders} WHERE o_custkey % 50 = 0 GROUP BY 1, 2""",
    "active_members": """
        SELECT DISTINCT o_custkey AS MemberID, o_custkey % 97 AS PolicyID, CAST(date_trunc('month', l_shipdate) AS DATE) AS YearMonthDate
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "external_regressors": """
        WITH months AS (
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS YearMonthDate,
                   avg(CASE WHEN o_orderpriority < '3' THEN o_totalprice END) AS CPI, avg(o_totalprice) AS price_CPI
            FROM {orders} GROUP BY 1)
        SELECT '2001_06' AS SeenMonth, YearMonthDate, CPI, price_CPI FROM months WHERE YearMonthDate <= DATE '2001-06-01'
        UNION ALL SELECT '2001_07', YearMonthDate, CPI, price_CPI FROM months WHERE YearMonthDate <= DATE '2001-07-01'""",
    "clusters": """
        WITH customer_dims AS (
            SELECT c_custkey,
                   CASE (c_custkey % 97) % 5 WHEN 0 THEN 'Employee (LC)' WHEN 1 THEN 'Employee (SME)' WHEN 2 THEN 'Individual' WHEN 3 THEN 'Trust' ELSE 'Other' END AS sub,
                   r_name
            FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey),
        dims AS (
            SELECT DISTINCT concat('sub:', sub) AS cluster_id, sub, CAST(NULL AS STRING) AS region, CAST(NULL AS STRING) AS icd FROM customer_dims
            UNION ALL SELECT DISTINCT concat('icd:', p_type), CAST(NULL AS STRING), CAST(NULL AS STRING), p_type FROM {part}
            UNION ALL SELECT DISTINCT concat('region:', r_name, '|', sub), sub, r_name, CAST(NULL AS STRING) FROM customer_dims
            UNION ALL SELECT DISTINCT 'employees', sub, CAST(NULL AS STRING), CAST(NULL AS STRING) FROM customer_dims WHERE sub LIKE 'Employee%'
            UNION ALL SELECT DISTINCT concat('icd:', p_type, '|', sub), sub, CAST(NULL AS STRING), p_type
                      FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey JOIN customer_dims ON o_custkey = c_custkey),
        settings AS (
            SELECT *, 'burning_cost' AS target, 'base' AS scenario, concat('prior:', CAST(length(cluster_id) % 5 AS STRING)) AS model_config FROM dims
            UNION ALL SELECT *, 'frequency_claim', 'base', concat('prior:', CAST(length(cluster_id) % 3 AS STRING)) FROM dims
            UNION ALL SELECT *, 'burning_cost', 'high', 'prior:9' FROM dims)
        SELECT cluster_id, target, scenario, model_config, sub AS PolicySubType, CAST(NULL AS STRING) AS AgeBucket,
               region AS UKMemberRegion, icd AS MajorICDGroupingDescription FROM settings""",
    "payload": """
        SELECT event_id, concat('m', CAST(event_id % 3 AS STRING)) AS model_name, user_id % 10 AS segment,
               CAST(event_id % 12 AS INT) AS lag, ts, value AS prediction, event_type <> 'error' AS is_inference
        FROM {events}""",
    "reserving_payload": """
        SELECT concat('ibnr_', experiment, '_', target) AS model_name, concat('PRED | ', experiment) AS experiment_without_target,
               concat('PRED | ', experiment, '_', target) AS full_experiment, target,
               concat_ws('_', PolicySubType, icd) AS segment, concat_ws('_', PolicySubType, icd, CAST(lag AS STRING)) AS segment_key,
               PolicySubType, icd AS MajorICDGroupingDescription, treatment_date, lag,
               cumulative_amount_paid, cumulative_nb_claim_paid, cumulative_nb_invoice_paid,
               CASE target WHEN 'ultimate_amount_paid' THEN cumulative_amount_paid WHEN 'ultimate_nb_claim_paid' THEN cumulative_nb_claim_paid
                    ELSE cumulative_nb_invoice_paid END * (1 + CAST(lag AS DOUBLE) / 8) AS prediction,
               CASE run WHEN 0 THEN TIMESTAMP '2001-08-10 01:30:00' WHEN 1 THEN TIMESTAMP '2001-08-10 06:00:00' ELSE TIMESTAMP '2001-08-10 09:45:00' END AS ts,
               lag <> 11 AS is_inference, TRUE AS ibnr_standalone, experiment LIKE 'e0%' AS ibnr_inflation
        FROM (SELECT CASE (o_custkey % 97) % 5 WHEN 0 THEN 'Employee (LC)' WHEN 1 THEN 'Employee (SME)' WHEN 2 THEN 'Individual' WHEN 3 THEN 'Trust' ELSE 'Other' END AS PolicySubType,
                     p_type AS icd, CAST(date_trunc('month', o_orderdate) AS DATE) AS treatment_date,
                     (19 - month(o_orderdate)) % 12 AS lag,
                     concat('e', CAST(l_suppkey % 2 AS STRING), 'w', CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) > 7 THEN 1 ELSE 0 END AS STRING)) AS experiment,
                     CASE l_linenumber % 3 WHEN 0 THEN 'ultimate_amount_paid' WHEN 1 THEN 'ultimate_nb_claim_paid' ELSE 'ultimate_nb_invoice_paid' END AS target,
                     l_partkey % 3 AS run, sum(l_extendedprice) AS cumulative_amount_paid,
                     count(DISTINCT l_orderkey) AS cumulative_nb_claim_paid, count(*) AS cumulative_nb_invoice_paid
              FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
              GROUP BY 1, 2, 3, 4, 5, 6, 7) x""",
    "forecast_payload": """
        SELECT concat('inflation_', target, '_', scenario) AS model_name, target, scenario AS origin, cluster_id, year_month_date,
               value AS prediction, value - 1 AS prediction_lower, value * 2 AS prediction_upper,
               event_type <> 'error' AS is_inference, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts, event_id
        FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'burning_cost' WHEN 1 THEN ' Frequency claims ' WHEN 2 THEN 'severity_claim' ELSE 'other' END AS target,
                     CASE WHEN user_id % 3 = 0 THEN 'high' ELSE 'base' END AS scenario,
                     CASE user_id % 6 WHEN 0 THEN 'sub:Trust' WHEN 1 THEN 'sub:Individual' WHEN 2 THEN 'employees' WHEN 3 THEN 'sub:Other' WHEN 4 THEN 'sub:Employee (LC)' ELSE 'unknown' END AS cluster_id,
                     CASE WHEN event_id % 13 = 0 THEN NULL ELSE CASE user_id % 4 WHEN 0 THEN DATE '2001-03-01' WHEN 1 THEN DATE '2001-04-01' WHEN 2 THEN DATE '2001-05-01' ELSE DATE '2001-06-01' END END AS year_month_date,
                     event_id, event_type, ts, value
              FROM {events}) e""",
    "scores": """
        SELECT l.doc_id, l.quality AS label, CAST(d.n_chars % 1000 AS DOUBLE) / 1000 AS score
        FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
}


def table_names(statement: str) -> list[str]:
    """Input tables a statement names."""
    return sorted({field for _, field, _, _ in string.Formatter().parse(statement) if field})


@lru_cache(maxsize=64)
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Input table; the lazy frame is kept so that one run lists its files once."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, statement: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a staging statement with every ``{table}`` bound to its parquet file, or to the frame in ``tables``."""
    return spark.sql(statement, **{name: (tables or {}).get(name) or read_table(spark, sf_dir, name) for name in table_names(statement)})


def stage(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run_sql(spark, sf_dir, STATEMENTS[name])


#: Bytes of lineitem files from which invoices are built in shares, and most shares.
SHARE_BYTES, SHARES = 32_000_000, 4
#: What a share of the orders changes. The key of an invoice holds the key of its order, so all copies of an invoice are in one share.
SHARED = ("invoicebase", "invoicelink")


def invoice_shares(spark: SparkSession, sf_dir: str) -> int:
    size = int(read_table(spark, sf_dir, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(SHARES, -(-size // SHARE_BYTES)) or 1


def stage_share(spark: SparkSession, sf_dir: str, name: str, share: int, shares: int) -> DataFrame:
    """The staged table over the lines of one of ``shares`` shares of the orders, if it is a table of invoices."""
    if name not in SHARED:
        return stage(spark, sf_dir, name)
    mine = F.pmod(F.xxhash64("l_orderkey"), F.lit(shares)) == share
    return run_sql(spark, sf_dir, STATEMENTS[name], {"lineitem": read_table(spark, sf_dir, "lineitem").where(mine)})


def plain_sql(statement: str) -> str:
    """The same statement with the tables as plain names."""
    return statement.format(**{name: name for name in table_names(statement)})
