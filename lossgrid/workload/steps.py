"""SQL form of the shared pipeline steps, written straight from the definitions for the value checks."""

from __future__ import annotations

from lossgrid.sources import staging

AS_OF = "2001-08-15"
EARLIEST = "1995-01-01"

CLAIMS_START, CLAIMS_END = "2000-08-01", "2001-07-01"
SEGMENTS = ["PolicySubType", "SystemID"]
CUT_OFF = "2001-08-01"
GRAIN = "treatment_date, PolicySubType, AgeBucket, UKMemberRegion, SystemID, MajorICDGroupingDescription"


def age_sql(event: str, birth: str) -> str:
    months = f"(year({event}) - year({birth})) * 12 + month({event}) - month({birth})"
    short = f"CASE WHEN day({event}) < day({birth}) AND NOT ({event} = last_day({event}) AND {birth} = last_day({birth})) THEN 1 ELSE 0 END"
    return f"CAST(floor(({months} - {short}) / 12.0) AS BIGINT)"


def bucket_sql(age: str) -> str:
    return (
        f"CASE WHEN {age} < 0 THEN NULL WHEN {age} <= 20 THEN '0_20' WHEN {age} <= 35 THEN '21_35' "
        f"WHEN {age} <= 50 THEN '36_50' WHEN {age} <= 60 THEN '51_60' WHEN {age} > 60 THEN '60_plus' END"
    )


def months_sql(later: str, earlier: str) -> str:
    return f"((year({later}) - year({earlier})) * 12 + month({later}) - month({earlier}))"


def month_sql(column: str) -> str:
    return f"CAST(date_trunc('month', {column}) AS DATE)"


def triangle_sql(source: str, lag: str) -> str:
    """Cumulative triangle by definition: every grain and every lag that occurs, joined to all earlier rows."""
    same_grain = " AND ".join(f"i.{c} = g.{c}" for c in GRAIN.split(", "))
    segs = ", ".join(SEGMENTS)
    return f"""
        SELECT c.*, first_value(cumulative_amount) OVER w AS ultimate_amount, first_value(cumulative_nb_claim) OVER w AS ultimate_nb_claim,
               first_value(cumulative_nb_invoice) OVER w AS ultimate_nb_invoice
        FROM (SELECT treatment_date, lag, {segs}, coalesce(sum(amount), 0) AS cumulative_amount,
                     sum(nb_claim) AS cumulative_nb_claim, sum(nb_invoice) AS cumulative_nb_invoice
              FROM (SELECT {", ".join("g." + c for c in GRAIN.split(", "))}, l.lag, sum(i.amount_paid) AS amount,
                           count(DISTINCT i.claim_id) AS nb_claim, count(DISTINCT i.invoice_id) AS nb_invoice
                    FROM (SELECT DISTINCT {GRAIN} FROM ({source}) s WHERE {lag} BETWEEN 0 AND 36) g
                    CROSS JOIN (SELECT DISTINCT {lag} AS lag FROM ({source}) s WHERE {lag} BETWEEN 0 AND 36) l
                    LEFT JOIN (SELECT * FROM ({source}) s WHERE {lag} BETWEEN 0 AND 36) i ON {same_grain} AND i.{lag} <= l.lag
                    GROUP BY ALL) x
              GROUP BY ALL) c
        WINDOW w AS (PARTITION BY treatment_date, {segs} ORDER BY lag DESC)"""


def _dq(source: str, keys: str, rest: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in rest.split(","))
    nulls = ", ".join(f"{k.strip()} IS NULL AS {k.strip()}_null_dq_flag" for k in keys.split(","))
    flags = " OR ".join([f"{k.strip()}_null_dq_flag" for k in keys.split(",")] + ["duplicated_row_dq_flag"])
    return f"""
        SELECT *, NOT ({flags}) AS valid_row
        FROM (SELECT *, {nulls}, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) > 1 AS duplicated_row_dq_flag FROM {source}) f"""


STEPS = {f"stg_{name}": staging.plain_sql(text) for name, text in staging.STATEMENTS.items()}
STEPS |= {
    "dq_invoicebase": _dq(
        "stg_invoicebase",
        "InvoiceKey",
        "SystemID, System, TreatmentDate, DateReceived, PaidDate, AmountPaid, MajorICDGroupingDescription, InvoiceStatus, tie1, tie2, tie3, tie4, tie5, tie6, tie7, tie8",
    ),
    "dq_invoicelink": _dq("stg_invoicelink", "InvoiceKey", "ClaimKey, SystemLink, MemberID, HistoryID, PolicyID"),
    "st_policies": f"""
        SELECT * FROM (SELECT PolicyID, SystemID, HistoryID, CASE WHEN PolicyType <> 'Trust' THEN PolicySubType ELSE 'Trust' END AS PolicySubType,
                              PolicyType, ProductFamily, CoverStartDate FROM stg_policies) p
        WHERE NOT (PolicyType IN ('SAGA', 'SAGA Accidental Healthcare', 'Dental', 'Cashback'))
          AND (NOT (ProductFamily IN ('JERSEY', 'GUERNSEY', 'IHP') OR ProductFamily LIKE '%IHP%' OR ProductFamily LIKE '%SAGA%') OR ProductFamily IS NULL)
          AND PolicySubType IN ('Employee (LC)', 'Employee (SME)', 'Individual', 'Trust') AND CoverStartDate >= DATE '{EARLIEST}'""",
    "st_members": """
        SELECT MemberID AS member_id, PolicyID, SystemID, HistoryID, PolicyHistoryID, split_part(PostCode, ' ', 1) AS PostCode, DateOfBirth FROM stg_members""",
    "st_contracts": """
        SELECT m.member_id, p.PolicyID, p.SystemID, m.HistoryID, p.PolicySubType, m.DateOfBirth, coalesce(g.UkRegion, 'Unknown') AS UKMemberRegion
        FROM st_members m JOIN st_policies p ON p.PolicyID = m.PolicyID AND p.SystemID = m.SystemID AND p.HistoryID = m.PolicyHistoryID
        LEFT JOIN stg_geography g ON g.PostCode = m.PostCode""",
    "st_invoicebase": f"""
        SELECT InvoiceKey AS invoice_id, SystemID, System, TreatmentDate AS treatment_date, DateReceived AS reception_date, PaidDate AS payment_date,
               AmountPaid AS amount_paid, coalesce(MajorICDGroupingDescription, 'Unknown') AS MajorICDGroupingDescription, InvoiceStatus
        FROM dq_invoicebase
        WHERE valid_row AND System IN ('ACS', 'CIMA') AND InvoiceStatus IN ('Paid', 'Pending', 'Cancelled') AND TreatmentDate IS NOT NULL
          AND TreatmentDate >= DATE '{EARLIEST}' AND TreatmentDate < DATE '{CUT_OFF}' AND (PaidDate IS NULL OR TreatmentDate <= PaidDate)""",
    "st_invoicelink": """
        SELECT InvoiceKey AS invoice_id, coalesce(ClaimKey, MemberID) AS claim_id, SystemLink, MemberID AS member_id, HistoryID, PolicyID
        FROM dq_invoicelink WHERE valid_row""",
    "st_invoices": f"""
        SELECT *, {bucket_sql("Age")} AS AgeBucket
        FROM (SELECT b.*, l.claim_id, c.PolicySubType, c.DateOfBirth, c.UKMemberRegion, {age_sql("b.treatment_date", "c.DateOfBirth")} AS Age
              FROM st_invoicebase b JOIN st_invoicelink l ON l.invoice_id = b.invoice_id
              LEFT JOIN st_contracts c ON c.member_id = l.member_id AND c.SystemID = l.SystemLink AND c.HistoryID = l.HistoryID AND c.PolicyID = l.PolicyID) x
        WHERE Age >= 0""",
    "st_lags": f"""
        SELECT invoice_id, claim_id, SystemID, MajorICDGroupingDescription, PolicySubType, UKMemberRegion, AgeBucket, Age, amount_paid,
               coalesce(reception_date - treatment_date, 36135) AS daily_lag_treatment_reception,
               coalesce(payment_date - treatment_date, 36135) AS daily_lag_treatment_payment,
               coalesce(payment_date - reception_date, 36135) AS daily_lag_reception_payment,
               coalesce({months_sql("reception_date", "treatment_date")}, 99) AS lag_treatment_reception,
               coalesce({months_sql("payment_date", "treatment_date")}, 99) AS lag_treatment_payment,
               coalesce({months_sql("payment_date", "reception_date")}, 99) AS lag_reception_payment,
               treatment_date AS treatment_date_full, reception_date AS reception_date_full, payment_date AS payment_date_full,
               {month_sql("treatment_date")} AS treatment_date, {month_sql("reception_date")} AS reception_date, {month_sql("payment_date")} AS payment_date,
               month(treatment_date) AS treatment_date_month, month(reception_date) AS reception_date_month
        FROM st_invoices""",
    "st_preauthbase": f"""
        SELECT PreAuthTreatmentKey, ClaimKey AS claim_id, SystemId AS SystemID, {month_sql("TreatmentEffectiveDate")} AS TreatmentEffectiveDate,
               TreatmentEffectiveDate AS TreatmentEffectiveDate_full
        FROM stg_preauthbase
        WHERE TreatmentEarliestRecord = 'Yes' AND TreatmentDecisionCategory NOT IN ('Rejected', 'Ignore')
          AND year(TreatmentEffectiveDate) >= 1995 AND TreatmentEffectiveDate < DATE '{CUT_OFF}'""",
    "st_preauth": f"""
        SELECT *, {bucket_sql("Age")} AS AgeBucket
        FROM (SELECT p.*, c.PolicySubType, c.UKMemberRegion, {age_sql("p.TreatmentEffectiveDate", "c.DateOfBirth")} AS Age
              FROM st_preauthbase p JOIN stg_claimlink l ON l.ClaimKey = p.claim_id
              JOIN st_contracts c ON c.member_id = l.MemberID AND c.SystemID = l.SystemLink AND c.HistoryID = l.HistoryID AND c.PolicyID = l.PolicyID) x
        WHERE Age >= 0""",
    "st_paid": triangle_sql("SELECT * FROM st_lags WHERE payment_date IS NOT NULL", "lag_treatment_payment"),
    "st_received": triangle_sql("SELECT * FROM st_lags", "lag_treatment_reception"),
    "st_months": """
        SELECT payment_date, avg(daily_lag_reception_payment) AS avg_monthly_processing_time
        FROM st_lags WHERE daily_lag_reception_payment BETWEEN 0 AND 93 GROUP BY 1""",
    "st_weeks": """
        SELECT payment_date, avg(days) FILTER (WHERE week = 1) AS avg_processing_time_w1, avg(days) FILTER (WHERE week = 2) AS avg_processing_time_w2,
               avg(days) FILTER (WHERE week = 3) AS avg_processing_time_w3, avg(days) FILTER (WHERE week = 4) AS avg_processing_time_w4
        FROM (SELECT payment_date, daily_lag_reception_payment AS days, (day(payment_date_full) - day(last_day(payment_date)) % 7 - 1) // 7 + 1 AS week
              FROM st_lags WHERE daily_lag_reception_payment BETWEEN 0 AND 93
                AND payment_date_full >= payment_date + CAST(day(last_day(payment_date)) % 7 AS INT)) x
        GROUP BY 1""",
    "st_preauth_counts": """
        SELECT TreatmentEffectiveDate, PolicySubType, SystemID, count(*) AS nb_preauth FROM st_preauth GROUP BY ALL""",
    "st_features": """
        SELECT x.*, coalesce(m.avg_monthly_processing_time, 0) AS avg_monthly_processing_time,
               coalesce(w.avg_processing_time_w1, 0) AS avg_processing_time_w1, coalesce(w.avg_processing_time_w2, 0) AS avg_processing_time_w2,
               coalesce(w.avg_processing_time_w3, 0) AS avg_processing_time_w3, coalesce(w.avg_processing_time_w4, 0) AS avg_processing_time_w4,
               coalesce(a.nb_preauth, 0) AS nb_preauth, month(x.treatment_date) AS treatment_date_month
        FROM (SELECT PolicySubType, SystemID, treatment_date, lag, coalesce(p.cumulative_amount, 0) AS cumulative_amount_paid,
                     coalesce(p.cumulative_nb_claim, 0) AS cumulative_nb_claim_paid, coalesce(p.cumulative_nb_invoice, 0) AS cumulative_nb_invoice_paid,
                     p.ultimate_amount AS ultimate_amount_paid, p.ultimate_nb_claim AS ultimate_nb_claim_paid, p.ultimate_nb_invoice AS ultimate_nb_invoice_paid,
                     coalesce(r.cumulative_amount, 0) AS cumulative_amount_received,
                     coalesce(r.cumulative_nb_claim, 0) - coalesce(p.cumulative_nb_claim, 0) AS cumulative_nb_claim_received_but_not_paid,
                     coalesce(r.cumulative_nb_invoice, 0) - coalesce(p.cumulative_nb_invoice, 0) AS cumulative_nb_invoice_received_but_not_paid
              FROM st_paid p FULL JOIN st_received r USING (PolicySubType, SystemID, treatment_date, lag)) x
        LEFT JOIN st_months m ON m.payment_date = CAST(x.treatment_date + to_months(CAST(x.lag AS INT)) AS DATE)
        LEFT JOIN st_weeks w ON w.payment_date = CAST(x.treatment_date + to_months(CAST(x.lag AS INT)) AS DATE)
        LEFT JOIN st_preauth_counts a ON a.TreatmentEffectiveDate = x.treatment_date AND a.PolicySubType = x.PolicySubType AND a.SystemID = x.SystemID
        WHERE x.lag < 12""",
    "st_gold": f"""
        SELECT *, concat_ws('_', PolicySubType, SystemID) AS segment, concat_ws('_', PolicySubType, SystemID, lag) AS segment_key,
               lag = {months_sql(f"DATE '{CLAIMS_END}'", "treatment_date")} AND treatment_date >= DATE '{CLAIMS_START}' AS is_inference
        FROM st_features WHERE treatment_date BETWEEN DATE '{CLAIMS_START}' - INTERVAL 5 YEAR AND DATE '{CLAIMS_END}'""",
}
