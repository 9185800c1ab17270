"""The marts over report-shaped frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from revflow.operators.shape import blank_null_columns, union_conform
from revflow.plans import marts
from revflow.workload.carrier import (
    AR_AGING_SQL,
    AS_OF,
    CHARGES_SQL,
    GROSS_BILLING_SQL,
    LOC_SQL,
    PAYERS_SQL,
    PAYMENT_TREND_SQL,
    ar_aging_report,
    charges_on_hold_report,
    gross_billing_report,
    money_sql,
    payers,
    payment_trend_report,
)
from revflow.workload.registry import Tables, query

HOLD_SQL = """CASE WHEN {d} <= 5 THEN '0-5 days' WHEN {d} <= 10 THEN '6-10 days'
    WHEN {d} < 15 THEN '11-14 days' WHEN {d} <= 21 THEN '15-21 days'
    WHEN {d} <= 30 THEN '22-30 days' WHEN {d} <= 45 THEN '31-45 days'
    WHEN {d} <= 60 THEN '46-60 days' WHEN {d} <= 90 THEN '61-90 days'
    WHEN {d} > 90 THEN 'over 90 days' END"""
STATEMENT_SQL = """CASE WHEN {n} < 3 THEN 'less than 3 statements'
    WHEN {n} BETWEEN 3 AND 4 THEN '3-4 statements' WHEN {n} BETWEEN 5 AND 6 THEN '5-6 statements'
    WHEN {n} > 6 THEN 'over 6 statements' END"""


def label_sql(prefix: str, d: str, capital: bool) -> str:
    day = f"dayname({d})" if capital else f"lower(dayname({d}))"
    return f"""rpad({day}, 9, ' ') AS {prefix}_day,
    'Week' || strftime({d}, '%V') AS {prefix}_week,
    rpad(monthname({d}), 9, ' ') AS {prefix}_month, strftime({d}, '%Y') AS {prefix}_year"""


def double(x: str, name: str) -> str:
    return f"CAST({x} AS DOUBLE) AS {name}"


@query(
    "mart_gross_billing",
    f"""WITH {CHARGES_SQL}, {GROSS_BILLING_SQL},
cte AS (
  SELECT gb.* EXCLUDE (charge_primary_payer_name_1, charge_from_date, charge_to_date,
      charge_entered_date, claim_first_billed_date),
    practice_name AS office_name, practice_name AS facility_name,
    charge_primary_payer_name_1 AS charge_primary_payer_name_dup,
    CAST(charge_from_date AS VARCHAR) AS charge_from_date,
    CAST(charge_to_date AS VARCHAR) AS charge_to_date,
    CAST(charge_entered_date AS VARCHAR) AS charge_entered_date,
    CAST(claim_first_billed_date AS VARCHAR) AS claim_first_billed_date,
    CAST(charge_entered_date AS VARCHAR) AS date_charge_entered_date,
    CAST(DATE '{AS_OF}' - charge_entered_date AS INTEGER) AS days_on_hold,
    CAST(claim_first_billed_date - charge_entered_date AS INTEGER) AS charge_lag,
    CASE WHEN claim_first_billed_date IS NOT NULL THEN 'Billed' ELSE 'Not Billed' END
      AS billed_or_not_billed,
    {label_sql("claim_first_billed", "claim_first_billed_date", False)},
    level_of_care AS loc, {double(money_sql("charge_amount"), "int_charge_amount")},
    CAST(claim_first_billed_date - CAST(dayofweek(claim_first_billed_date) AS INTEGER) AS VARCHAR)
      AS first_billed_week_date
  FROM gross_billing gb LEFT JOIN {LOC_SQL} ON rev_code = charge_rev_code)
SELECT *, {HOLD_SQL.format(d="days_on_hold")} AS days_on_hold_range,
  concat(claim_first_billed_month, '', claim_first_billed_year) AS claim_first_billed_ym
FROM cte""",
)
def mart_gross_billing(t: Tables) -> DataFrame:
    as_of = F.lit(AS_OF).cast("date")
    return marts.gross_billing(gross_billing_report(t), as_of=as_of, rejects=Observation())


@query(
    "mart_ar_aging",
    f"""WITH {CHARGES_SQL}, {AR_AGING_SQL}, {PAYERS_SQL},
cte AS (
  SELECT * EXCLUDE (instance_key, patient_id, patient_full_name),
    practice_name AS office_name, practice_name AS facility_name,
    charge_primary_payer_name AS charge_current_payer_name, patient_id AS claim_patient_id,
    regexp_replace(patient_full_name, '\\s*\\(\\d+\\)$', '') AS patient_full_name,
    {money_sql("charge_balance_due_ins")} AS ins, {money_sql("charge_balance_due_other")} AS other,
    {money_sql("charge_balance_due_pat")} AS pat,
    CAST(patient_stmts_sent_electronically AS DECIMAL(18,2)) AS sent,
    CAST(patient_statements_printed AS DECIMAL(18,2)) AS printed
  FROM ar_aging)
SELECT cte.* EXCLUDE (ins, other, pat, sent, printed),
  {double("ins", "int_charge_balance_due_ins")}, {double("other", "int_charge_balance_due_other")},
  {double("pat", "int_charge_balance_due_pat")},
  {double("sent", "int_patient_stmts_sent_electronically")},
  {double("printed", "int_patient_statements_printed")},
  {double("ins + other", "balance_due_payer")}, {double("printed + sent", "total_statements")},
  {STATEMENT_SQL.format(n="(printed + sent)")} AS total_statement_buckets, payer_code
FROM cte LEFT JOIN payer_name_crosswalk pc ON pc.payer_name = cte.charge_primary_payer_name""",
)
def mart_ar_aging(t: Tables) -> DataFrame:
    return marts.ar_aging(ar_aging_report(t), payers(t), rejects=Observation())


@query(
    "mart_payment_trends",
    f"""WITH {CHARGES_SQL}, {PAYMENT_TREND_SQL}
SELECT pt.* EXCLUDE (claim_id, charge_primary_payer_name, from_day, received_day, entered_day),
  practice_name AS facility_name, practice_name AS office_name, 'Patient' AS payment_source,
  claim_id AS charge_claim_id, charge_primary_payer_name AS payer_name,
  payment_total_applied AS payment_applied_amount,
  {label_sql("charge_from", "from_day", True)},
  {label_sql("payment_received", "received_day", True)},
  CASE WHEN {money_sql("payment_allowed_amount")} > 0 THEN 'Paid' ELSE 'Not Paid' END
    AS payment_status,
  {double(money_sql("payment_allowed_amount"), "int_payment_allowed_amount")},
  level_of_care,
  CASE WHEN {money_sql("insurance_paid_amount")} > 0 THEN true ELSE false END
    AS has_insurance_payment,
  {double(money_sql("insurance_paid_amount"), "int_insurance_paid_amount")},
  CAST(received_day - entered_day AS INTEGER) AS payment_posting_tat,
  {double(money_sql("patient_applied_amount"), "int_payment_applied_amount")},
  {double(money_sql("payment_total_applied"), "int_payment_total_applied")},
  {double(money_sql("payment_total_paid"), "int_payment_total_paid")},
  {double(money_sql("payment_unapplied_amount"), "int_payment_unapplied_amount")}
FROM payment_trend pt LEFT JOIN {LOC_SQL} ON rev_code = charge_rev_code""",
)
def mart_payment_trends(t: Tables) -> DataFrame:
    return marts.payment_trends(payment_trend_report(t), rejects=Observation())


def _hold_sql(facility: str) -> str:
    return f"""WITH {CHARGES_SQL}
SELECT c_mktsegment AS facility_name, l_returnflag AS claim_status,
  CAST(l_partkey % 50 + 90800 AS VARCHAR) AS level_of_care,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  r_name AS instance_key
FROM charges GROUP BY c_mktsegment, {facility} l_returnflag, l_partkey % 50, r_name"""


@query("mart_charges_on_hold", _hold_sql("n_name,"))
def mart_charges_on_hold(t: Tables) -> DataFrame:
    return marts.charges_on_hold(charges_on_hold_report(t, facility=True))


@query("mart_v_charges_on_hold", _hold_sql(""))
def mart_v_charges_on_hold(t: Tables) -> DataFrame:
    return marts.charges_on_hold(charges_on_hold_report(t, facility=False))


@query(
    "gross_billing_text_dates",
    f"""WITH {CHARGES_SQL}, {GROSS_BILLING_SQL}, d AS (
  SELECT charge_id, instance_key, charge_entered_date AS entered, claim_first_billed_date AS billed,
    CAST(charge_id AS BIGINT) % 4 AS kind FROM gross_billing)
SELECT CAST(charge_id AS VARCHAR) AS charge_id, CASE WHEN ok THEN 'Billed' ELSE 'Not Billed' END AS billed_or_not_billed,
  CASE WHEN ok THEN CAST(billed - entered AS INTEGER) END AS charge_lag
FROM (SELECT *, instance_key <> 'ASIA' AND kind <> 1 AND billed IS NOT NULL AS ok FROM d)""",
)
def gross_billing_text_dates(t: Tables) -> DataFrame:
    """Billed is what has a date that can be read: not blanks, not a year alone, not a tenant without any."""
    report = gross_billing_report(t)
    billed = F.date_format("claim_first_billed_date", "MM/dd/yyyy")
    unread = F.when(F.col("charge_claim_id") % 2 == 0, "2024").otherwise(" ")
    text = F.when(F.col("charge_id") % 4 == 1, unread).otherwise(billed)
    parts = [
        report.filter("instance_key <> 'ASIA'").withColumn("claim_first_billed_date", text),
        blank_null_columns(
            report.filter("instance_key = 'ASIA'").withColumn("claim_first_billed_date", F.lit(None).cast("string"))
        ),
    ]
    united = union_conform(parts)
    return marts.gross_billing(united, as_of=F.lit(AS_OF).cast("date")).select(
        "charge_id", "billed_or_not_billed", "charge_lag"
    )
