"""The analytic marts over report tables.

Each mart is a projection over one scan plus at most one lookup, so it needs
no shuffle of its own apart from the held-charge totals. Amounts and dates
are derived once, in an inner projection, and the labels built on them after
that. Amounts that cannot be read become NULL; an ``Observation`` passed as
``rejects`` counts them per column while the rows pass, without a second scan.
It also parts the generated code between the two projections, which for such
wide rows would otherwise outgrow what the JVM compiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from revflow.functions import (
    charge_lag,
    date_value,
    days_on_hold,
    hold_age_bucket,
    iso_week_label,
    money,
    month_name,
    month_year_label,
    number,
    posting_turnaround,
    statement_bucket,
    strip_trailing_id,
    week_start,
    weekday_name,
    year_text,
)
from revflow.operators.crosswalk import level_of_care_join, payer_code_join

# Output columns of the marts, in order.
AR_AGING_COLUMNS = (
    "customer_account", "charge_id", "claim_id", "claim_first_billed_date",
    "charge_from_date", "charge_to_date", "charge_entered_date",
    "charge_primary_payer_name", "charge_primary_payer_id", "practice_name",
    "office_name", "charge_current_payer_name", "facility_name",
    "claim_patient_id", "charge_cpt_code", "charge_cpt_description",
    "revenue_code", "patient_full_name", "charge_fromdate_age",
    "charge_fromdate_age_days", "charge_first_bill_date_age",
    "charge_first_bill_date_age_days", "charge_balance",
    "charge_balance_due_ins", "charge_balance_due_other",
    "charge_balance_due_pat", "charge_balance_at_collections",
    "charge_insurance_payments", "charge_patient_payments",
    "charge_total_payments", "patient_stmts_sent_electronically",
    "patient_statements_printed", "int_charge_balance_due_ins",
    "int_charge_balance_due_other", "int_patient_stmts_sent_electronically",
    "int_patient_statements_printed", "int_charge_balance_due_pat",
    "balance_due_payer", "total_statements", "total_statement_buckets",
    "payer_code",
)

GROSS_BILLING_COLUMNS = (
    "customer_account", "office_name", "facility_name", "practice_name",
    "charge_primary_payer_name", "charge_patient_id", "charge_id",
    "charge_claim_id", "patient_full_name", "primary_payer_member_id",
    "charge_from_date", "charge_to_date", "charge_entered_date",
    "type_of_bill", "claim_first_billed_date", "charge_cpt_code",
    "charge_units_sum", "charge_amount", "charge_rev_code",
    "charge_primary_payer_name_dup", "charge_current_payer_name",
    "claim_status", "date_charge_entered_date", "days_on_hold", "charge_lag",
    "billed_or_not_billed", "claim_first_billed_day",
    "claim_first_billed_week", "claim_first_billed_month",
    "claim_first_billed_year", "loc", "int_charge_amount",
    "first_billed_week_date", "days_on_hold_range", "claim_first_billed_ym",
    "instance_key",
)

PAYMENT_TRENDS_COLUMNS = (
    "customer_account", "facility_name", "office_name", "practice_name",
    "charge_entered_date", "charge_from_date", "charge_to_date",
    "patient_full_name", "payment_source", "payment_allowed_amount",
    "charge_patient_id", "charge_id", "charge_rev_code", "charge_cpt_code",
    "type_of_bill", "charge_claim_id", "payer_name",
    "primary_payer_member_id", "charge_amount", "insurance_paid_amount",
    "payment_total_paid", "payment_total_applied",
    "charge_insurance_adjustments", "charge_patient_adjustments",
    "charge_total_adjustments", "payment_received", "payment_entered",
    "insurance_applied_amount", "patient_applied_amount",
    "payment_applied_amount", "payment_unapplied_amount", "charge_from_day",
    "charge_from_week", "charge_from_month", "charge_from_year",
    "payment_status", "int_payment_allowed_amount", "level_of_care",
    "has_insurance_payment", "int_insurance_paid_amount",
    "payment_received_day", "payment_received_week",
    "payment_received_month", "payment_received_year", "payment_posting_tat",
    "int_payment_applied_amount", "int_payment_total_applied",
    "int_payment_total_paid", "int_payment_unapplied_amount", "instance_key",
)


def _labels(prefix: str, d: Column, capital_day: bool) -> dict[str, Column]:
    return {
        f"{prefix}_day": weekday_name(d, capital=capital_day),
        f"{prefix}_week": iso_week_label(d),
        f"{prefix}_month": month_name(d),
        f"{prefix}_year": year_text(d),
    }


def _observed(df: DataFrame, amounts: dict[str, str], rejects: Observation | None) -> DataFrame:
    """Count present values without a parsed amount; ``amounts`` maps parsed to raw columns."""
    if rejects is None:
        return df
    counts = [
        F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNull()).alias(raw)
        for parsed, raw in amounts.items()
    ]
    return df.observe(rejects, *counts)


def ar_aging(
    report: DataFrame,
    payers: DataFrame,
    strict: bool = False,
    rejects: Observation | None = None,
) -> DataFrame:
    """Receivables with parsed balances, statement range and payer code.

    ``payers`` holds (payer_name, payer_code).
    """
    practice, payer = F.col("practice_name"), F.col("charge_primary_payer_name")
    electronic, printed = "patient_stmts_sent_electronically", "patient_statements_printed"
    balances = ("charge_balance_due_ins", "charge_balance_due_other", "charge_balance_due_pat")
    counts = (electronic, printed)
    parsed = report.withColumns(
        {
            **{f"int_{c}": money(F.col(c), strict) for c in balances},
            **{f"int_{c}": number(F.col(c), strict) for c in counts},
        }
    )
    base = _observed(parsed, {f"int_{c}": c for c in (*balances, *counts)}, rejects)
    totals = base.withColumns(
        {
            "office_name": practice,
            "facility_name": practice,
            "charge_current_payer_name": payer,
            "patient_full_name": strip_trailing_id(F.col("patient_full_name")),
            "claim_patient_id": F.col("patient_id"),
            "balance_due_payer": F.col("int_charge_balance_due_ins")
            + F.col("int_charge_balance_due_other"),
            "total_statements": F.col(f"int_{printed}") + F.col(f"int_{electronic}"),
        }
    ).withColumn("total_statement_buckets", statement_bucket(F.col("total_statements")))
    return payer_code_join(totals, payers, "charge_primary_payer_name").select(*AR_AGING_COLUMNS)


def gross_billing(
    report: DataFrame,
    crosswalk: DataFrame | None = None,
    as_of: Column | None = None,
    strict: bool = False,
    rejects: Observation | None = None,
) -> DataFrame:
    """Charges with age on hold, billing lag, billing calendar and level of care.

    ``as_of`` is the day ages are counted to; today if it is not given.
    """
    practice, billed = F.col("practice_name"), F.col("_billed")
    dated = level_of_care_join(report, "charge_rev_code", "loc", crosswalk).withColumns(
        {
            "date_charge_entered_date": date_value(report, "charge_entered_date", strict),
            "_billed": date_value(report, "claim_first_billed_date", strict),
            "int_charge_amount": money(F.col("charge_amount"), strict),
        }
    )
    dated = _observed(dated, {"int_charge_amount": "charge_amount"}, rejects)
    entered = F.col("date_charge_entered_date")
    ids = ("customer_account", "charge_patient_id", "charge_id", "charge_claim_id",
           "type_of_bill", "charge_units_sum")
    out = dated.withColumns(
        {
            **{c: F.col(c).cast("string") for c in ids},
            "office_name": practice,
            "facility_name": practice,
            "charge_primary_payer_name_dup": F.col("charge_primary_payer_name_1"),
            "days_on_hold": days_on_hold(entered, as_of),
            "charge_lag": charge_lag(billed, entered),
            "billed_or_not_billed": F.when(billed.isNotNull(), "Billed").otherwise("Not Billed"),
            **_labels("claim_first_billed", billed, capital_day=False),
            "first_billed_week_date": week_start(billed),
        }
    ).withColumns(
        {
            "days_on_hold_range": hold_age_bucket(F.col("days_on_hold")),
            "claim_first_billed_ym": month_year_label(
                F.col("claim_first_billed_month"), F.col("claim_first_billed_year")
            ),
        }
    )
    return out.select(*GROSS_BILLING_COLUMNS)


def payment_trends(
    report: DataFrame,
    crosswalk: DataFrame | None = None,
    strict: bool = False,
    rejects: Observation | None = None,
) -> DataFrame:
    """Payments with calendar labels, posting time, parsed amounts, level of care.

    The source is always ``Patient``. ``int_payment_applied_amount`` is the
    patient's applied amount, ``payment_applied_amount`` the total applied.
    """
    practice = F.col("practice_name")
    amounts = {
        "int_payment_allowed_amount": "payment_allowed_amount",
        "int_insurance_paid_amount": "insurance_paid_amount",
        "int_payment_applied_amount": "patient_applied_amount",
        "int_payment_total_applied": "payment_total_applied",
        "int_payment_total_paid": "payment_total_paid",
        "int_payment_unapplied_amount": "payment_unapplied_amount",
    }
    parsed = level_of_care_join(
        report, "charge_rev_code", "level_of_care", crosswalk
    ).withColumns(
        {
            **{out: money(F.col(source), strict) for out, source in amounts.items()},
            "_from": date_value(report, "charge_from_date", strict),
            "_received": date_value(report, "payment_received", strict),
            "_entered": date_value(report, "payment_entered", strict),
        }
    )
    parsed = _observed(parsed, amounts, rejects)
    out = parsed.withColumns(
        {
            "facility_name": practice,
            "office_name": practice,
            "payment_source": F.lit("Patient"),
            "charge_claim_id": F.col("claim_id"),
            "payer_name": F.col("charge_primary_payer_name"),
            "payment_applied_amount": F.col("payment_total_applied"),
            **_labels("charge_from", F.col("_from"), capital_day=True),
            **_labels("payment_received", F.col("_received"), capital_day=True),
            "payment_status": F.when(
                F.col("int_payment_allowed_amount") > 0, "Paid"
            ).otherwise("Not Paid"),
            "has_insurance_payment": F.coalesce(
                F.col("int_insurance_paid_amount") > 0, F.lit(False)
            ),
            "payment_posting_tat": posting_turnaround(F.col("_received"), F.col("_entered")),
        }
    )
    return out.select(*PAYMENT_TRENDS_COLUMNS)


def charges_on_hold(report: DataFrame, strict: bool = False) -> DataFrame:
    """Amounts on hold per practice, status, procedure code and instance.

    Where the report has a facility of its own, totals are kept apart by it,
    though the practice is shown in its place; visible keys may then repeat.
    ``level_of_care`` is the procedure code.
    """
    hidden = ["facility_name"] if "facility_name" in report.columns else []
    return (
        report.groupBy(
            "practice_name", *hidden, "claim_status", "charge_cpt_code", "instance_key"
        )
        .agg(F.sum(money(F.col("charge_amount"), strict)).alias("total_amount"))
        .select(
            F.col("practice_name").alias("facility_name"),
            "claim_status",
            F.col("charge_cpt_code").alias("level_of_care"),
            "total_amount",
            "instance_key",
        )
    )
