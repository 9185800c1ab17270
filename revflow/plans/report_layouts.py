"""Text layouts of the headerless report files, with their declared lengths."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and lengths of each file, in order; no length
# after the colon means unlimited text.
_AR_AGING = """
customer_account:20 charge_id:20 claim_id:20 claim_first_billed_date:20
charge_from_date:20 charge_to_date:20 charge_entered_date:20
charge_primary_payer_name: charge_primary_payer_id:50 practice_name:
office_name: charge_current_payer_name: facility_name: claim_patient_id:50
charge_cpt_code:20 charge_cpt_description:100 revenue_code:20
patient_full_name: charge_fromdate_age: charge_fromdate_age_days:255
charge_first_bill_date_age:100 charge_first_bill_date_age_days:255
charge_balance:50 charge_balance_due_ins:255 charge_balance_due_other:50
charge_balance_due_pat:50 charge_balance_at_collections:50
charge_insurance_payments:50 charge_patient_payments:50
charge_total_payments:50 patient_stmts_sent_electronically:50
patient_statements_printed:50
"""
_CHARGES_ON_HOLD = """
customer_account:20 practice_name_id:100 practice_name:100 facility_name:100
office_name:100 charge_primary_payer_name:100 charge_patient_id:50
charge_id:50 charge_claim_id:50 charge_debit_id:50 charge_claim_id_dup:50
charge_patient_id_dup:50 patient_full_name:100 charge_entered_date:20
charge_entered_age:50 charge_cpt_code:50 charge_rev_code:50 type_of_bill:50
charge_entered_age_days:10 charge_from_date:20 times_billed:10
charge_to_date:20 charge_amount:50 payer_type:50 claim_status:50
claim_set_to_status:50
"""
_CLAIM_STAGE_BREAKDOWN = """
customer_account:20 practice_name:100 claim_id:50 charge_id:50 patient_id:50
patient_full_name:100 charge_from_date:20 charge_to_date:20
charge_entered_date:20 type_of_bill:50 charge_cpt_code:50 charge_rev_code:50
charge_amount:50 charge_primary_payer_name:100 charge_current_payer_name:100
claim_status: charge_balance:50 charge_balance_due_ins:50
charge_balance_due_other:50 charge_balance_due_pat:50
charge_balance_at_collections:50
"""
_DENIAL_TRENDS = """
customer_account:20 facility_name:100 practice_name:100
charge_entered_date:20 office_name:100 charge_from_date:20 charge_to_date:20
charge_first_bill_date:20 patient_id:50 patient_full_name:100 charge_id:50
charge_rev_code:50 charge_cpt_code:50 remark_codes: unpaid_reason_codes:
charge_primary_payment_date:20 payment_received:20 payment_entered:20
charge_primary_payer_name:100 payer_name:100 charge_amount:50
insurance_paid_amount:50
"""
_GROSS_BILLING = """
customer_account:20 office_name:100 facility_name:100 practice_name:100
charge_primary_payer_name:100 charge_patient_id:50 charge_id:50
charge_claim_id:50 patient_full_name:100 primary_payer_member_id:50
charge_from_date:20 charge_to_date:20 charge_entered_date:20 type_of_bill:50
claim_first_billed_date:20 charge_cpt_code:50 charge_units_sum:10
charge_amount:50 charge_rev_code:50 charge_primary_payer_name_dup:100
charge_current_payer_name:100 claim_status:
"""
_PAYMENT_TREND = """
customer_account:20 facility_name:100 office_name:100 practice_name:100
charge_entered_date:20 charge_from_date:20 charge_to_date:20
patient_full_name:100 payment_source:50 payment_allowed_amount:50
charge_patient_id:50 charge_id:50 charge_rev_code:20 charge_cpt_code:20
type_of_bill:50 charge_claim_id:50 payer_name:100 primary_payer_member_id:50
charge_amount:50 insurance_paid_amount:50 payment_total_paid:50
payment_total_applied:50 charge_insurance_adjustments:50
charge_patient_adjustments:50 charge_total_adjustments:50
payment_received:20 payment_entered:20 insurance_applied_amount:50
patient_applied_amount:50 payment_applied_amount:50
payment_unapplied_amount:50
"""
_ADDRESSES = """
primary_ins_zip:50 primary_ins_city:100 primary_ins_state:50
primary_ins_addr_1:200 patient_zip:50 patient_city:100 patient_state:50
patient_address_1:200
"""
_RCM_PRODUCTIVITY = """
customer_account:20 created_by_user:100 note_count_cntunq:50 claim_id:50
last_note_date_max:20 claim_from_date:20 claim_last_billed_date:20
claim_status:100
"""


def _schema(layout: str) -> T.StructType:
    fields = []
    for cell in layout.split():
        name, _, length = cell.partition(":")
        fields.append(
            T.StructField(name, T.StringType(), True, {"max_length": int(length)} if length else {})
        )
    return T.StructType(fields)


REPORT_LAYOUTS = {
    "ar_aging": _schema(_AR_AGING),
    "charges_on_hold": _schema(_CHARGES_ON_HOLD),
    "claim_stage_breakdown": _schema(_CLAIM_STAGE_BREAKDOWN),
    "denial_trends": _schema(_DENIAL_TRENDS),
    "gross_billing": _schema(_GROSS_BILLING),
    "payment_trend": _schema(_PAYMENT_TREND),
    "quadrant_performance": _schema(_PAYMENT_TREND + _ADDRESSES),
    "rcm_productivity": _schema(_RCM_PRODUCTIVITY),
}
REPORT_KEYS = {"ar_aging": ["charge_id"]}
