"""Report-shaped frames derived from the given tables, and the same in SQL.

The tables hold no billing data. Orders and line items stand in for claims
and charges, customers for accounts; faults a report may have (blank amounts,
missing dates, unknown codes) follow from the keys.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from revflow.operators.crosswalk import LEVELS_OF_CARE
from revflow.workload.registry import Tables

AS_OF = "2001-07-20"
CODES = [*LEVELS_OF_CARE, "999", "X0000"]


def dec(c: Column | str, kind: str = "decimal(15,2)") -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(kind)


def rate(text: str) -> Column:
    return F.lit(Decimal(text))


def money_text(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c.cast("decimal(18,2)"), 2))


def plain_money(c: Column) -> Column:
    return F.concat(F.lit("$"), c.cast("decimal(18,2)").cast("string"))


def us_date(c: Column | str) -> Column:
    return F.date_format(c, "MM/dd/yyyy")


def code_of(key: str) -> Column:
    index = (F.col(key) % len(CODES)).cast("int")
    return F.when(F.col(key) % 31 != 0, F.get(F.array(*[F.lit(c) for c in CODES]), index))


def accounts(t: Tables) -> DataFrame:
    """Customers with nation and region; the two small tables are broadcast by size."""
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "n_name", "r_name")
    )


def claims(t: Tables) -> DataFrame:
    return t.orders.join(accounts(t), F.col("o_custkey") == F.col("c_custkey"))


def charges(t: Tables) -> DataFrame:
    return t.lineitem.join(claims(t), F.col("l_orderkey") == F.col("o_orderkey"))


def gross_billing_report(t: Tables) -> DataFrame:
    """Charges with typed dates, as they are after type inference."""
    billed = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("date"))
    return charges(t).select(
        F.col("o_custkey").alias("customer_account"),
        F.col("r_name").alias("instance_key"),
        F.col("c_mktsegment").alias("practice_name"),
        F.col("n_name").alias("charge_primary_payer_name"),
        F.col("n_name").alias("charge_primary_payer_name_1"),
        F.col("o_custkey").alias("charge_patient_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("charge_id"),
        F.col("l_orderkey").alias("charge_claim_id"),
        F.concat("c_name", F.lit(" ("), F.col("c_custkey").cast("string"), F.lit(")")).alias(
            "patient_full_name"
        ),
        F.concat(F.lit("M"), F.col("o_custkey").cast("string")).alias("primary_payer_member_id"),
        F.col("l_shipdate").cast("date").alias("charge_from_date"),
        F.col("l_shipdate").cast("date").alias("charge_to_date"),
        F.col("o_orderdate").cast("date").alias("charge_entered_date"),
        (F.col("l_suppkey") % 900 + 100).alias("type_of_bill"),
        billed.alias("claim_first_billed_date"),
        (F.col("l_partkey") % 1000 + 90000).cast("string").alias("charge_cpt_code"),
        F.col("l_quantity").cast("int").alias("charge_units_sum"),
        money_text(dec("l_extendedprice")).alias("charge_amount"),
        code_of("l_partkey").alias("charge_rev_code"),
        F.col("n_name").alias("charge_current_payer_name"),
        F.col("l_returnflag").alias("claim_status"),
    )


def code_sql(key: str) -> str:
    codes = ", ".join(f"'{c}'" for c in CODES)
    index = f"CAST({key} % {len(CODES)} AS INTEGER) + 1"
    return f"CASE WHEN {key} % 31 <> 0 THEN list_extract([{codes}], {index}) END"


def money_text_sql(x: str) -> str:
    return f"'$' || format('{{:,.2f}}', CAST(CAST({x} AS DECIMAL(18,2)) AS DOUBLE))"


def plain_money_sql(x: str) -> str:
    return f"'$' || CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


def money_sql(text: str) -> str:
    return f"TRY_CAST(replace(replace({text}, '$', ''), ',', '') AS DECIMAL(18,2))"


def d152(x: str) -> str:
    return f"CAST({x} AS DECIMAL(15,2))"


LOC_SQL = "(VALUES {}) AS lc(rev_code, level_of_care)".format(
    ", ".join(f"('{code}', '{level}')" for code, level in LEVELS_OF_CARE.items())
)

CHARGES_SQL = """
acc AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
claims AS (SELECT * FROM orders JOIN acc ON o_custkey = c_custkey),
charges AS (SELECT * FROM lineitem JOIN claims ON l_orderkey = o_orderkey)"""

GROSS_BILLING_SQL = f"""
gross_billing AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_account, r_name AS instance_key,
    c_mktsegment AS practice_name, n_name AS charge_primary_payer_name,
    n_name AS charge_primary_payer_name_1,
    CAST(o_custkey AS VARCHAR) AS charge_patient_id,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS charge_id,
    CAST(l_orderkey AS VARCHAR) AS charge_claim_id,
    c_name || ' (' || c_custkey || ')' AS patient_full_name,
    'M' || o_custkey AS primary_payer_member_id,
    CAST(l_shipdate AS DATE) AS charge_from_date,
    CAST(l_shipdate AS DATE) AS charge_to_date,
    CAST(o_orderdate AS DATE) AS charge_entered_date,
    CAST(l_suppkey % 900 + 100 AS VARCHAR) AS type_of_bill,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS claim_first_billed_date,
    CAST(l_partkey % 1000 + 90000 AS VARCHAR) AS charge_cpt_code,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS charge_units_sum,
    {money_text_sql("l_extendedprice")} AS charge_amount,
    {code_sql("l_partkey")} AS charge_rev_code,
    n_name AS charge_current_payer_name, l_returnflag AS claim_status
  FROM charges)"""


def ar_aging_report(t: Tables) -> DataFrame:
    """Receivables, one per order, with text dates, amounts and counts."""
    total = dec("o_totalprice")
    key = F.col("o_orderkey")
    day = F.col("o_orderdate")
    billed = F.when(F.col("o_orderstatus") != "P", us_date(F.date_add(day.cast("date"), 3)))
    age = F.datediff(F.lit(AS_OF).cast("date"), day.cast("date")).cast("string")
    return claims(t).select(
        F.col("o_custkey").cast("string").alias("customer_account"),
        F.col("r_name").alias("instance_key"),
        key.alias("charge_id"),
        key.alias("claim_id"),
        billed.alias("claim_first_billed_date"),
        us_date(day).alias("charge_from_date"),
        us_date(day).alias("charge_to_date"),
        us_date(day).alias("charge_entered_date"),
        F.col("n_name").alias("charge_primary_payer_name"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("charge_primary_payer_id"),
        F.col("c_mktsegment").alias("practice_name"),
        F.concat("c_name", F.lit(" ("), F.col("c_custkey").cast("string"), F.lit(")")).alias(
            "patient_full_name"
        ),
        F.col("c_custkey").alias("patient_id"),
        (F.col("o_custkey") % 1000 + 90000).cast("string").alias("charge_cpt_code"),
        F.col("o_orderpriority").alias("charge_cpt_description"),
        code_of("o_orderkey").alias("revenue_code"),
        F.col("o_orderpriority").alias("charge_fromdate_age"),
        age.alias("charge_fromdate_age_days"),
        F.col("o_orderstatus").alias("charge_first_bill_date_age"),
        age.alias("charge_first_bill_date_age_days"),
        money_text(total).alias("charge_balance"),
        money_text(total * rate("0.6")).alias("charge_balance_due_ins"),
        F.when(key % 7 == 0, "").otherwise(money_text(total * rate("0.1"))).alias(
            "charge_balance_due_other"
        ),
        F.when(key % 11 == 0, F.concat(F.lit("$-"), total.cast("string")))
        .otherwise(money_text(total * rate("0.3")))
        .alias("charge_balance_due_pat"),
        F.lit("$0.00").alias("charge_balance_at_collections"),
        plain_money(total * rate("0.2")).alias("charge_insurance_payments"),
        plain_money(total * rate("0.4")).alias("charge_patient_payments"),
        plain_money(total * rate("0.5")).alias("charge_total_payments"),
        F.when(key % 13 != 0, (key % 5).cast("string")).alias("patient_stmts_sent_electronically"),
        F.when(key % 9 == 0, "1.5")
        .otherwise((F.col("o_custkey") % 4).cast("string"))
        .alias("patient_statements_printed"),
    )


def _share(r: str, sql=money_text_sql) -> str:
    return sql(f"{d152('o_totalprice')} * CAST({r} AS DECIMAL(2,1))")


AR_AGING_SQL = f"""
ar_aging AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_account, r_name AS instance_key,
    o_orderkey AS charge_id, o_orderkey AS claim_id,
    CASE WHEN o_orderstatus <> 'P'
      THEN strftime(CAST(o_orderdate AS DATE) + 3, '%m/%d/%Y') END AS claim_first_billed_date,
    strftime(o_orderdate, '%m/%d/%Y') AS charge_from_date,
    strftime(o_orderdate, '%m/%d/%Y') AS charge_to_date,
    strftime(o_orderdate, '%m/%d/%Y') AS charge_entered_date,
    n_name AS charge_primary_payer_name, 'P' || c_nationkey AS charge_primary_payer_id,
    c_mktsegment AS practice_name, c_name || ' (' || c_custkey || ')' AS patient_full_name,
    c_custkey AS patient_id, CAST(o_custkey % 1000 + 90000 AS VARCHAR) AS charge_cpt_code,
    o_orderpriority AS charge_cpt_description, {code_sql("o_orderkey")} AS revenue_code,
    o_orderpriority AS charge_fromdate_age,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS VARCHAR)
      AS charge_fromdate_age_days,
    o_orderstatus AS charge_first_bill_date_age,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS VARCHAR)
      AS charge_first_bill_date_age_days,
    {money_text_sql("o_totalprice")} AS charge_balance,
    {_share("0.6")} AS charge_balance_due_ins,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE {_share("0.1")} END AS charge_balance_due_other,
    CASE WHEN o_orderkey % 11 = 0 THEN '$-' || {d152("o_totalprice")} ELSE {_share("0.3")} END
      AS charge_balance_due_pat,
    '$0.00' AS charge_balance_at_collections,
    {_share("0.2", plain_money_sql)} AS charge_insurance_payments,
    {_share("0.4", plain_money_sql)} AS charge_patient_payments,
    {_share("0.5", plain_money_sql)} AS charge_total_payments,
    CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 5 AS VARCHAR) END
      AS patient_stmts_sent_electronically,
    CASE WHEN o_orderkey % 9 = 0 THEN '1.5' ELSE CAST(o_custkey % 4 AS VARCHAR) END
      AS patient_statements_printed
  FROM claims)"""


def payers(t: Tables) -> DataFrame:
    """Payer codes of 20 of the 25 nations, one name listed twice."""
    code = F.concat(F.lit("PC"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    codes = F.when(F.col("n_nationkey") == 3, F.array(code, F.lit("PC900"))).when(
        F.col("n_nationkey") < 20, F.array(code)
    )
    return t.nation.select(
        F.col("n_name").alias("payer_name"), F.explode(codes).alias("payer_code")
    )


PAYERS_SQL = """
payer_name_crosswalk AS (
  SELECT n_name AS payer_name, 'PC' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS payer_code
  FROM nation WHERE n_nationkey < 20
  UNION ALL SELECT n_name, 'PC900' FROM nation WHERE n_nationkey = 3)"""


def payment_trend_report(t: Tables) -> DataFrame:
    """Payments, one per line item, with text dates, some without leading zeros."""
    price, line = dec("l_extendedprice"), F.col("l_linenumber")
    discount, tax = dec("l_discount", "decimal(4,2)"), dec("l_tax", "decimal(4,2)")
    quantity = dec("l_quantity")
    shipped = F.col("l_shipdate").cast("date")
    allowed = (
        F.when(line == 3, "").when(line == 1, "$0.00").otherwise(money_text(price - quantity))
    )
    return charges(t).select(
        F.col("o_custkey").cast("string").alias("customer_account"),
        F.col("r_name").alias("instance_key"),
        F.col("c_mktsegment").alias("practice_name"),
        F.col("n_name").alias("office_name"),
        F.col("n_name").alias("facility_name"),
        F.col("o_orderdate").cast("date").alias("charge_entered_date"),
        F.col("o_orderdate").cast("date").alias("charge_first_bill_date"),
        us_date("l_shipdate").alias("charge_from_date"),
        us_date("l_shipdate").alias("charge_to_date"),
        F.col("c_name").alias("patient_full_name"),
        F.col("l_returnflag").alias("payment_source"),
        allowed.alias("payment_allowed_amount"),
        F.col("o_custkey").alias("charge_patient_id"),
        (F.col("l_orderkey") * 10 + line).alias("charge_id"),
        F.col("l_orderkey").alias("claim_id"),
        code_of("l_partkey").alias("charge_rev_code"),
        F.col("l_partkey").alias("charge_cpt_code"),
        F.lit("111").alias("type_of_bill"),
        F.col("n_name").alias("charge_primary_payer_name"),
        F.col("c_name").alias("primary_payer_member_id"),
        F.col("l_extendedprice").alias("charge_amount"),
        F.when(F.col("l_partkey") % 17 != 0, money_text(price * tax)).alias(
            "insurance_paid_amount"
        ),
        money_text(price * discount).alias("payment_total_paid"),
        money_text(quantity).alias("payment_total_applied"),
        F.col("l_tax").alias("charge_insurance_adjustments"),
        F.col("l_discount").alias("charge_patient_adjustments"),
        F.col("l_quantity").alias("charge_total_adjustments"),
        F.when(line != 2, us_date(F.date_add(shipped, line))).alias("payment_received"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("payment_entered"),
        F.col("l_tax").alias("insurance_applied_amount"),
        money_text(quantity * rate("0.5")).alias("patient_applied_amount"),
        money_text(price - quantity * rate("2.0")).alias("payment_unapplied_amount"),
    )


_TAX = "CAST(l_tax AS DECIMAL(4,2))"
_DISCOUNT = "CAST(l_discount AS DECIMAL(4,2))"
_PRICE, _QUANTITY = d152("l_extendedprice"), d152("l_quantity")

PAYMENT_TREND_SQL = f"""
payment_trend AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_account, r_name AS instance_key,
    c_mktsegment AS practice_name,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS charge_entered_date,
    strftime(l_shipdate, '%m/%d/%Y') AS charge_from_date,
    strftime(l_shipdate, '%m/%d/%Y') AS charge_to_date, c_name AS patient_full_name,
    CASE WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 1 THEN '$0.00'
      ELSE {money_text_sql(f"{_PRICE} - {_QUANTITY}")} END AS payment_allowed_amount,
    o_custkey AS charge_patient_id, l_orderkey * 10 + l_linenumber AS charge_id,
    l_orderkey AS claim_id, {code_sql("l_partkey")} AS charge_rev_code,
    l_partkey AS charge_cpt_code, '111' AS type_of_bill,
    n_name AS charge_primary_payer_name, c_name AS primary_payer_member_id,
    l_extendedprice AS charge_amount,
    CASE WHEN l_partkey % 17 <> 0 THEN {money_text_sql(f"{_PRICE} * {_TAX}")} END
      AS insurance_paid_amount,
    {money_text_sql(f"{_PRICE} * {_DISCOUNT}")} AS payment_total_paid,
    {money_text_sql(_QUANTITY)} AS payment_total_applied,
    l_tax AS charge_insurance_adjustments, l_discount AS charge_patient_adjustments,
    l_quantity AS charge_total_adjustments,
    CASE WHEN l_linenumber <> 2
      THEN strftime(CAST(l_shipdate AS DATE) + l_linenumber, '%m/%d/%Y') END AS payment_received,
    strftime(o_orderdate, '%-m/%-d/%Y') AS payment_entered,
    l_tax AS insurance_applied_amount,
    {money_text_sql(f"{_QUANTITY} * CAST(0.5 AS DECIMAL(2,1))")} AS patient_applied_amount,
    {money_text_sql(f"{_PRICE} - {_QUANTITY} * CAST(2.0 AS DECIMAL(2,1))")}
      AS payment_unapplied_amount,
    CAST(l_shipdate AS DATE) AS from_day,
    CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE) + l_linenumber END AS received_day,
    CAST(o_orderdate AS DATE) AS entered_day
  FROM charges)"""


def charges_on_hold_report(t: Tables, facility: bool) -> DataFrame:
    hidden = [F.col("n_name").alias("facility_name")] if facility else []
    return charges(t).select(
        F.col("c_mktsegment").alias("practice_name"),
        *hidden,
        F.col("l_returnflag").alias("claim_status"),
        (F.col("l_partkey") % 50 + 90800).cast("string").alias("charge_cpt_code"),
        money_text(dec("l_extendedprice")).alias("charge_amount"),
        F.col("r_name").alias("instance_key"),
    )
