"""Clean-up, conforming, unions, type inference and schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revflow.operators.infer import infer_structure, promote
from revflow.operators.quality import schema_check
from revflow.operators.shape import (
    blank_null_columns,
    conform_report,
    tenant_columns,
    trim_blank_null,
    union_accounts,
    union_conform,
)
from revflow.workload.carrier import accounts, d152, dec, money_text, money_text_sql
from revflow.workload.registry import Tables, query


@query(
    "trim_blank_null",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN NULL WHEN 2 THEN NULL
    ELSE o_orderpriority END AS note, CAST(o_custkey AS VARCHAR) AS account FROM orders""",
)
def trim(t: Tables) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    note = (
        F.when(kind == 0, F.concat(F.lit(" \t"), "o_orderpriority", F.lit("  \n")))
        .when(kind == 1, " \t ")
        .when(kind == 2, "")
        .otherwise(F.col("o_orderpriority"))
    )
    padded = F.lpad(F.col("o_custkey").cast("string"), 12, " ")
    return trim_blank_null(
        t.orders.select("o_orderkey", note.alias("note"), padded.alias("account"))
    )


@query(
    "tenant_columns",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_account, r_name AS instance_key,
  c_name AS patient, n_name AS payer FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def tenant(t: Tables) -> DataFrame:
    df = accounts(t).select(
        F.col("c_name").alias("patient"),
        F.col("r_name").alias("instance_key"),
        F.col("n_name").alias("payer"),
        F.col("c_custkey").alias("customer_account"),
    )
    return tenant_columns(df, df["customer_account"].cast("string"), df["instance_key"])


@query(
    "blank_null_columns",
    """SELECT o_orderkey, '' AS never, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END
  AS sometimes FROM orders""",
)
def blank_columns(t: Tables) -> DataFrame:
    return blank_null_columns(
        t.orders.select(
            "o_orderkey",
            F.when(F.col("o_orderkey") < 0, 1.5).alias("never"),
            F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("sometimes"),
        )
    )


@query(
    "conform_report",
    """SELECT CAST(o_custkey AS VARCHAR) AS customer_account, 'A' AS instance_key,
  o_orderpriority AS "Practice Name", CAST(o_orderkey AS VARCHAR) AS "Charge ID",
  'ins' AS "Patient Ins Credits", '' AS "Patient Credits",
  CAST(o_totalprice AS VARCHAR) AS "Patient Total Credits",
  CAST(o_totalprice AS VARCHAR) AS "Patient Total Credits_1", o_orderstatus AS "Left Over"
FROM (SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice) FROM orders)""",
)
def conform(t: Tables) -> DataFrame:
    """One column added, one listed twice, a left-over at the end."""
    df = t.orders.select(
        F.col("o_orderstatus").alias("Left Over"),
        F.lit("ins").alias("Patient Ins Credits"),
        dec("o_totalprice").cast("string").alias("Patient Total Credits"),
        F.col("o_orderkey").cast("string").alias("Charge ID"),
        F.lit("A").alias("instance_key"),
        F.col("o_orderpriority").alias("Practice Name"),
        F.col("o_custkey").cast("string").alias("customer_account"),
    )
    return conform_report(df, "write_off_trend")


@query(
    "conform_payment_trend",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_account, 'A' AS instance_key, c_mktsegment AS "Practice Name",
  CAST(o_orderkey AS VARCHAR) AS "Claim ID", 'total' AS "Payment Total Applied", o_orderstatus AS "Payment Received",
  o_orderpriority AS "Left Over"
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def conform_payment_trend(t: Tables) -> DataFrame:
    """The patient's applied amount under its old name goes; what the layout does not list stays behind."""
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderpriority").alias("Left Over"),
        F.lit("patient").alias("Payment Applied Amount"),
        F.lit("total").alias("Payment Total Applied"),
        F.col("o_orderstatus").alias("Payment Received"),
        F.col("o_orderkey").cast("string").alias("Claim ID"),
        F.col("c_mktsegment").alias("Practice Name"),
        F.lit("A").alias("instance_key"),
        F.col("c_custkey").cast("string").alias("customer_account"),
    )
    return conform_report(df, "payment_trend")


@query(
    "conform_user_time_spread",
    """SELECT CAST(user_id AS VARCHAR) AS customer_account, 'A' AS instance_key,
  'U' || user_id AS "Audit Username", event_type AS "Audit Action",
  CAST(CAST(ts AS DATE) AS VARCHAR) AS "Audit Entered Date" FROM events""",
)
def conform_dropping(t: Tables) -> DataFrame:
    df = t.events.select(
        F.col("event_id").alias("Audit ID"),
        F.col("props").alias("Facility Name"),
        F.col("event_type").alias("Audit Action"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("Audit Username"),
        F.col("ts").cast("date").cast("string").alias("Audit Entered Date"),
        F.lit("A").alias("instance_key"),
        F.col("user_id").cast("string").alias("customer_account"),
    )
    return conform_report(df, "user_time_spread")


# ---- inference ----------------------------------------------------------

_DAY = "strftime(o_orderdate, '%-m/%-d/%Y')"
_TEXT_SQL = f"""(SELECT CAST(o_orderkey AS VARCHAR) AS claim_id,
    CAST({d152("o_totalprice")} AS VARCHAR) AS total,
    CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS account,
    {_DAY} AS entered,
    CASE WHEN o_orderkey % 97 = 0 THEN '2/30/2024' ELSE {_DAY} END AS bad_date,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE {_DAY} END AS billed_date,
    lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') AS rev_code,
    lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') AS pinned_code,
    CASE WHEN o_orderkey % 7 = 0 THEN '12' ELSE '1.5e3' END AS mixed,
    CASE WHEN o_orderkey % 101 = 0 THEN '1f' ELSE '1' END AS almost,
    CAST(o_orderkey AS VARCHAR) AS update_count,
    CASE WHEN o_orderkey % 103 = 0 THEN 'inf' ELSE '2.5' END AS ratio,
    {money_text_sql("o_totalprice")} AS amount, CAST(NULL AS VARCHAR) AS nothing,
    o_orderpriority AS priority FROM orders)"""

_INFER_SQL = f"""WITH t AS {_TEXT_SQL} SELECT CAST(list_position(['claim_id', 'total', 'account', 'entered', 'bad_date',
    'billed_date', 'rev_code', 'pinned_code', 'mixed', 'almost', 'update_count', 'ratio', 'amount',
    'nothing', 'priority'], column_name) - 1 AS INTEGER) AS position, column_name,
  CASE WHEN count(nullif(v, '')) = 0 OR column_name = 'pinned_code' THEN 'text'
    WHEN bool_and(coalesce(v, '') = '' OR regexp_full_match(v, '[+-]?\\d+')) THEN 'bigint'
    WHEN bool_and(coalesce(v, '') = '' OR
      regexp_full_match(v, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')) THEN 'double precision'
    WHEN bool_and(coalesce(v, '') = '' OR (regexp_full_match(v, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}')
      AND try_strptime(v, '%m/%d/%Y') IS NOT NULL)) THEN 'date'
    ELSE 'text' END AS data_type, count(nullif(v, '')) = 0 AS all_missing
FROM t UNPIVOT INCLUDE NULLS (v FOR column_name IN (COLUMNS(*)))
GROUP BY column_name"""


def _text_orders(t: Tables) -> DataFrame:
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "M/d/yyyy")
    code = F.lpad((key % 1000).cast("string"), 4, "0")
    return t.orders.select(
        key.cast("string").alias("claim_id"),
        dec("o_totalprice").cast("string").alias("total"),
        F.when(key % 2 == 0, F.col("o_custkey").cast("string")).otherwise("").alias("account"),
        day.alias("entered"),
        F.when(key % 97 == 0, "2/30/2024").otherwise(day).alias("bad_date"),
        F.when(key % 3 == 0, "").otherwise(day).alias("billed_date"),
        code.alias("rev_code"),
        code.alias("pinned_code"),
        F.when(key % 7 == 0, "12").otherwise("1.5e3").alias("mixed"),
        F.when(key % 101 == 0, "1f").otherwise("1").alias("almost"),
        key.cast("string").alias("update_count"),
        F.when(key % 103 == 0, "inf").otherwise("2.5").alias("ratio"),
        money_text(dec("o_totalprice")).alias("amount"),
        F.lit(None).cast("string").alias("nothing"),
        F.col("o_orderpriority").alias("priority"),
    )


@query("infer_schema", _INFER_SQL)
def infer(t: Tables) -> DataFrame:
    """Types of fifteen text columns in one pass over all rows."""
    return infer_structure(_text_orders(t), pinned=["pinned_code"])


@query(
    "promote_types",
    f"""SELECT CAST(claim_id AS BIGINT) AS claim_id, CAST(total AS DOUBLE) AS total,
  CAST(nullif(account, '') AS BIGINT) AS account,
  CAST(CAST(strptime(entered, '%m/%d/%Y') AS DATE) AS VARCHAR) AS entered, bad_date,
  CAST(CAST(strptime(nullif(billed_date, ''), '%m/%d/%Y') AS DATE) AS VARCHAR) AS billed_date,
  CAST(rev_code AS BIGINT) AS rev_code, pinned_code, CAST(mixed AS DOUBLE) AS mixed, almost,
  CAST(update_count AS BIGINT) AS update_count, ratio, amount, nothing, priority
FROM {_TEXT_SQL}""",
)
def promoted(t: Tables) -> DataFrame:
    """The same columns typed as inferred."""
    return promote(_text_orders(t), pinned=["pinned_code"])


@query(
    "schema_strict_check",
    f"""WITH found AS (SELECT row_number() OVER (ORDER BY position) - 1 AS p, column_name AS name, data_type AS kind
  FROM ({_INFER_SQL}) WHERE column_name IN ('claim_id', 'total', 'billed_date')),
wanted AS (SELECT * FROM (VALUES ('same', 0, 'claim_id', 'bigint'), ('same', 1, 'total', 'double precision'),
  ('same', 2, 'billed_date', 'date'), ('swapped', 0, 'total', 'double precision'), ('swapped', 1, 'claim_id', 'bigint'),
  ('swapped', 2, 'billed_date', 'date'), ('retyped', 0, 'claim_id', 'bigint'), ('retyped', 1, 'total', 'double precision'),
  ('retyped', 2, 'billed_date', 'text'), ('longer', 0, 'claim_id', 'bigint'), ('longer', 1, 'total', 'double precision'),
  ('longer', 2, 'billed_date', 'date'), ('longer', 3, 'status', 'text'), ('other', 0, 'claim_id', 'bigint'),
  ('other', 1, 'total', 'double precision'), ('other', 2, 'gone', 'date')) AS w(t, p, name, kind))
SELECT t AS table_name, 'column_count' AS kind, NULL AS position, NULL AS column_name,
  CAST(count(*) AS VARCHAR) AS expected, CAST((SELECT count(*) FROM found) AS VARCHAR) AS actual
FROM wanted GROUP BY t HAVING count(*) <> (SELECT count(*) FROM found)
UNION ALL SELECT t, 'missing_column', NULL, name, kind, NULL FROM wanted WHERE name NOT IN (SELECT name FROM found)
UNION ALL SELECT t, 'extra_column', NULL, f.name, NULL, f.kind FROM (SELECT DISTINCT t FROM wanted), found f
  WHERE (t, f.name) NOT IN (SELECT (t, name) FROM wanted)
UNION ALL SELECT t, CASE WHEN w.name <> f.name THEN 'name_mismatch' ELSE 'type_mismatch' END, CAST(p AS INTEGER), w.name,
  CASE WHEN w.name <> f.name THEN w.name || ' ' || w.kind ELSE w.kind END,
  CASE WHEN w.name <> f.name THEN f.name || ' ' || f.kind ELSE f.kind END
FROM wanted w JOIN found f USING (p) WHERE (w.name, w.kind) <> (f.name, f.kind)""",
)
def strict_check(t: Tables) -> DataFrame:
    """Types found in whole text columns against stored layouts that differ from them."""
    df = _text_orders(t).select("claim_id", "total", "billed_date")
    found = [(r.column_name, r.data_type) for r in infer_structure(df).orderBy("position").collect()]
    claim, total = ("claim_id", "bigint"), ("total", "double precision")
    targets = {
        "same": [claim, total, ("billed_date", "date")],
        "swapped": [total, claim, ("billed_date", "date")],
        "retyped": [claim, total, ("billed_date", "text")],
        "longer": [claim, total, ("billed_date", "date"), ("status", "text")],
        "other": [claim, total, ("gone", "date")],
    }
    frames = {name: found for name in [*targets, "absent"]}
    return schema_check(t.spark, frames, targets)


# ---- unions -------------------------------------------------------------


def _by_status(t: Tables, status: str) -> DataFrame:
    return t.orders.filter(F.col("o_orderstatus") == status)


@query(
    "union_accounts",
    """SELECT o_orderkey AS claim_id, o_custkey AS account,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS note FROM orders""",
)
def accounts_union(t: Tables) -> DataFrame:
    """Three deliveries: the first, one in another order, one that lacks a column."""
    key, account = F.col("o_orderkey").alias("claim_id"), F.col("o_custkey").alias("account")
    note = F.col("o_orderpriority").alias("note")
    return union_accounts(
        [
            _by_status(t, "F").select(key, account, note),
            _by_status(t, "O").select(note, account, key),
            _by_status(t, "P").select(account, key, F.lit(1).alias("more")),
        ]
    )


@query(
    "union_accounts_by_position",
    """SELECT CAST(CASE WHEN o_orderstatus = 'O' THEN o_custkey ELSE o_orderkey END AS BIGINT) AS a,
  CASE o_orderstatus WHEN 'F' THEN o_custkey WHEN 'O' THEN o_orderkey END AS b FROM orders""",
)
def accounts_union_by_position(t: Tables) -> DataFrame:
    key, account = F.col("o_orderkey"), F.col("o_custkey")
    return union_accounts(
        [
            _by_status(t, "F").select(key.alias("a"), account.alias("b")),
            _by_status(t, "O").select(account, key, F.lit("cut")),
            _by_status(t, "P").select(key),
        ],
        by_position=True,
    )


@query(
    "union_conform",
    """SELECT o_orderkey AS claim_id,
  CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice) ELSE o_totalprice END AS total,
  CASE o_orderstatus WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    ELSE strftime(o_orderdate, '%m/%d/%Y') END AS entered,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS note FROM orders""",
)
def instances_union(t: Tables) -> DataFrame:
    """bigint meets double as double, a date meets text as text, a lack is blank."""
    key, price = F.col("o_orderkey").alias("claim_id"), F.col("o_totalprice")
    day, text_day = F.col("o_orderdate").cast("date"), F.date_format("o_orderdate", "MM/dd/yyyy")
    note = F.col("o_orderpriority").alias("note")
    return union_conform(
        [
            _by_status(t, "F").select(key, price.alias("total"), day.alias("entered"), note),
            _by_status(t, "O").select(
                note, text_day.alias("entered"), F.floor(price).alias("total"), key
            ),
            _by_status(t, "P").select(
                key, price.alias("total"), text_day.alias("entered"), F.lit(1).alias("more")
            ),
        ]
    )
