"""Scalar functions and lookups, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revflow import functions as fn
from revflow.functions.names import snake_column
from revflow.operators.crosswalk import level_of_care_join, lookup_faults, payer_code_join
from revflow.workload.carrier import (
    LOC_SQL,
    PAYERS_SQL,
    charges,
    code_of,
    code_sql,
    d152,
    dec,
    money_sql,
    money_text,
    money_text_sql,
    payers,
)
from revflow.workload.mart_queries import HOLD_SQL, STATEMENT_SQL, double
from revflow.workload.registry import Tables, query


def _kinds(key: str, n: int):
    return F.col(key) % n


_MONEY_RAW = f"""CASE o_orderkey % 6 WHEN 0 THEN {money_text_sql("o_totalprice")}
    WHEN 1 THEN CAST({d152("o_totalprice")} AS VARCHAR) WHEN 2 THEN ''
    WHEN 4 THEN '(' || {d152("o_totalprice")} || ')'
    WHEN 5 THEN '$-' || {d152("o_totalprice")} END"""


@query(
    "money_parse",
    f"""SELECT o_orderkey, raw, {double(money_sql("raw"), "amount")},
  raw IS NOT NULL AND {money_sql("raw")} IS NULL AS rejected
FROM (SELECT o_orderkey, {_MONEY_RAW} AS raw FROM orders)""",
)
def money_parse(t: Tables) -> DataFrame:
    kind, plain = _kinds("o_orderkey", 6), dec("o_totalprice").cast("string")
    raw = (
        F.when(kind == 0, money_text(dec("o_totalprice")))
        .when(kind == 1, plain)
        .when(kind == 2, "")
        .when(kind == 4, F.concat(F.lit("("), plain, F.lit(")")))
        .when(kind == 5, F.concat(F.lit("$-"), plain))
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).select(
        "*",
        fn.money(F.col("raw")).alias("amount"),
        fn.money_rejected(F.col("raw")).alias("rejected"),
    )


@query(
    "strip_trailing_id",
    """SELECT c_custkey, raw, regexp_replace(raw, '\\s*\\(\\d+\\)$', '') AS patient_full_name
FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ' (' || c_custkey || ')'
    WHEN 1 THEN c_name || '(' || c_custkey || ')' WHEN 2 THEN '(12) ' || c_name
    ELSE c_name || ' (x1)' END AS raw FROM customer)""",
)
def strip_trailing_id(t: Tables) -> DataFrame:
    kind, key = _kinds("c_custkey", 4), F.col("c_custkey").cast("string")
    raw = (
        F.when(kind == 0, F.concat("c_name", F.lit(" ("), key, F.lit(")")))
        .when(kind == 1, F.concat("c_name", F.lit("("), key, F.lit(")")))
        .when(kind == 2, F.concat(F.lit("(12) "), "c_name"))
        .otherwise(F.concat("c_name", F.lit(" (x1)")))
    )
    return t.customer.select("c_custkey", raw.alias("raw")).withColumn(
        "patient_full_name", fn.strip_trailing_id(F.col("raw"))
    )


@query(
    "date_parts",
    """SELECT o_orderkey, rpad(lower(dayname(d)), 9, ' ') AS day_lower,
  rpad(dayname(d), 9, ' ') AS day_capital, dayname(d) AS day_trimmed,
  'Week' || strftime(d, '%V') AS iso_week, rpad(monthname(d), 9, ' ') AS month_name,
  strftime(d, '%Y') AS calendar_year,
  concat(rpad(monthname(d), 9, ' '), strftime(d, '%Y')) AS month_year,
  CAST(d - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS week_start
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS d
  FROM orders)""",
)
def date_parts(t: Tables) -> DataFrame:
    d = F.col("d")
    day = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", day.alias("d")).select(
        "o_orderkey",
        fn.weekday_name(d).alias("day_lower"),
        fn.weekday_name(d, capital=True).alias("day_capital"),
        fn.weekday_name(d, capital=True, trim=True).alias("day_trimmed"),
        fn.iso_week_label(d).alias("iso_week"),
        fn.month_name(d).alias("month_name"),
        fn.year_text(d).alias("calendar_year"),
        fn.month_year_label(fn.month_name(d), fn.year_text(d)).alias("month_year"),
        fn.week_start(d).alias("week_start"),
    )


@query(
    "date_lags",
    """SELECT l_orderkey, l_partkey, l_linenumber, entered_text, billed_text,
  CAST(try_strptime(entered_text, '%m/%d/%Y') AS DATE)::VARCHAR AS entered,
  CAST(date_diff('day', e, DATE '2001-07-20') AS INTEGER) AS days_on_hold,
  CAST(date_diff('day', e, b) AS INTEGER) AS charge_lag,
  CAST(date_diff('day', e, r) AS INTEGER) AS posting_turnaround
FROM (
  SELECT *, CAST(try_strptime(entered_text, '%m/%d/%Y') AS DATE) AS e,
    CAST(try_strptime(billed_text, '%m/%d/%Y') AS DATE) AS b
  FROM (
    SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS r,
      CASE WHEN l_partkey % 19 = 0 THEN '2/30/2001'
        ELSE strftime(CAST(l_shipdate AS DATE) - CAST(l_partkey % 40 AS INTEGER), '%-m/%-d/%Y') END
        AS entered_text,
      CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%m/%d/%Y') END AS billed_text
    FROM lineitem))""",
)
def date_lags(t: Tables) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date")
    early = F.date_sub(shipped, (F.col("l_partkey") % 40).cast("int"))
    entered_text = F.when(F.col("l_partkey") % 19 == 0, "2/30/2001").otherwise(
        F.date_format(early, "M/d/yyyy")
    )
    billed_text = F.when(F.col("l_linestatus") == "F", F.date_format(shipped, "MM/dd/yyyy"))
    dated = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        shipped.alias("_received"),
        entered_text.alias("entered_text"),
        billed_text.alias("billed_text"),
    ).withColumns(
        {
            "entered": fn.parse_date(F.col("entered_text")),
            "_billed": fn.parse_date(F.col("billed_text")),
        }
    )
    entered = F.col("entered")
    return dated.withColumns(
        {
            "days_on_hold": fn.days_on_hold(entered, F.lit("2001-07-20").cast("date")),
            "charge_lag": fn.charge_lag(F.col("_billed"), entered),
            "posting_turnaround": fn.posting_turnaround(F.col("_received"), entered),
        }
    ).drop("_received", "_billed")


@query(
    "statement_bucket",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(n AS DOUBLE) AS statements,
  {STATEMENT_SQL.format(n="n")} AS bucket
FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 13 = 0 THEN 4.5
    WHEN l_partkey % 17 <> 0 THEN l_linenumber + CAST(l_quantity AS INTEGER) % 5 - 1 END AS n
  FROM lineitem)""",
)
def statement_bucket(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    whole = F.col("l_linenumber") + F.col("l_quantity").cast("int") % 5 - 1
    n = F.when(part % 13 == 0, F.lit(4.5)).when(part % 17 != 0, whole.cast("double"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", n.alias("statements")
    ).withColumn("bucket", fn.statement_bucket(F.col("statements")))


@query(
    "hold_age_bucket",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, days, {HOLD_SQL.format(d="days")} AS bucket
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_partkey % 17 <> 0 THEN CAST(l_partkey % 120 - 5 AS INTEGER) END AS days
  FROM lineitem)""",
)
def hold_age_bucket(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    days = F.when(part % 17 != 0, (part % 120 - 5).cast("int"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", days.alias("days")
    ).withColumn("bucket", fn.hold_age_bucket(F.col("days")))


@query(
    "payer_crosswalk_join",
    f"""WITH {PAYERS_SQL}
SELECT c_custkey, n_name AS payer, payer_code FROM customer
JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN payer_name_crosswalk ON payer_name = n_name""",
)
def payer_crosswalk_join(t: Tables) -> DataFrame:
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("payer")
    )
    return payer_code_join(named, payers(t), "payer")


@query(
    "crosswalk_faults",
    """WITH x AS (SELECT n_name AS payer_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 = 0),
c AS (SELECT payer_name, count(*) AS n FROM x GROUP BY 1),
l AS (SELECT n_name AS value, count(*) AS rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT value, CASE WHEN coalesce(n, 0) = 0 THEN 'unmatched' ELSE 'repeated' END AS fault, rows, coalesce(n, 0) AS matches,
  CAST(rows * greatest(coalesce(n, 0) - 1, 0) AS BIGINT) AS rows_added
FROM l LEFT JOIN c ON value = payer_name WHERE coalesce(n, 0) <> 1""",
)
def crosswalk_faults(t: Tables) -> DataFrame:
    """Payers that a crosswalk lists several times, with the charges they multiply, and those it lacks."""
    listed = t.supplier.filter("s_suppkey % 4 = 0").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    crosswalk = listed.select(F.col("n_name").alias("payer_name"), F.col("s_suppkey").alias("payer_code"))
    return lookup_faults(charges(t).select(F.col("n_name").alias("payer")), "payer", crosswalk, "payer_name")


@query(
    "loc_crosswalk_join",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, code, level_of_care
FROM (SELECT l_orderkey, l_linenumber, l_partkey, {code_sql("l_partkey")} AS code FROM lineitem)
LEFT JOIN {LOC_SQL} ON rev_code = code""",
)
def loc_crosswalk_join(t: Tables) -> DataFrame:
    coded = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", code_of("l_partkey").alias("code")
    )
    return level_of_care_join(coded, "code")


@query(
    "snake_case_names",
    """SELECT raw, CASE WHEN s = '' THEN 'unnamed_column' ELSE s END AS name, count(*) AS uses
FROM (SELECT raw,
    trim(lower(regexp_replace(raw, '[^\\p{L}\\p{N}]+', '_', 'g')), '_') AS s
  FROM (SELECT url AS raw FROM pages UNION ALL SELECT p_name || '/' || p_brand || '  (' || p_type || ')'
    FROM part UNION ALL SELECT '***' FROM supplier))
GROUP BY ALL""",
)
def snake_case_names(t: Tables) -> DataFrame:
    label = F.concat("p_name", F.lit("/"), "p_brand", F.lit("  ("), "p_type", F.lit(")"))
    raw = (
        t.pages.select(F.col("url").alias("raw"))
        .unionAll(t.part.select(label))
        .unionAll(t.supplier.select(F.lit("***")))
    )
    return (
        raw.withColumn("name", snake_column(F.col("raw")))
        .groupBy("raw", "name")
        .agg(F.count("*").alias("uses"))
    )
