"""Data rules, stored tables, registry rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from revflow.operators.quality import duplicate_keys, quality_gate, registry_errors
from revflow.session import run_folder
from revflow.sinks.tables import (
    append_unique,
    create_if_absent,
    drop_tables,
    full_refresh,
    new_rows,
    row_counts,
)
from revflow.workload.carrier import claims, d152, dec
from revflow.workload.registry import Tables, query


@query(
    "quality_gate",
    f"""SELECT 'not_null' AS rule, 'shipped' AS column_name, count(*) FILTER (l_partkey % 23 = 0)
  AS violations FROM lineitem
UNION ALL SELECT 'not_null', 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'max_length', 'part', count(*) FILTER (length(CAST(l_partkey AS VARCHAR)) > 2)
  FROM lineitem
UNION ALL SELECT 'precision', 'price', count(*) FILTER (l_partkey % 29 = 0 OR
  {d152("l_extendedprice")} > 9999.99) FROM lineitem
UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber',
  CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem""",
)
def gate(t: Tables) -> DataFrame:
    part = F.col("l_partkey")
    df = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(part % 23 != 0, F.col("l_shipdate")).alias("shipped"),
        part.cast("string").alias("part"),
        F.when(part % 29 == 0, "n/a").otherwise(dec("l_extendedprice").cast("string")).alias("price"),
    )
    return quality_gate(
        df,
        key=["l_orderkey", "l_linenumber"],
        not_null=["shipped", "l_orderkey"],
        max_length={"part": 2},
        decimals={"price": "decimal(6,2)"},
    )


@query(
    "drop_tables",
    """SELECT r_name AS table_name, CASE WHEN r_regionkey % 2 = 0 THEN count(o_orderkey) END AS rows
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
LEFT JOIN orders ON o_custkey = c_custkey GROUP BY r_name, r_regionkey""",
)
def dropped(t: Tables) -> DataFrame:
    """Of a table of claims per region, those with odd keys are dropped; dropping twice, or what never was, does nothing."""
    mark = uuid.uuid4().hex[:8]
    regions = t.region.select("r_regionkey", "r_name").collect()
    names = {r.r_name: f"drop_{mark}_{r.r_regionkey}" for r in regions}
    own = {r.r_name: claims(t).filter(F.col("r_name") == r.r_name).select("o_orderkey", "o_totalprice") for r in regions}
    full_refresh(t.spark, {names[r]: df for r, df in own.items()}, run_folder(t.spark, "store"))
    odd = [names[r.r_name] for r in regions if r.r_regionkey % 2]
    drop_tables(t.spark, [*odd, *odd, f"drop_{mark}_never"])
    left = {table: name for name, table in names.items() if t.spark.catalog.tableExists(table)}
    counted = row_counts(t.spark, list(left))
    label = F.create_map(*[F.lit(x) for pair in left.items() for x in pair])
    counted = counted.select(F.try_element_at(label, "table_name").alias("r_name"), "rows")
    return t.region.join(counted, "r_name", "left").select(F.col("r_name").alias("table_name"), "rows")


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
)
def repeated_keys(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "registry_validate",
    """SELECT 'I' || c_custkey AS instance_key, rule, NULL AS detail, CAST(1 AS BIGINT) AS faults
FROM customer, (VALUES ('missing_url'), ('missing_user'), ('missing_password'),
  ('missing_accounts')) r(rule)
WHERE (rule = 'missing_url' AND c_acctbal < 0) OR (rule = 'missing_user' AND c_custkey % 9 = 0)
  OR (rule = 'missing_password' AND c_nationkey = 7)
  OR (rule = 'missing_accounts' AND c_custkey % 5 IN (0, 1))
UNION ALL
SELECT 'I' || o_custkey, CASE WHEN o_orderkey % 4 = 3 THEN 'missing_report_id'
    ELSE 'duplicate_report_id' END,
  CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderkey % 4 AS VARCHAR) END,
  CASE WHEN o_orderkey % 4 = 3 THEN count(*) ELSE count(*) - 1 END
FROM orders GROUP BY o_custkey, o_orderkey % 4 HAVING o_orderkey % 4 = 3 OR count(*) > 1""",
)
def registry(t: Tables) -> DataFrame:
    """An instance per customer, a configured report per order."""
    key, account = F.col("c_custkey"), F.array(F.col("c_custkey").cast("string"))
    instances = t.customer.select(
        F.concat(F.lit("I"), key.cast("string")).alias("instance_key"),
        (F.col("c_acctbal") >= 0).alias("has_url"),
        F.when(key % 9 != 0, True).alias("has_user"),
        (F.col("c_nationkey") != 7).alias("has_password"),
        F.when(key % 5 == 1, F.array().cast("array<string>"))
        .when(key % 5 != 0, account)
        .alias("accounts"),
    )
    report = F.col("o_orderkey") % 4
    reports = t.orders.select(
        F.concat(F.lit("I"), F.col("o_custkey").cast("string")).alias("instance_key"),
        F.when(report != 3, report).alias("report_id"),
    )
    return registry_errors(instances, reports)


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


@query(
    "full_refresh",
    f"""SELECT 'orders' AS table_name, o_orderkey AS key,
  CAST({d152("o_totalprice")} + 1 AS DOUBLE) AS amount FROM orders
UNION ALL SELECT 'customers', c_custkey, CAST({d152("c_acctbal")} AS DOUBLE) FROM customer""",
)
def refresh(t: Tables) -> DataFrame:
    """Two tables loaded, then replaced; the second load reads the first one's table."""
    orders, customers = _fresh("rf_orders"), _fresh("rf_customers")
    store = run_folder(t.spark, "store")
    first = {
        orders: t.orders.select(F.col("o_orderkey").alias("key"), dec("o_totalprice").alias("amount")),
        customers: t.customer.select(F.col("c_custkey").alias("key"), dec("c_acctbal").alias("amount")),
    }
    keys = {orders: ["key"], customers: ["key"]}
    create_if_absent(t.spark, customers, first[customers], store)
    full_refresh(t.spark, first, store, keys=keys)
    again = t.spark.table(orders).select("key", (F.col("amount") + 1).cast("decimal(15,2)").alias("amount"))
    full_refresh(t.spark, {orders: again}, store, keys=keys)
    return (
        t.spark.table(orders)
        .select(F.lit("orders").alias("table_name"), "*")
        .unionAll(t.spark.table(customers).select(F.lit("customers"), "*"))
    )


@query(
    "append_unique",
    """SELECT o_orderkey AS key, o_orderstatus AS status FROM orders
UNION ALL SELECT -1 - o_orderkey, 'late' FROM orders""",
)
def append(t: Tables) -> DataFrame:
    """A second load that repeats all of the first adds only its new keys."""
    table, store = _fresh("au_orders"), run_folder(t.spark, "store")
    first = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    late = t.orders.select((-1 - F.col("o_orderkey")).alias("key"), F.lit("late").alias("status"))
    create_if_absent(t.spark, table, first, store)
    append_unique(t.spark, table, first, ["key"])
    fresh = new_rows(first.unionAll(late), t.spark.table(table), ["key"])
    append_unique(t.spark, table, fresh, ["key"])
    return t.spark.table(table)


@query(
    "table_row_counts",
    """SELECT 'orders' AS table_name, count(*) AS rows FROM orders
UNION ALL SELECT 'customers', count(*) FROM customer""",
)
def counts(t: Tables) -> DataFrame:
    """Rows per stored table after a load."""
    orders, customers = _fresh("rc_orders"), _fresh("rc_customers")
    frames = {orders: t.orders, customers: t.customer}
    full_refresh(t.spark, frames, run_folder(t.spark, "store"))
    counted = row_counts(t.spark, list(frames))
    return counted.withColumn(
        "table_name", F.when(F.col("table_name") == orders, "orders").otherwise("customers")
    )
