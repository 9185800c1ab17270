"""The whole load flow: delivered files to published views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revflow.plans.fetch import chosen_payloads, spool_reports
from revflow.plans.flat_load import flat_report_tables, load_flat_reports
from revflow.plans.load import load_reports
from revflow.plans.publish import run_sql_scripts
from revflow.plans.report_layouts import REPORT_LAYOUTS
from revflow.plans.snapshot_load import load_snapshot
from revflow.session import run_folder
from revflow.sinks.files import pipe_lines, write_pipe_dat, write_report_csv
from revflow.sources.reports import scan_report_csv
from revflow.sources.snapshots import ddl_catalogue
from revflow.workload.carrier import CHARGES_SQL, charges, claims, d152, dec, money_text
from revflow.workload.landing import envelopes
from revflow.workload.registry import Tables, query


@query(
    "load_and_publish",
    f"""WITH {CHARGES_SQL}
SELECT c_mktsegment AS facility_name, l_returnflag AS claim_status,
  CAST(l_partkey % 50 + 90800 AS BIGINT) AS level_of_care,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  r_name AS instance_key
FROM charges GROUP BY ALL""",
)
def load_and_publish(t: Tables) -> DataFrame:
    """Held charges delivered as CSV per instance, loaded, and asked for by view name."""
    root = run_folder(t.spark, "delivered")
    held = charges(t).select(
        F.col("o_custkey").alias("customer_account"),
        F.col("r_name").alias("instance_key"),
        F.col("c_mktsegment").alias("Practice Name"),
        F.col("l_returnflag").alias("Claim Status"),
        (F.col("l_partkey") % 50 + 90800).alias("Charge CPT Code"),
        money_text(dec("l_extendedprice")).alias("Charge Amount"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("Charge From Date"),
    )
    write_report_csv(held, root, "Charges on Hold")
    load_reports(t.spark, root, run_folder(t.spark, "store"))
    return t.spark.table("v_charges_on_hold")


@query(
    "load_as_delivered",
    """SELECT r_name AS instance_key, CAST(o_orderkey AS BIGINT) AS charge_id,
  CASE WHEN r_name = 'ASIA' THEN 'R' || o_orderkey ELSE (o_orderkey + 10000000) || '.50' END AS reference,
  CASE WHEN r_name = 'EUROPE' THEN '' ELSE strftime(o_orderdate, '%m/%d/%Y') END AS billed_on,
  CAST(o_orderkey + CASE WHEN r_name = 'AFRICA' THEN 0.25 ELSE 0 END AS DOUBLE) AS units
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def load_as_delivered(t: Tables) -> DataFrame:
    """Reports of five tenants in many files, which differ in the types of a column and in its presence.

    Text is what was delivered where numbers meet text, and a tenant without any value makes the column text.
    """
    root = run_folder(t.spark, "delivered")
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, tenant = F.col("o_orderkey").cast("string"), F.col("r_name")
    rows = placed.select(
        key.alias("Charge ID"),
        tenant.alias("instance_key"),
        F.when(tenant == "ASIA", F.concat(F.lit("R"), key))
        .otherwise(F.concat((F.col("o_orderkey") + 10000000).cast("string"), F.lit(".50")))
        .alias("Reference"),
        F.when(tenant != "EUROPE", F.date_format("o_orderdate", "MM/dd/yyyy")).alias("Billed On"),
        F.when(tenant == "AFRICA", F.concat(key, F.lit(".25"))).otherwise(key).alias("Units"),
    )
    for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"):
        write_report_csv(rows.filter(tenant == name), f"{root}/{name}", "Charge Sheet", rebalance=False)
    database = f"delivered_{root[-12:]}"
    load_reports(t.spark, root, run_folder(t.spark, "store"), database=database, partition_by="instance_key")
    load_reports(t.spark, root, run_folder(t.spark, "store"), database=database, partition_by="instance_key")
    return t.spark.table(f"{database}.charge_sheet").select("instance_key", "charge_id", "reference", "billed_on", "units")


# ---- envelopes to spooled reports ---------------------------------------


@query(
    "spool_envelopes",
    """WITH o AS (SELECT CAST(o_orderkey AS BIGINT) AS k, o_orderkey // 200 AS a, o_orderpriority FROM orders)
SELECT CAST(a AS VARCHAR) AS customer_account, i AS instance_key, CAST(k AS VARCHAR) AS claim_id,
  o_orderpriority AS status
FROM o, (SELECT unnest(['I0', 'I1', 'I2', 'J']) AS i) WHERE a % 2 = 0 AND (i = 'I' || a % 3 OR i = 'J')""",
)
def spool_envelopes(t: Tables) -> DataFrame:
    """Of two runs per account and instance only the active one is decoded and spooled.

    Every account has payloads in two instances. Odd accounts have no active
    run and therefore no rows. Every other payload has its columns turned round, and
    some accounts, not the lowest, tell the status in a column that only they have.
    """
    spooled = _spooled(t, faults=False)[0]
    status = F.coalesce(F.nullif("status", F.lit("")), "later_status").alias("status")
    return spooled.select("customer_account", "instance_key", "claim_id", status)


@query(
    "envelope_errors",
    """WITH a AS (SELECT DISTINCT o_orderkey // 200 AS a FROM orders WHERE (o_orderkey // 200) % 2 = 0)
SELECT CAST(a AS VARCHAR) AS customer_account, 'I' || a % 3 AS instance_key, 'Open Claims' AS report_name,
  CASE a % 10 WHEN 8 THEN 'report.csv' END AS member,
  CASE a % 10 WHEN 2 THEN 'broken XML' WHEN 4 THEN 'broken base64' WHEN 6 THEN 'broken zip'
    ELSE 'record longer than its header' END AS fault
FROM a WHERE a % 10 <> 0""",
)
def spool_with_faults(t: Tables) -> DataFrame:
    """Unreadable payloads and records too long for their header are quarantined, each with its reason."""
    return _spooled(t, faults=True)[1].select("customer_account", "instance_key", "report_name", "member", "fault")


def _spooled(t: Tables, faults: bool) -> tuple[DataFrame, DataFrame | None]:
    chunk, key = F.floor(F.col("o_orderkey") / 200), F.col("o_orderkey").cast("string")
    extra = F.lit(False) if faults else chunk % 8 == 4
    records = (
        t.orders.select(
            chunk.alias("account"),
            F.when(extra, F.array(F.lit("Claim ID"), F.lit("Status"), F.lit("Later Status")))
            .when(chunk % 4 == 2, F.array(F.lit("Status"), F.lit("Claim ID")))
            .otherwise(F.array(F.lit("Claim ID"), F.lit("Status")))
            .alias("header"),
            F.struct(
                F.when(extra, F.array(key, F.lit(""), "o_orderpriority"))
                .when(chunk % 4 == 2, F.array("o_orderpriority", key))
                .otherwise(F.array(key, "o_orderpriority"))
                .alias("cells")
            ).alias("record"),
        )
        .groupBy("account", "header")
        .agg(F.collect_list("record").alias("records"))
        .withColumn("account", F.col("account").cast("string"))
    )
    instance = F.concat(F.lit("I"), (F.col("account").cast("bigint") % 3).cast("string"))
    runs = F.explode(F.array(F.lit("old"), F.lit("new")))
    landed = run_folder(t.spark, "payloads")
    if faults:
        long = F.array_append("records", F.struct(F.array(*[F.lit("x")] * 3).alias("cells")))
        records = records.withColumn("records", F.when(F.col("account") % 10 == 8, long).otherwise(F.col("records")))
    delivered = envelopes(records).select(
        F.col("account").alias("customer_account"),
        F.explode(F.array(instance, F.lit("J"))).alias("instance_key"),
        F.lit("Open Claims").alias("report_name"),
        "xml",
    )
    if faults:
        kind, whole = F.col("customer_account") % 10, F.col("instance_key") == "J"
        broken = (
            F.when(whole | ~F.col("xml").contains("<Data>"), F.col("xml"))
            .when(kind == 2, F.expr("left(xml, length(xml) - 9)"))
            .when(kind == 4, F.lit("<Result><Data>***</Data></Result>"))
            .when(kind == 6, F.lit("<Result><Data>bm8gemlw</Data></Result>"))
            .otherwise(F.col("xml"))
        )
        delivered = delivered.withColumn("xml", broken).filter(~whole)
    delivered.select("*", runs.alias("identifier")).write.parquet(landed)
    payloads = t.spark.read.parquet(landed)
    ledger = payloads.select(
        "customer_account",
        "instance_key",
        "report_name",
        "identifier",
        F.when(F.col("identifier") == "new", 2).otherwise(1).cast("bigint").alias("sequence"),
        F.when(
            (F.col("identifier") == "new") & (F.col("customer_account").cast("bigint") % 2 == 0), 1
        )
        .otherwise(0)
        .alias("status"),
    ).distinct()
    chosen = chosen_payloads(payloads, ledger)
    kept = run_folder(t.spark, "quarantine") if faults else None
    paths = spool_reports(chosen, run_folder(t.spark, "spool"), quarantine=kept)
    spooled = scan_report_csv(t.spark, paths["Open Claims"], recursive=True)
    return spooled, t.spark.read.parquet(kept) if faults else None


# ---- flat files ---------------------------------------------------------


def _flat_folder(t: Tables) -> str:
    """Two report files, one of them with short lines, and an empty third one."""
    root = run_folder(t.spark, "flat")
    layout = REPORT_LAYOUTS["claim_stage_breakdown"].fieldNames()
    named = claims(t).select(
        F.col("o_custkey").cast("string").alias("customer_account"),
        F.col("c_mktsegment").alias("practice_name"),
        F.col("o_orderkey").cast("string").alias("claim_id"),
        money_text(dec("o_totalprice")).alias("charge_balance_at_collections"),
    )
    write_pipe_dat(named, f"{root}/claim_stage_breakdown.dat", layout)
    productivity = REPORT_LAYOUTS["rcm_productivity"].fieldNames()
    users = t.customer.select(
        F.col("c_custkey").cast("string").alias("customer_account"),
        F.col("c_name").alias("created_by_user"),
    )
    whole = pipe_lines(users.withColumn("claim_status", F.lit("open")), productivity)
    short = pipe_lines(users, productivity[:2])
    whole.unionAll(short).write.text(f"{root}/rcm_productivity.dat")
    t.customer.limit(0).select("c_name").write.text(f"{root}/denial_trends.dat")
    return root


@query(
    "flat_report_load",
    f"""SELECT 'claim_stage_breakdown' AS table_name, CAST(o_custkey AS VARCHAR) AS account,
  CAST(o_orderkey AS VARCHAR) AS claim_id,
  '$' || format('{{:,.2f}}', CAST({d152("o_totalprice")} AS DOUBLE)) AS last_column
FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'rcm_productivity', CAST(c_custkey AS VARCHAR), NULL, 'open' FROM customer
UNION ALL SELECT 'rcm_productivity', CAST(c_custkey AS VARCHAR), NULL, NULL FROM customer""",
)
def flat_report_load(t: Tables) -> DataFrame:
    """Flat files loaded into their tables, short lines padded."""
    load_flat_reports(t.spark, _flat_folder(t), run_folder(t.spark, "store"), prefix="flat_")
    breakdown = t.spark.table("flat_claim_stage_breakdown").select(
        F.lit("claim_stage_breakdown").alias("table_name"),
        F.col("customer_account").alias("account"),
        "claim_id",
        F.col("charge_balance_at_collections").alias("last_column"),
    )
    productivity = t.spark.table("flat_rcm_productivity").select(
        F.lit("rcm_productivity"), "customer_account", "claim_id", "claim_status"
    )
    return breakdown.unionAll(productivity)


@query(
    "flat_report_audit",
    """SELECT table_name, CASE WHEN rows > 0 THEN 'loaded' WHEN table_name = 'denial_trends'
    THEN 'empty' ELSE 'failed' END AS status, rows AS rows_loaded, adjusted AS rows_adjusted
FROM (SELECT 'claim_stage_breakdown' AS table_name, count(*) AS rows, 0 AS adjusted FROM orders
  UNION ALL SELECT 'rcm_productivity', 2 * count(*), count(*) FROM customer
  UNION ALL SELECT unnest(['ar_aging', 'charges_on_hold', 'denial_trends', 'gross_billing',
    'payment_trend', 'quadrant_performance']), 0, 0)""",
)
def flat_report_audit(t: Tables) -> DataFrame:
    """Two loaded files, one empty, five missing."""
    return flat_report_tables(t.spark, _flat_folder(t))[1]


# ---- snapshots ----------------------------------------------------------

# Made-up tables in the dialect of a snapshot's own script.
_DDL = """CREATE TABLE CLAIMS (
SEQNO NUMBER(19) PRIMARY KEY,
CUSTNO NUMBER(19),
AMOUNT NUMBER(12,2),
ENTERED TIMESTAMP,
MEMO VARCHAR2(40));
CREATE TABLE ACCOUNTS (
CUSTNO NUMBER(19),
NAME VARCHAR2(100));
CREATE TABLE NOT_DELIVERED (
SEQNO NUMBER(19) PRIMARY KEY);"""


@query(
    "snapshot_load",
    """SELECT 'CLAIMS' AS table_name, count(*) AS rows,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount,
  max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS last_entered FROM orders
UNION ALL SELECT 'ACCOUNTS', count(*), NULL, NULL FROM customer""",
)
def snapshot_load(t: Tables) -> DataFrame:
    """Snapshot files appended to typed tables that the load creates."""
    root = run_folder(t.spark, "snapshot") + "/A1_20250416_141525/5 Customers"
    entered = F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")
    claims_file = t.orders.select(
        F.col("o_orderkey").alias("SEQNO"),
        F.col("o_custkey").alias("CUSTNO"),
        dec("o_totalprice", "decimal(12,2)").alias("AMOUNT"),
        entered.alias("ENTERED"),
        F.col("o_orderpriority").alias("MEMO"),
    )
    accounts_file = t.customer.select(
        F.col("c_custkey").alias("CUSTNO"), F.col("c_name").alias("NAME")
    )
    for name, df in (("CLAIMS", claims_file), ("ACCOUNTS", accounts_file)):
        writer = df.write.option("sep", "\t").option("header", True)
        writer.csv(f"{root}/{name}.DAT")
    return _snapshot_totals(t, root)


def _snapshot_totals(t: Tables, root: str) -> DataFrame:
    prefix = "snap_" + root.split("snapshot-")[1][:12] + "_"
    load_snapshot(t.spark, root, ddl_catalogue(_DDL), run_folder(t.spark, "store"), prefix)
    amount, last = F.sum("AMOUNT"), F.max("ENTERED").cast("string")
    loaded = t.spark.table(prefix + "claims").agg(
        F.lit("CLAIMS").alias("table_name"),
        F.count("*").alias("rows"),
        amount.alias("amount"),
        last.alias("last_entered"),
    )
    accounts_loaded = t.spark.table(prefix + "accounts").agg(
        F.lit("ACCOUNTS"), F.count("*"), F.lit(None), F.lit(None)
    )
    return loaded.unionAll(accounts_loaded)


# ---- scripts ------------------------------------------------------------


@query(
    "published_scripts",
    """SELECT c_mktsegment AS practice_name, o_orderstatus AS claim_status, count(*) AS claims
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def published_scripts(t: Tables) -> DataFrame:
    """Two scripts, the second one over the first one's view, run in name order."""
    folder = run_folder(t.spark, "scripts")
    claims(t).createOrReplaceTempView("published_claims")
    scripts = {
        "1.sql": "-- base\nCREATE OR REPLACE TEMP VIEW published_base AS SELECT "
        "c_mktsegment AS practice_name, o_orderstatus AS claim_status FROM published_claims;\n-- end",
        "2.sql": "CREATE OR REPLACE TEMP VIEW published_counts AS SELECT practice_name, "
        "claim_status, count(*) AS claims FROM published_base GROUP BY ALL;",
    }
    for name, text in scripts.items():
        script = t.spark.range(1).select(F.lit(text).alias("value"))
        script.coalesce(1).write.option("lineSep", "\n").text(f"{folder}/{name}")
    run_sql_scripts(t.spark, folder, pattern="*.txt", recursive=True)
    return t.spark.table("published_counts")
