"""Versioned stores, and loads of files with faulty records."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from revflow.operators.history import row_history, snapshot_changes
from revflow.operators.quality import RuleViolation
from revflow.plans.load import load_reports
from revflow.plans.snapshot_load import append_snapshot
from revflow.session import run_folder
from revflow.sinks.versions import Version, history, open_version, refresh_all, table_of_version
from revflow.sources.csv_records import faults_of, scan_with_faults
from revflow.sources.reports import scan_report_csv
from revflow.sources.snapshots import ddl_catalogue, scan_snapshot
from revflow.workload.carrier import d152, dec
from revflow.workload.landing import write_files_with_header
from revflow.workload.registry import Tables, query


def _sums(t: Tables, label: str, version: Version) -> DataFrame:
    """(seen, table_name, rows, amount) of each table as a reader of the version finds it."""
    out = None
    for name, entry in version.tables.items():
        own = table_of_version(t.spark, entry).agg(
            F.lit(label).alias("seen"), F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.sum("amount").alias("amount")
        )
        out = own if out is None else out.unionAll(own)
    return out


_AMOUNTS = f"""SELECT 'orders' AS t, o_orderkey AS k, {d152("o_totalprice")} AS a FROM orders
  UNION ALL SELECT 'customers', c_custkey, {d152("c_acctbal")} FROM customer
  UNION ALL SELECT 'charges', l_orderkey * 8 + l_linenumber, {d152("l_extendedprice")} FROM lineitem"""


@query(
    "versioned_refresh",
    f"""WITH x AS ({_AMOUNTS}), s AS (SELECT s FROM (VALUES ('before'), ('after fault'), ('kept open'), ('after commit')) v(s))
SELECT s AS seen, t AS table_name, count(*) AS rows,
  CAST(sum(a + CASE WHEN s = 'after commit' AND t <> 'customers' THEN 1 ELSE 0 END) AS DOUBLE) AS amount
FROM x, s GROUP BY s, t""",
)
def versioned_refresh(t: Tables) -> DataFrame:
    """Three tables replaced by one commit. A load that fails in its third table is seen by no reader."""
    store = run_folder(t.spark, "versions")
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    frames = {
        "orders": t.orders.select(F.col("o_orderkey").alias("key"), dec("o_totalprice").alias("amount")),
        "customers": t.customer.select(F.col("c_custkey").alias("key"), dec("c_acctbal").alias("amount")),
        "charges": t.lineitem.select(line.alias("key"), dec("l_extendedprice").alias("amount")),
    }
    keys = {name: ["key"] for name in ("orders", "customers")}  # a charge may be listed twice
    first = refresh_all(t.spark, store, frames, keys)
    more = {
        name: table_of_version(t.spark, first.tables[name]).select("key", (F.col("amount") + 1).cast("decimal(15,2)").alias("amount"))
        for name in ("orders", "charges")
    }
    last = more["charges"].agg(F.max("key")).first()[0]
    torn = F.when(F.col("key") == last, F.raise_error(F.lit("the source is gone")).cast("bigint")).otherwise(F.col("key"))
    try:
        refresh_all(t.spark, store, more | {"charges": more["charges"].withColumn("key", torn)}, keys)
    except PySparkException:
        after_fault = open_version(t.spark, store)
    second = refresh_all(t.spark, store, more, keys)
    assert open_version(t.spark, store) == second
    seen = [("before", first), ("after fault", after_fault), ("kept open", open_version(t.spark, store, 1)), ("after commit", second)]
    parts = [_sums(t, label, version) for label, version in seen]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


_SCRIPT = """CREATE TABLE CLAIMS (
SEQNO NUMBER(19) PRIMARY KEY,
CUSTNO NUMBER(19),
AMOUNT NUMBER(12,2));
CREATE TABLE ACCOUNTS (
SEQNO NUMBER(19) PRIMARY KEY,
AMOUNT NUMBER(12,2));"""


@query(
    "versioned_snapshots",
    """WITH v AS (SELECT * FROM (VALUES (1::BIGINT, 0::BIGINT), (2, 1)) x(version, more))
SELECT version, 'claims' AS table_name, 1 + more AS folders, (SELECT count(*) FROM orders) * (1 + more) AS rows,
  (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) FROM orders) * (1 + more) AS amount FROM v
UNION ALL SELECT version, 'accounts', 1 + more, (SELECT count(*) FROM customer) * (1 + more),
  (SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) FROM customer) * (1 + more) FROM v""",
)
def versioned_snapshots(t: Tables) -> DataFrame:
    """Three snapshots of two tables; the second repeats keys of one table only, and neither table takes its rows."""
    store, catalogue = run_folder(t.spark, "versions"), ddl_catalogue(_SCRIPT)

    def snapshot(claims: int, accounts: int) -> str:
        root = run_folder(t.spark, "snapshot")
        number = lambda c, sign: (F.col(c) * sign + (sign - 1) / 2).cast("long").alias("SEQNO")
        files = {
            "CLAIMS": t.orders.select(number("o_orderkey", claims), F.col("o_custkey").alias("CUSTNO"), dec("o_totalprice", "decimal(12,2)").alias("AMOUNT")),
            "ACCOUNTS": t.customer.select(number("c_custkey", accounts), dec("c_acctbal", "decimal(12,2)").alias("AMOUNT")),
        }
        for name, df in files.items():
            df.write.option("sep", "\t").option("header", True).csv(f"{root}/A1_20250416_141525/{name}.DAT")
        return root

    append_snapshot(t.spark, snapshot(1, 1), catalogue, store)
    try:
        append_snapshot(t.spark, snapshot(-1, 1), catalogue, store)
    except RuleViolation:
        append_snapshot(t.spark, snapshot(-1, -1), catalogue, store)
    sums = [
        table_of_version(t.spark, entry).agg(F.sum("AMOUNT").alias("amount"))
        .select(F.lit(number).cast("long").alias("version"), F.lit(name).alias("table_name"), "amount")
        for number in (1, 2)
        for name, entry in open_version(t.spark, store, number).tables.items()
    ]
    out = sums[0].unionAll(sums[1]).unionAll(sums[2]).unionAll(sums[3])
    return history(t.spark, store).join(out, ["version", "table_name"])


_EXTRACTS = ("2025-04-16 14:15:25", "2025-05-16 14:15:25", "2025-06-16 14:15:25")


@query(
    "snapshot_history",
    """WITH e AS (SELECT * FROM (VALUES (1, '2025-04-16 14:15:25'), (2, '2025-05-16 14:15:25'), (3, '2025-06-16 14:15:25')) v(n, stamp)),
x AS (SELECT o_orderkey AS k, n, stamp, o_custkey AS c, CAST(o_totalprice AS DECIMAL(12,2)) + CASE WHEN o_orderkey % 5 = 0 AND n > 1 THEN 1 ELSE 0 END AS a
  FROM orders, e WHERE NOT (o_orderkey % 7 = 0 AND n = 1) AND NOT (o_orderkey % 11 = 0 AND n = 2)),
s AS (SELECT x.*, p.n IS NULL AS fresh FROM x LEFT JOIN x p ON p.k = x.k AND p.n = x.n - 1 AND p.a = x.a),
w AS (SELECT s.*, i.n IS NULL AS new FROM s LEFT JOIN x i ON i.k = s.k AND i.n = s.n - 1 WHERE fresh)
SELECT CAST(k AS DOUBLE) AS "SEQNO", CAST(c AS DOUBLE) AS "CUSTNO", CAST(a AS DOUBLE) AS "AMOUNT", 'A1' AS account, w.stamp AS valid_from,
  (SELECT min(e.stamp) FROM e WHERE e.n > w.n AND NOT EXISTS (SELECT 1 FROM x y WHERE y.k = w.k AND y.n = e.n AND y.a = w.a)) AS valid_to,
  CASE WHEN new THEN 'inserted' ELSE 'changed' END AS change FROM w""",
)
def snapshot_history(t: Tables) -> DataFrame:
    """States of claims from three extracts: some changed, some came later, some were gone for one."""
    root, table = run_folder(t.spark, "snapshots"), ddl_catalogue(_SCRIPT)["CLAIMS"]
    key = F.col("o_orderkey")
    for n, at in enumerate(_EXTRACTS):
        there = t.orders.filter(~((key % 7 == 0) & F.lit(n == 0)) & ~((key % 11 == 0) & F.lit(n == 1)))
        amount = dec("o_totalprice", "decimal(12,2)") + F.when((key % 5 == 0) & F.lit(n > 0), 1).otherwise(0)
        rows = there.select(key.alias("SEQNO"), F.col("o_custkey").alias("CUSTNO"), amount.cast("decimal(12,2)").alias("AMOUNT"))
        label = at.replace("-", "").replace(":", "").replace(" ", "_")
        rows.write.option("sep", "\t").option("header", True).csv(f"{root}/A1_{label}/CLAIMS.DAT")
    return row_history(scan_snapshot(t.spark, root, table, with_lineage=True), ["account", "SEQNO"])


@query(
    "snapshot_changes",
    """SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'inserted' WHEN o_orderkey % 11 = 0 THEN 'deleted' ELSE 'changed' END AS change,
  count(*) AS keys FROM orders WHERE (o_orderkey % 7 = 0 AND o_orderkey % 11 <> 0) OR o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0
  OR (o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0) GROUP BY 1""",
)
def changes_between(t: Tables) -> DataFrame:
    """Keys inserted, changed and deleted between two snapshots."""
    key = F.col("o_orderkey")
    rows = t.orders.select(key, "o_custkey", dec("o_totalprice").alias("amount"))
    raised = rows.withColumn("amount", F.when(key % 5 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(15,2)"))
    found = snapshot_changes(rows.filter(key % 7 != 0), raised.filter(key % 11 != 0), ["o_orderkey"])
    return found.groupBy("change").agg(F.count("*").alias("keys"))


# ---- records that are no lines, and records that do not fit ---------------

_REMARK = """CASE l_orderkey % 5 WHEN 0 THEN 'two' || chr(10) || 'lines, ' || l_linenumber
  WHEN 1 THEN 'say "' || l_returnflag || '"' WHEN 2 THEN l_suppkey || '" tube' WHEN 3 THEN chr(10) || chr(10) || '"' END"""


def _remark():
    """A remark as it stands in a file."""
    key = F.col("l_orderkey") % 5
    text = (
        F.when(key == 0, F.concat(F.lit("two\nlines, "), F.col("l_linenumber").cast("string")))
        .when(key == 1, F.concat(F.lit('say "'), "l_returnflag", F.lit('"')))
        .when(key == 3, F.lit('\n\n"'))
    )
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(key == 2, F.concat(F.col("l_suppkey").cast("string"), F.lit('" tube'))).otherwise(quoted)


@query(
    "scan_csv_splits",
    f"""SELECT l_orderkey * 8 + l_linenumber AS charge_id, {_REMARK} AS remark,
  CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS amount FROM lineitem""",
)
def scan_csv_splits(t: Tables) -> DataFrame:
    """Fields over line ends, doubled quotes and quotes that open nothing, in files of many splits."""
    root = run_folder(t.spark, "csv")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    line = F.concat_ws(",", key.cast("string"), F.coalesce(_remark(), F.lit("")), dec("l_extendedprice").cast("string"))
    write_files_with_header(t.lineitem, root, "Charge ID,Remark,Amount", line, {"part": F.col("l_suppkey") % 4})
    found = scan_report_csv(t.spark, root, ["charge_id", "remark", "amount"], multi_line=True, recursive=True)
    return found.select(F.col("charge_id").cast("long").alias("charge_id"), "remark", F.col("amount").cast("double").alias("amount"))


@query(
    "csv_faults",
    """SELECT CASE WHEN o_orderkey % 40 = 0 THEN 'record longer than its header' END AS reason,
  CASE WHEN o_orderkey % 40 = 0 THEN 5 ELSE 0 END AS fields, o_orderkey % 3 = 0 AS over_lines, count(*) AS records
FROM orders WHERE o_orderkey % 40 = 0 GROUP BY ALL
UNION ALL SELECT 'kept', CAST(count(CASE WHEN o_orderkey % 40 <> 1 THEN o_totalprice END) AS INT), NULL, count(*) FROM orders WHERE o_orderkey % 40 <> 0""",
)
def csv_faults(t: Tables) -> DataFrame:
    """Records with too many fields are told apart with their reason; those with too few end in NULLs."""
    root = run_folder(t.spark, "csv")
    key = F.col("o_orderkey")
    note = F.when(key % 3 == 0, F.lit('"a, ""b""\nc"')).otherwise(F.lit("plain"))
    cells = [key.cast("string"), note, F.lit("x"), F.when(key % 40 != 1, dec("o_totalprice").cast("string")), F.when(key % 40 == 0, F.lit("more"))]
    write_files_with_header(t.orders, root, "Key,Note,Code,Total", F.concat_ws(",", *cells), {"part": key % 3})
    found = scan_with_faults(t.spark, root, ["key", "note", "code", "total"], True, recursive=True)
    faults = faults_of(found).groupBy("reason", F.size("fields").alias("fields"), F.contains("text", F.lit("\n")).alias("over_lines"))
    kept = found.filter(F.coalesce(F.col("_fault.reason") != "record longer than its header", F.lit(True)))
    return faults.agg(F.count("*").alias("records")).unionAll(
        kept.agg(F.lit("kept"), F.count("total").cast("int"), F.lit(None).cast("boolean"), F.count("*"))
    )


@query(
    "load_with_faults",
    """WITH x AS (SELECT r_name, o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS a
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'loaded' AS kind, r_name AS instance_key, count(*) AS rows, CAST(sum(a) AS DOUBLE) AS amount,
  CAST(count(CASE WHEN r_name = 'EUROPE' THEN 1 END) AS BIGINT) AS further
FROM x WHERE o_orderkey % 50 <> 0 GROUP BY r_name
UNION ALL SELECT 'set aside', r_name, count(*), NULL, NULL FROM x WHERE o_orderkey % 50 = 0 GROUP BY r_name
UNION ALL SELECT 'lacks: late_code', r_name, NULL, NULL, NULL FROM region WHERE r_name <> 'EUROPE'""",
)
def load_with_faults(t: Tables) -> DataFrame:
    """Reports of five tenants, some records too long, one report with a column of its own: nothing is lost untold."""
    root, aside = run_folder(t.spark, "delivered"), run_folder(t.spark, "aside")
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key, tenant = F.col("o_orderkey"), F.col("r_name")
    note = F.when(key % 7 == 0, F.lit('"over\nlines"')).otherwise(F.lit("plain"))
    cells = [key.cast("string"), tenant, note, dec("o_totalprice").cast("string")]
    for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"):
        own = [*cells, F.concat(F.lit("L"), key.cast("string"))] if name == "EUROPE" else cells
        long = F.when(key % 50 == 0, F.lit("more"))
        header = "Charge ID,Instance Key,Note,Amount" + (",Late Code" if name == "EUROPE" else "")
        folder = {"part": F.floor(key / 20000)}
        write_files_with_header(
            placed.filter(tenant == name), f"{root}/{name}/Claim Sheet.csv", header, F.concat_ws(",", *own, long), folder
        )
    store = run_folder(t.spark, "versions")
    done = load_reports(
        t.spark, root, store, partition_by="instance_key", quarantine=aside, further="keep", versioned=True, pattern="part-*"
    )
    sheet = table_of_version(t.spark, open_version(t.spark, store, done.version).tables["claim_sheet"])
    loaded = sheet.groupBy(F.lit("loaded").alias("kind"), "instance_key").agg(
        F.count("*").alias("rows"), F.sum(F.col("amount").cast("decimal(15,2)")).alias("amount"), F.count_if(F.col("late_code") != "").alias("further")
    )
    records = t.spark.read.option("recursiveFileLookup", True).parquet(aside)
    of_path = F.url_decode(F.regexp_extract("file_path", r"([^/]+)/Claim(?:%20| )Sheet\.csv/", 1))
    kept_apart = records.groupBy(of_path.alias("instance_key")).agg(F.count("*").alias("rows"))
    kept_apart = kept_apart.select(F.lit("set aside"), "instance_key", "rows", F.lit(None), F.lit(None))
    lacking = [(f"lacks: {','.join(d.missing)}", d.report.split("/")[-2].replace("%20", " ")) for d in done.columns]
    told = t.spark.createDataFrame(lacking, "kind string, instance_key string").select("*", F.lit(None), F.lit(None), F.lit(None))
    return loaded.unionAll(kept_apart).unionAll(told)
