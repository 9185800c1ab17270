"""Readers and writers: whole tables are written in a format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revflow.functions.names import column_names, distinct_names
from revflow.operators.quality import audit_totals, load_audit, profile_source
from revflow.session import run_folder
from revflow.sinks.files import (
    pipe_lines,
    write_pipe_csv,
    write_pipe_dat,
    write_report_csv,
    write_sorted_lines,
)
from revflow.sources.envelopes import decode_envelopes, records_by_name
from revflow.sources.reports import (
    collapse_repeats,
    csv_header,
    repair_ragged,
    scan_json_report,
    scan_lines_with_table,
    scan_pipe_dat,
    scan_report_csv,
)
from revflow.sources.snapshots import ddl_catalogue, read_catalogue, scan_snapshot, time_label
from revflow.workload.carrier import accounts, d152, dec
from revflow.workload.landing import csv_line, envelopes, write_files_with_header
from revflow.workload.registry import Tables, query

ROWS_PER_FILE = 5000


def _file(key: str):
    return F.floor(F.col(key) / ROWS_PER_FILE)


# ---- CSV ----------------------------------------------------------------

_NOTE_SQL = """CASE o_orderkey % 4 WHEN 0 THEN 'a, "b"' WHEN 1 THEN 'line 1' || chr(10) || 'line 2'
    WHEN 3 THEN o_orderpriority END"""


def _noted_orders(t: Tables) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    note = (
        F.when(kind == 0, 'a, "b"')
        .when(kind == 1, "line 1\nline 2")
        .when(kind == 2, "N/A")
        .otherwise(F.col("o_orderpriority"))
    )
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("Order Key"),
        F.col("o_custkey").cast("string").alias("Cust/Key"),
        note.alias("Order Note (free)"),
        dec("o_totalprice").cast("string").alias("Total"),
    )


@query(
    "scan_report_csv",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS cust_key,
  {_NOTE_SQL} AS order_note_free, CAST({d152("o_totalprice")} AS VARCHAR) AS total FROM orders""",
)
def report_csv(t: Tables) -> DataFrame:
    """Quotes, commas, line breaks and missing-value words survive the way through CSV."""
    path = write_report_csv(_noted_orders(t), run_folder(t.spark, "csv"), "orders", instance=None)
    return scan_report_csv(t.spark, path, recursive=True)


@query(
    "sink_csv_roundtrip",
    """SELECT CAST(o_custkey AS VARCHAR) AS customer_account, r_name AS instance_key,
  CAST(o_orderkey AS VARCHAR) AS claim_id, '  ' || o_orderpriority || ' ' AS claim_status,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS stage, 'own ' || o_orderstatus AS instance
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def csv_per_instance(t: Tables) -> DataFrame:
    """A report written with a folder per instance holds every row once, with outer blanks and its own ``instance``."""
    report = t.orders.join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("customer_account"),
        F.col("r_name").alias("instance_key"),
        F.col("o_orderkey").cast("string").alias("claim_id"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("claim_status"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("stage"),
        F.concat(F.lit("own "), "o_orderstatus").alias("instance"),
    )
    path = write_report_csv(report, run_folder(t.spark, "csv"), "claims")
    reader = t.spark.read.schema(report.schema).option("header", True).option("escape", '"')
    return reader.option("recursiveFileLookup", True).csv(path)


@query(
    "scan_file_to_table",
    """SELECT table_name, r_name AS instance, count(*) AS lines
FROM (SELECT 'open_claims' AS table_name, o_custkey AS k FROM orders
  UNION ALL SELECT 'account_list', c_custkey FROM customer)
JOIN customer ON k = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def file_to_table(t: Tables) -> DataFrame:
    """Files of several instances and reports below one root, sorted by their path."""
    root = run_folder(t.spark, "tree")
    named = accounts(t)
    claims = t.orders.join(named, F.col("o_custkey") == F.col("c_custkey"))
    for report, df, key in (("Open Claims", claims, "o_orderkey"), ("account-list", named, "c_custkey")):
        write_report_csv(
            df.select(F.col("r_name").alias("instance_key"), key), root, report
        )
    lines = scan_lines_with_table(t.spark, root).filter(~F.col("line").startswith("instance_key,"))
    return (
        lines.withColumn("instance", F.split("line", ",")[0])
        .groupBy("table_name", "instance")
        .agg(F.count("*").alias("lines"))
    )


# ---- repeated header names ----------------------------------------------

_REPEATED = ["Charge Claim ID", "Status", "Charge Claim ID", "Cust/Key", "Status", "Charge Claim ID"]


def _repeated_header_files(t: Tables) -> str:
    path = run_folder(t.spark, "repeats") + "/report.csv"
    key = F.col("o_orderkey").cast("string")
    cells = [
        key,
        F.col("o_orderstatus"),
        F.concat(F.lit("x"), key),
        F.col("o_custkey").cast("string"),
        F.col("o_orderpriority"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("y"), key)),
    ]
    header = ",".join(f'"{h}"' for h in _REPEATED)
    write_files_with_header(t.orders, path, header, csv_line(cells), {"file": _file("o_orderkey")})
    return path


@query(
    "dedup_headers",
    """SELECT CAST(o_orderkey AS VARCHAR) AS charge_claim_id, o_orderstatus AS status,
  'x' || o_orderkey AS charge_claim_id_1, CAST(o_custkey AS VARCHAR) AS cust_key,
  o_orderpriority AS status_1, CASE WHEN o_orderkey % 3 <> 0 THEN 'y' || o_orderkey END
    AS charge_claim_id_2 FROM orders""",
)
def dedup_headers(t: Tables) -> DataFrame:
    """Repeated header names get running numbers."""
    return scan_report_csv(t.spark, _repeated_header_files(t), recursive=True)


_LAST = "CASE WHEN o_orderkey % 3 <> 0 THEN 'y' || o_orderkey ELSE '' END"


@query(
    "collapse_dup_headers",
    f"""SELECT {_LAST} AS charge_claim_id, o_orderpriority AS status, {_LAST} AS charge_claim_id_1,
  CAST(o_custkey AS VARCHAR) AS cust_key, o_orderpriority AS status_1, {_LAST} AS charge_claim_id_2
FROM orders""",
)
def collapse_dup_headers(t: Tables) -> DataFrame:
    """Repeated header names all show the last one's value."""
    path = _repeated_header_files(t)
    header = csv_header(t.spark, path, recursive=True)
    df = scan_report_csv(t.spark, path, names=column_names(header), recursive=True)
    return collapse_repeats(df, header)


@query(
    "profile_sources",
    """SELECT 'repeats' AS source, CAST(6 AS BIGINT) AS column_count,
  'Charge Claim ID.1, Status.1, Charge Claim ID.2' AS repeat_markers,
  'Charge Claim ID, Status, Charge Claim ID.1, Cust/Key, Status.1' AS first_columns,
  count(*) AS row_count FROM orders
UNION ALL SELECT 'noted', 4, '', 'Order Key, Cust/Key, Order Note (free), Total', count(*) FROM orders""",
)
def profile_sources(t: Tables) -> DataFrame:
    """Columns, repeat marks, first names and rows of two delivered reports."""
    noted = write_report_csv(_noted_orders(t), run_folder(t.spark, "csv"), "noted", instance=None)
    parts = []
    for source, path in (("repeats", _repeated_header_files(t)), ("noted", noted)):
        header = distinct_names(csv_header(t.spark, path, recursive=True))
        df = scan_report_csv(t.spark, path, names=header, recursive=True)
        parts.append(profile_source(df, source, header))
    return parts[0].unionAll(parts[1])


# ---- pipe lines ---------------------------------------------------------


@query(
    "scan_pipe_dat",
    """SELECT CAST(c_custkey AS VARCHAR) AS account, '"' || c_name AS name,
  CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS practice,
  CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS balance FROM customer""",
)
def pipe_dat(t: Tables) -> DataFrame:
    """A single quote sign does not swallow the fields after it."""
    path = run_folder(t.spark, "dat") + "/customer.dat"
    named = t.customer.select(
        F.col("c_custkey").alias("account"),
        F.concat(F.lit('"'), "c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("practice"),
        dec("c_acctbal").alias("balance"),
    )
    write_pipe_dat(named, path)
    return scan_pipe_dat(t.spark, path, named.columns)


@query(
    "sink_pipe_roundtrip",
    """SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus || '|' || o_orderpriority AS note,
  CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS c FROM orders""",
)
def pipe_csv(t: Tables) -> DataFrame:
    """With quoting, a pipe within a value survives."""
    path = run_folder(t.spark, "pipe")
    write_pipe_csv(
        t.orders.select(
            F.col("o_orderkey").alias("k"),
            F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("note"),
            F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")).alias("c"),
        ),
        path,
    )
    reader = t.spark.read.schema("k string, note string, c string").option("sep", "|")
    return reader.option("escape", '"').csv(path)


@query(
    "pipe_lines",
    """SELECT o_orderkey || '|' || o_orderstatus || '||' ||
  CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS value FROM orders""",
)
def raw_pipe_lines(t: Tables) -> DataFrame:
    """Lines without escaping; a column the frame lacks is an empty field."""
    df = t.orders.withColumn("c", F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")))
    return pipe_lines(df, ["o_orderkey", "o_orderstatus", "absent", "c"])


@query(
    "sink_sorted_line",
    """SELECT CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS VARCHAR) || '|' || s_name || '|' ||
  CASE WHEN s_nationkey % 3 <> 0 THEN CAST(s_nationkey AS VARCHAR) ELSE 'None' END || '|' ||
  s_suppkey AS value FROM supplier""",
)
def sorted_lines(t: Tables) -> DataFrame:
    df = t.supplier.select(
        "s_suppkey",
        "s_name",
        F.when(F.col("s_nationkey") % 3 != 0, F.col("s_nationkey")).alias("s_nationkey"),
        dec("s_acctbal").alias("s_acctbal"),
    )
    path = run_folder(t.spark, "sorted")
    write_sorted_lines(df, path)
    return t.spark.read.text(path)


def _ragged(t: Tables) -> DataFrame:
    """Lines of orders with a field too few, right, or a field too many."""
    kind = F.col("o_orderkey") % 10
    line = F.concat_ws("|", F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"))
    return t.orders.select(
        F.col("o_orderkey").alias("line_key"),
        F.when(kind == 1, F.concat_ws("|", F.col("o_orderkey"), F.col("o_custkey")))
        .when(kind == 2, F.concat_ws("|", line, F.lit("extra")))
        .when(kind == 3, F.concat(F.lit("  "), line, F.lit(" \t")))
        .when(kind == 4, F.concat_ws("|", F.col("o_orderkey"), F.lit(""), F.lit("F")))
        .otherwise(line)
        .alias("value"),
    )


@query(
    "repair_ragged_rows",
    """SELECT o_orderkey AS line_key, CAST(o_orderkey AS VARCHAR) AS claim_id,
  CASE WHEN o_orderkey % 10 <> 4 THEN CAST(o_custkey AS VARCHAR) END AS account,
  CASE o_orderkey % 10 WHEN 1 THEN NULL WHEN 4 THEN 'F' ELSE o_orderstatus END AS status,
  o_orderkey % 10 IN (1, 2) AS adjusted FROM orders""",
)
def repair_ragged_rows(t: Tables) -> DataFrame:
    repaired = repair_ragged(_ragged(t), ["claim_id", "account", "status"], keep=["line_key"])
    return repaired.withColumnRenamed("_adjusted", "adjusted")


_AUDIT = """SELECT 'orders' AS table_name, 'loaded' AS status, count(*) AS rows_loaded,
  count(*) FILTER (o_orderkey % 10 IN (1, 2)) AS rows_adjusted FROM orders
UNION ALL SELECT 'customers', 'loaded', count(*), 0 FROM customer
UNION ALL SELECT 'empty_one', 'empty', 0, 0 UNION ALL SELECT 'missing_one', 'failed', 0, 0"""


def _audit(t: Tables) -> DataFrame:
    customers = pipe_lines(t.customer, ["c_custkey", "c_name"])
    lines = (
        _ragged(t)
        .select(F.lit("orders").alias("table_name"), F.col("value").alias("line"))
        .unionAll(customers.select(F.lit("customers"), "value"))
    )
    widths = {"orders": 3, "customers": 2, "empty_one": 4, "missing_one": 4}
    return load_audit(t.spark, lines, widths, ["orders", "customers", "empty_one"])


@query("load_audit", _AUDIT)
def audit(t: Tables) -> DataFrame:
    return _audit(t)


@query(
    "load_audit_totals",
    f"""SELECT CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
  CAST(sum(rows_adjusted) AS BIGINT) AS rows_adjusted,
  count(*) FILTER (status <> 'failed') AS tables_processed,
  count(*) FILTER (status = 'failed') AS tables_failed FROM ({_AUDIT})""",
)
def totals(t: Tables) -> DataFrame:
    return audit_totals(_audit(t))


# ---- JSON ---------------------------------------------------------------


@query(
    "scan_json_report",
    """SELECT o_orderkey AS claim_id, o_orderstatus AS status, o_totalprice AS total,
  'C' || o_custkey AS customer_id FROM orders""",
)
def json_report(t: Tables) -> DataFrame:
    """Arrays of at most 100 objects, one array per line."""
    path = run_folder(t.spark, "json")
    objects = t.orders.select(
        F.floor(F.col("o_orderkey") / 100).alias("page"),
        F.struct(
            F.col("o_orderkey").alias("claim_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.col("o_custkey").alias("customer"),
        ).alias("object"),
    )
    pages = objects.groupBy("page").agg(F.to_json(F.collect_list("object")).alias("value"))
    pages.select("value").write.text(path)
    schema = "claim_id bigint, status string, total double, customer bigint"
    customer = F.concat(F.lit("C"), F.col("customer").cast("string"))
    return scan_json_report(t.spark, path, schema, customer, multi_line=False).drop("customer")


# ---- snapshots ----------------------------------------------------------

# A made-up table in the dialect of a snapshot's own script.
_CLAIM_DDL = """CREATE TABLE CLAIMS (
SEQNO NUMBER(19) PRIMARY KEY,
CUSTNO NUMBER(19),
STATUS CHAR(1),
AMOUNT NUMBER(12,2),
RECEIVED DATE,
ENTERED TIMESTAMP,
MEMO VARCHAR2(4000));"""


def _snapshot_root(t: Tables) -> str:
    """Snapshot folders per account and time; the files carry a header each."""
    root = run_folder(t.spark, "snapshots")
    header = "SEQNO\tCUSTNO\tSTATUS\tAMOUNT\tRECEIVED\tENTERED\tMEMO"
    stamp = time_label(F.lit("2025-04-16 14:15:25").cast("timestamp_ntz"))
    folder = F.concat(
        F.lit("A"), F.floor(F.col("o_orderkey") / ROWS_PER_FILE).cast("string"), F.lit("_"), stamp
    )
    cells = [
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderstatus"),
        dec("o_totalprice").cast("string"),
        F.when(F.col("o_orderkey") % 5 != 0, F.date_format("o_orderdate", "MM/dd/yyyy")),
        F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss"),
        F.concat(F.lit('"'), "o_orderpriority"),
    ]
    line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in cells])
    folders = {"snapshot": folder, "table": F.lit("CLAIMS")}
    write_files_with_header(t.orders, root, header, line, folders)
    return root


_SNAPSHOT_SQL = """CAST(o_orderkey AS DOUBLE) AS "SEQNO", CAST(o_custkey AS DOUBLE) AS "CUSTNO",
  o_orderstatus AS "STATUS", CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS "AMOUNT",
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "RECEIVED",
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "ENTERED", '"' || o_orderpriority AS "MEMO" """


def _scan_claims(t: Tables, with_lineage: bool) -> DataFrame:
    table = ddl_catalogue(_CLAIM_DDL)["CLAIMS"]
    return scan_snapshot(t.spark, _snapshot_root(t), table, with_lineage=with_lineage)


@query("scan_snapshot_tab", f"SELECT {_SNAPSHOT_SQL} FROM orders")
def snapshot_tab(t: Tables) -> DataFrame:
    """Tab-delimited snapshot files typed by the script they ship."""
    return _scan_claims(t, with_lineage=False)


@query(
    "snapshot_lineage",
    f"""SELECT 'A' || CAST(floor(o_orderkey / {ROWS_PER_FILE}) AS BIGINT) AS account,
  '2025-04-16 14:15:25' AS extracted_at, count(*) AS row_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS amount
FROM orders GROUP BY ALL""",
)
def snapshot_lineage(t: Tables) -> DataFrame:
    """Account and time of extract from the folder names, per snapshot."""
    return (
        _scan_claims(t, with_lineage=True)
        .groupBy("account", "extracted_at")
        .agg(F.count("*").alias("row_count"), F.sum("AMOUNT").alias("amount"))
    )


@query(
    "snapshot_catalogue_many",
    """SELECT upper(replace(n_name, ' ', '_')) AS table_name, k AS position, 'C' || k AS column_name,
  CASE k % 5 WHEN 0 THEN 'decimal(10,0)' WHEN 1 THEN 'decimal(12,2)' WHEN 2 THEN 'timestamp_ntz'
    WHEN 3 THEN 'string' ELSE 'date' END AS data_type,
  CASE WHEN k % 5 = 3 THEN k + 10 END AS max_length, k = 0 AND n_regionkey <> 3 AS is_key
FROM nation, (SELECT unnest(range(0, 40)) AS k) WHERE k <= n_nationkey + 5""",
)
def snapshot_catalogue_many(t: Tables) -> DataFrame:
    """Scripts of a table per nation, in a file per region, read as the registry of their columns."""
    k = F.col("k")
    kind = (
        F.when(k % 5 == 0, "NUMBER(10)")
        .when(k % 5 == 1, "NUMBER(12,2)")
        .when(k % 5 == 2, "TIMESTAMP")
        .when(k % 5 == 3, F.concat(F.lit("VARCHAR2("), (k + 10).cast("string"), F.lit(")")))
        .otherwise("DATE")
    )
    key = F.when((k == 0) & (F.col("n_regionkey") != 3), " PRIMARY KEY").otherwise("")
    columns = t.nation.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_nationkey") + 5))).select(
        "n_regionkey", "n_name", k.alias("k"), F.concat(F.lit("C"), k.cast("string"), F.lit(" "), kind, key).alias("line")
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), ",\n")
    tables = columns.groupBy("n_regionkey", "n_name").agg(body.alias("body"))  # at most 40 columns
    name = F.upper(F.replace("n_name", F.lit(" "), F.lit("_")))
    script = F.concat(F.lit("CREATE TABLE "), name, F.lit(" (\n"), "body", F.lit(");\n"))
    path = run_folder(t.spark, "ddl")
    tables.select("n_regionkey", script.alias("value")).write.partitionBy("n_regionkey").text(path)
    catalogue = read_catalogue(t.spark, path, pattern="*.txt", recursive=True)
    rows = [
        (table.name, i, f.name, f.dataType.simpleString(), f.metadata.get("max_length"), f.name == table.key)
        for table in catalogue.values()
        for i, f in enumerate(table.schema)
    ]
    schema = "table_name string, position bigint, column_name string, data_type string, max_length bigint, is_key boolean"
    return t.spark.createDataFrame(rows, schema)


# ---- envelopes ----------------------------------------------------------

_PER_ENVELOPE = 200


@query(
    "decode_envelope",
    f"""SELECT 'E' || CAST(floor(o_orderkey / {_PER_ENVELOPE}) AS BIGINT) AS account,
  CAST(o_orderkey AS VARCHAR) AS "Claim ID",
  CASE o_orderkey % 3 WHEN 0 THEN 'say "hi",' || chr(10) || 'bye' WHEN 1 THEN o_orderpriority END
    AS "Note", o_orderstatus AS "Claim ID.1" FROM orders""",
)
def decode_envelope(t: Tables) -> DataFrame:
    """Zipped CSV in XML, at most 200 records each, columns in one of two orders."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 3
    chunk = F.floor(key / _PER_ENVELOPE)
    note = (
        F.when(kind == 0, F.lit('say "hi",\nbye'))
        .when(kind == 1, F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))
        .otherwise(F.lit("  "))
    )
    swap = chunk % 2 == 1
    number, status = key.cast("string"), F.col("o_orderstatus")
    cells = F.when(swap, F.array(note, number, status)).otherwise(F.array(number, note, status))
    header = F.when(
        swap, F.array(F.lit("Note"), F.lit("Claim ID"), F.lit(" Claim ID"))
    ).otherwise(F.array(F.lit("Claim ID"), F.lit(" Note "), F.lit("Claim ID")))
    records = (
        t.orders.select(
            F.concat(F.lit("E"), chunk.cast("string")).alias("account"),
            header.alias("header"),
            F.struct(cells.alias("cells")).alias("record"),
        )
        .groupBy("account", "header")
        .agg(F.collect_list("record").alias("records"))
    )
    decoded = decode_envelopes(envelopes(records), "xml", ["account"])
    return records_by_name(decoded, ["Claim ID", "Note", "Claim ID"], keep=["account"])
