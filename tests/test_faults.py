"""What must not get lost: payloads, records, rows, columns, tables."""

import pytest
from pyspark.sql import functions as F

from revflow.functions.dates import parse_date
from revflow.operators.ledger import active_reports, registry_coverage, registry_gaps, upsert_ledger
from revflow.operators.quality import RuleViolation
from revflow.plans.fetch import UnreadablePayloads, chosen_payloads, delivered_headers, spool_reports
from revflow.plans.flat_load import load_flat_reports
from revflow.plans.load import load_reports, report_tables
from revflow.plans.report_layouts import REPORT_LAYOUTS
from revflow.plans.snapshot_load import load_snapshot
from revflow.sinks import tables as stored_tables
from revflow.sinks.files import write_report_csv
from revflow.sinks.tables import full_refresh, superseded_folders
from revflow.sources.envelopes import decode_with_faults, envelope_errors
from revflow.sources.reports import delivered_files, scan_report_csv
from revflow.sources.snapshots import ddl_catalogue, read_catalogue, scan_snapshot
from revflow.streaming.ledger_stream import compact_runs, start_ledger_stream, stored_runs, stream_ledger

from test_ledger import xml
from test_sources import HEADER, LINE, SCRIPT, envelope, put, rows

PAYLOADS = "customer_account string, instance_key string, report_name string, identifier string, xml string"


def payloads(spark, *extra):
    whole = [
        ("1", "i1", "open", "x1", envelope(a_csv="A,B\n1,2\n")),
        ("1", "i2", "open", "x2", envelope(a_csv="B,A,C\n4,3,5\n")),
    ]
    return spark.createDataFrame([*whole, *extra], PAYLOADS)


FAULTS = [
    ("2", "i1", "open", "x3", "<R><Data>"),
    ("3", "i1", "open", "x4", "<R><Data>***</Data></R>"),
    ("4", "i1", "open", "x5", "<R><Data>bm8gemlw</Data></R>"),
]


def test_unreadable_payloads_refuse_or_go_to_quarantine(spark, tmp_path):
    long = ("5", "i1", "open", "x6", envelope(a_csv="A,B\n1,2,3\n4,5\n"))
    found = payloads(spark, *FAULTS, long)
    errors = envelope_errors(found, "xml", ["customer_account"])
    assert {(r.customer_account, r.fault) for r in errors.collect()} == {
        ("2", "broken XML"), ("3", "broken base64"), ("4", "broken zip"), ("5", "record longer than its header"),
    }
    with pytest.raises(UnreadablePayloads, match="1 x broken zip"):
        spool_reports(found, str(tmp_path / "a"))
    paths = spool_reports(found, str(tmp_path / "b"), quarantine=str(tmp_path / "q"))
    spooled = scan_report_csv(spark, paths["open"], recursive=True)
    assert sorted(rows(spooled.select("customer_account", "a", "b"))) == [("1", "1", "2"), ("1", "3", "4"), ("5", "4", "5")]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 4


def test_header_is_that_of_the_lowest_account_and_the_rest_is_told(spark):
    decoded = decode_with_faults(payloads(spark).repartition(5), "xml", ["customer_account", "instance_key", "report_name"])
    assert rows(delivered_headers(decoded)) == [("open", ["A", "B"], ["C"])]


def test_cells_that_only_others_deliver_are_spooled(spark, tmp_path):
    others = [
        ("2", "i1", "open", "x3", envelope(a_csv="C,a,A,A,,customer_account\n5,6,7,8,9,10\n")),
        ("3", "i1", "open", "x4", envelope(a_csv="A,B\n1,2,3\n")),
    ]
    kept = str(tmp_path / "q")
    paths = spool_reports(payloads(spark, *others), str(tmp_path / "a"), quarantine=kept)
    written = spark.read.option("header", True).csv(paths["open"], recursiveFileLookup=True)
    assert written.columns == ["customer_account", "instance_key", "A", "B", "unnamed", "A.1", "C", "a.2", "customer_account.1"]
    assert sorted(rows(written)) == [
        ("1", "i1", "1", "2", None, None, None, None, None),
        ("1", "i2", "3", "4", None, None, "5", None, None),
        ("2", "i1", "7", None, "9", "8", "5", "6", "10"),
    ]
    assert rows(spark.read.parquet(kept).select("customer_account", "header", "fields")) == [("3", ["A", "B"], ["1", "2", "3"])]
    paths = spool_reports(payloads(spark, others[0]), str(tmp_path / "b"), by_position=True)
    written = spark.read.option("header", True).csv(paths["open"], recursiveFileLookup=True)
    assert written.columns[2:] == ["A", "B", "A.1", "A.2", "unnamed", "customer_account.1"]
    assert sorted(rows(written))[2][2:] == ("5", "6", "7", "8", "9", "10")


def test_runs_are_chosen_per_instance(spark):
    found = payloads(spark)
    ledger = found.select("customer_account", "instance_key", "report_name", "identifier").withColumns(
        {"sequence": F.monotonically_increasing_id(), "status": F.lit(1)}
    )
    assert chosen_payloads(found, ledger).count() == 2
    assert active_reports(ledger, per_instance=True).count() == 2 and active_reports(ledger).count() == 1
    half = active_reports(ledger.filter("instance_key = 'i1'"), per_instance=True)
    registry = ledger.select("customer_account", "report_name", "instance_key")
    assert {(r.instance_key, r.covered) for r in registry_coverage(registry, half).collect()} == {("i1", True), ("i2", False)}
    assert [r.instance_key for r in registry_gaps(registry, half).collect()] == ["i2"]
    assert registry_coverage(registry.drop("instance_key").distinct(), half).count() == 1


def test_rows_without_status_stay(spark):
    schema = "customer_account string, report_name string, instance_key string, identifier string, sequence bigint, status int"
    ledger = spark.createDataFrame([("a", "r", "i", "x1", 1, None), ("a", "r", "i", "x2", 2, 1)], schema)
    new = spark.createDataFrame([("a", "r", "i", "x3", 3)], schema.removesuffix(", status int"))
    after = {r.identifier: r.status for r in upsert_ledger(ledger, new).collect()}
    assert after == {"x1": None, "x2": 0, "x3": 1}


def test_new_checkpoint_keeps_the_store(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    assert stored_runs(spark, store).count() == 0
    schema = "customer_account string, report_name string, instance_key string, sequence bigint, response string"

    def land(n):
        spark.createDataFrame([("a", "r", "i", n, xml(identifier=f"x{n}"))], schema).write.mode("append").json(landing)

    land(1)
    start_ledger_stream(spark, landing, store, str(tmp_path / "c1")).awaitTermination()
    land(2)
    start_ledger_stream(spark, landing, store, str(tmp_path / "c2")).awaitTermination()
    assert {(r.identifier, r.status) for r in stream_ledger(spark, store).collect()} == {("x1", 0), ("x2", 1)}
    assert stored_runs(spark, store).count() == 2
    compact_runs(spark, store, str(tmp_path / "small"))
    assert sorted(rows(stream_ledger(spark, str(tmp_path / "small")))) == sorted(rows(stream_ledger(spark, store)))


@pytest.mark.parametrize("text, day", [("2024", None), ("2024-01", None), ("2024-01-05", "2024-01-05"), ("1/5/2024", "2024-01-05"), (" ", None), ("2024-01-05 10:00:00", "2024-01-05")])
def test_only_whole_days_are_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert rows(df.select(parse_date(F.col("d")).cast("string"))) == [(day,)]
    if day is None:
        with pytest.raises(Exception, match="not a date"):
            df.select(parse_date(F.col("d"), strict=True)).collect()


def test_csv_keeps_blanks_and_an_own_instance_column(spark, tmp_path):
    df = spark.createDataFrame([("k", " a ", "mine")], "instance_key string, v string, Instance string")
    path = write_report_csv(df, str(tmp_path), "r")
    back = spark.read.schema(df.schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    assert rows(back) == [("k", " a ", "mine")]


def test_partitioned_refresh_with_the_column_in_second_place(spark, tmp_path):
    df = spark.createDataFrame([("a", "i1", 1), ("b", "i2", 2)], "k string, instance_key string, v bigint")
    for _ in range(2):
        full_refresh(spark, {"second_x": df}, str(tmp_path), partition_by="instance_key")
    assert sorted(rows(spark.table("second_x"))) == [("a", 1, "i1"), ("b", 2, "i2")]


def test_entries_are_restored_when_pointing_fails(spark, tmp_path, monkeypatch):
    old = spark.createDataFrame([(1,)], "k bigint")
    full_refresh(spark, {"back_x": old, "back_y": old}, str(tmp_path))
    point, calls = stored_tables._point, []

    def failing(spark, table, *rest):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("catalogue is gone")
        return point(spark, table, *rest)

    monkeypatch.setattr(stored_tables, "_point", failing)
    with pytest.raises(RuntimeError):
        full_refresh(spark, {"back_x": old.selectExpr("k + 1 AS k"), "back_y": old.selectExpr("k + 1 AS k")}, str(tmp_path))
    assert rows(spark.table("back_x")) == rows(spark.table("back_y")) == [(1,)]


def test_superseded_folders_are_told(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k bigint")
    for n in range(3):
        full_refresh(spark, {"old_x": df.selectExpr(f"k + {n} AS k"), "old_y": df}, str(tmp_path))
    left = superseded_folders(spark, str(tmp_path), ["old_x", "old_y"]).collect()
    assert sorted(r.table_name for r in left) == ["old_x", "old_x", "old_y", "old_y"]
    assert {spark.read.parquet(r.folder).first().k for r in left if r.table_name == "old_x"} == {1, 2}
    assert rows(spark.table("old_x")) == [(3,)]


def test_refused_snapshot_leaves_no_rows(spark, tmp_path):
    put(tmp_path / "A_20250101_000000" / "ONE.DAT", f"{HEADER}\n{LINE}\n")
    put(tmp_path / "A_20250101_000000" / "TWO.DAT", "CODE\nx\n")
    catalogue = ddl_catalogue(SCRIPT)
    load_snapshot(spark, str(tmp_path), catalogue, str(tmp_path / "store"), "refused_")
    with pytest.raises(RuleViolation):
        load_snapshot(spark, str(tmp_path), catalogue, str(tmp_path / "store"), "refused_")
    assert spark.table("refused_one").count() == spark.table("refused_two").count() == 1


def test_snapshot_header_is_checked(spark, tmp_path):
    cells = HEADER.split("\t")
    turned = "\t".join([cells[1], cells[0], *cells[2:]])
    path = put(tmp_path / "ONE.DAT", f"{turned}\n{LINE}\n")
    table = ddl_catalogue(SCRIPT)["ONE"]
    with pytest.raises(Exception, match="(?i)header"):
        scan_snapshot(spark, path, table).collect()
    assert scan_snapshot(spark, path, table, check_header=False).count() == 1
    put(tmp_path / "c.sql", "CREATE TABLE B_CHARGE (SEQNO NUMBER(10) PRIMARY KEY, TRANID NUMBER(10));")
    with pytest.raises(ValueError, match="B_CHARGE"):
        read_catalogue(spark, str(tmp_path))


def test_absent_files_empty_their_tables(spark, tmp_path):
    layouts = {t: REPORT_LAYOUTS[t] for t in ("denial_trends", "rcm_productivity")}
    store = str(tmp_path / "store")
    put(tmp_path / "one" / "denial_trends.dat", "a|b\n")
    put(tmp_path / "one" / "rcm_productivity.dat", "a|b\nc\n")
    put(tmp_path / "two" / "rcm_productivity.dat", "d\n")
    load = lambda d, **o: {r.table_name: tuple(r)[1:] for r in load_flat_reports(spark, str(tmp_path / d), store, layouts, {}, "ab_", **o).collect()}
    assert load("one") == {"denial_trends": ("loaded", 1, 1), "rcm_productivity": ("loaded", 2, 2)}
    assert load("two", keep_absent=True) == {"denial_trends": ("failed", 0, 0), "rcm_productivity": ("loaded", 1, 1)}
    assert spark.table("ab_denial_trends").count() == 1
    load("two")
    assert spark.table("ab_denial_trends").count() == 0


def test_jobs_of_a_load_do_not_grow_with_files(spark, tmp_path):
    def jobs(folder, files):
        for i in range(files):
            put(tmp_path / folder / f"t{i}" / "sheet.csv", f"customer_account,instance_key,N,Odd\n{i},i{i},{i}.5,{'x' if i else 7}\n")
        group = f"count-{folder}"
        spark.sparkContext.setJobGroup(group, group)
        tables = report_tables(spark, str(tmp_path / folder))
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        assert tables["sheet"].count() == files
        return n, tables["sheet"]

    few, _ = jobs("few", 2)
    many, df = jobs("many", 12)
    assert few == many and dict(df.dtypes)["n"] == "double" and {r.odd for r in df.collect()} == {"7", "x"}


def test_one_odd_quote_keeps_no_other_file_from_being_split(spark, tmp_path):
    put(tmp_path / "a.csv", 'A,B\n1,5" tube\n')
    put(tmp_path / "b c.csv", "A,B\n1,2\n")
    flags = {r.table_name: (r.header_line, r.open_quotes) for r in delivered_files(spark, str(tmp_path)).collect()}
    assert flags == {"a": ("A,B", True), "b_c": ("A,B", False)}
    loaded = load_reports(spark, str(tmp_path), str(tmp_path / "store"), database="odd quotes")
    assert loaded.rows == {"odd_quotes.a": 1, "odd_quotes.b_c": 1}
