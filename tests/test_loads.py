import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Observation, functions as F

from revflow.operators.quality import RuleViolation, SchemaMismatch
from revflow.plans import marts
from revflow.plans.flat_load import load_flat_reports
from revflow.plans.load import load_reports, report_tables
from revflow.plans.publish import register_marts, run_sql_scripts, statements
from revflow.plans.report_layouts import REPORT_LAYOUTS
from revflow.plans.snapshot_load import load_snapshot
from revflow.sinks.files import sorted_line, write_pipe_csv, write_report_csv
from revflow.sinks.tables import (
    append_unique,
    create_if_absent,
    drop_tables,
    full_refresh,
    row_counts,
)
from revflow.sources.reports import scan_report_csv
from revflow.sources.snapshots import ddl_catalogue
from revflow.streaming.ledger_stream import start_ledger_stream, stream_ledger

from test_ledger import xml
from test_sources import HEADER, LINE, SCRIPT, put, rows


# ---- files --------------------------------------------------------------


def test_csv_folder_per_instance(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "I 1", 'x "y", z'), ("b", "I/2", None)], "customer_account string, instance_key string, v string"
    )
    path = write_report_csv(df, str(tmp_path), "My Report")
    assert len(list((tmp_path / "My Report.csv").glob("instance=*"))) == 2
    assert sorted(rows(scan_report_csv(spark, path, recursive=True)), key=str) == [
        ("a", "I 1", 'x "y", z'),
        ("b", "I/2", None),
    ]
    write_report_csv(df.limit(0), str(tmp_path), "None")
    assert not list((tmp_path / "None.csv").glob("**/*.csv"))


def test_sorted_line(spark):
    df = spark.createDataFrame([(1, None, "x")], "b int, a string, c string")
    assert rows(df.select(sorted_line(df))) == [("None|1|x",)]


def test_pipe_csv_keeps_pipes(spark, tmp_path):
    df = spark.createDataFrame([("a|b", '"q')], "x string, y string")
    write_pipe_csv(df, str(tmp_path / "x"))
    back = spark.read.schema(df.schema).option("sep", "|").option("escape", '"').csv(str(tmp_path / "x"))
    assert rows(back) == [("a|b", '"q')]


# ---- tables -------------------------------------------------------------


def test_refresh_is_all_or_nothing(spark, tmp_path):
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    store = str(tmp_path)
    assert full_refresh(spark, {"aon_x": good, "aon_y": good}, store, {"aon_x": ["k"]}) == {
        "aon_x": 2,
        "aon_y": 2,
    }
    other = good.withColumn("v", F.lit("new"))
    with pytest.raises(SchemaMismatch):
        full_refresh(spark, {"aon_x": other, "aon_y": good.drop("v")}, store)
    with pytest.raises(RuleViolation):
        full_refresh(spark, {"aon_y": other, "aon_x": other.union(other)}, store, {"aon_x": ["k"]})
    for name in ("aon_x", "aon_y"):
        assert sorted(rows(spark.table(name))) == [(1, "a"), (2, "b")]
    reads_itself = spark.table("aon_x").withColumn("k", F.col("k") + 10)
    full_refresh(spark, {"aon_x": reads_itself}, store)
    assert sorted(rows(spark.table("aon_x"))) == [(11, "a"), (12, "b")]
    assert sorted(rows(row_counts(spark, ["aon_x", "aon_y"]))) == [("aon_x", 2), ("aon_y", 2)]
    drop_tables(spark, ["aon_x", "aon_y", "aon_never"])
    assert not spark.catalog.tableExists("aon_x")


def test_partitioned_refresh(spark, tmp_path):
    df = spark.createDataFrame([(1, "i1"), (2, "i2")], "k bigint, instance_key string")
    for _ in range(2):
        full_refresh(spark, {"part_x": df}, str(tmp_path), partition_by="instance_key")
    assert sorted(rows(spark.table("part_x").filter("instance_key = 'i2'"))) == [(2, "i2")]


def test_append_refuses_repeats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    create_if_absent(spark, "app_x", df, str(tmp_path))
    create_if_absent(spark, "app_x", df, str(tmp_path))
    append_unique(spark, "app_x", df, ["k"], staging=str(tmp_path / "stage"))
    for bad in (df, df.filter("k = 1").selectExpr("7 as k", "v").unionAll(df.selectExpr("7", "v"))):
        with pytest.raises(RuleViolation):
            append_unique(spark, "app_x", bad, ["k"])
    append_unique(spark, "app_x", df.selectExpr("k + 5 as k", "v"), ["k"])
    assert sorted(rows(spark.table("app_x"))) == [(1, "a"), (2, "b"), (6, "a"), (7, "b")]


# ---- publishing ---------------------------------------------------------


def test_statements():
    script = "-- first\nSELECT 1;\n\n-- only words\n  -- more;\n SELECT 2 -- x\n;"
    assert statements(script) == ["-- first\nSELECT 1", "SELECT 2 -- x"]


def test_scripts_run_by_name_and_stop(spark, tmp_path):
    put(tmp_path / "b.sql", "CREATE OR REPLACE TEMP VIEW two AS\nSELECT x + 1 AS x\n-- from one, the first\nFROM one;")
    put(tmp_path / "a.sql", "CREATE OR REPLACE TEMP VIEW one AS SELECT 1 AS x; -- done")
    put(tmp_path / "notes.txt", "SELECT nothing")
    assert run_sql_scripts(spark, str(tmp_path)) == ["a.sql", "b.sql"]
    assert rows(spark.table("two")) == [(2,)]
    put(tmp_path / "aa.sql", "SELECT * FROM no_such_thing; CREATE TEMP VIEW three AS SELECT 1")
    with pytest.raises(Exception, match="no_such_thing"):
        run_sql_scripts(spark, str(tmp_path))
    assert not spark.catalog.tableExists("three")


AR = {
    "customer_account": "1", "instance_key": "i", "charge_id": "c1", "claim_id": "k1",
    "claim_first_billed_date": None, "charge_from_date": None, "charge_to_date": None,
    "charge_entered_date": None, "charge_primary_payer_name": "Payer", "charge_primary_payer_id": "",
    "practice_name": "P", "patient_full_name": "Doe, J (12)", "patient_id": "7",
    "charge_cpt_code": "", "charge_cpt_description": "", "revenue_code": "",
    "charge_fromdate_age": "", "charge_fromdate_age_days": "", "charge_first_bill_date_age": "",
    "charge_first_bill_date_age_days": "", "charge_balance": "$1.00",
    "charge_balance_due_ins": "$1,000.50", "charge_balance_due_other": "2",
    "charge_balance_due_pat": "", "charge_balance_at_collections": "",
    "charge_insurance_payments": "", "charge_patient_payments": "", "charge_total_payments": "",
    "patient_stmts_sent_electronically": "2", "patient_statements_printed": "1",
}


def test_ar_aging_counts_rejects_and_strict_raises(spark):
    report = spark.createDataFrame(
        [tuple(AR.values())], ", ".join(f"{c} string" for c in AR)
    )
    payers = spark.createDataFrame(
        [("Payer", "X1"), ("Payer", "X2"), ("payer", "X3")], "payer_name string, payer_code string"
    )
    seen = Observation()
    out = marts.ar_aging(report, payers, rejects=seen).collect()
    assert sorted(r.payer_code for r in out) == ["X1", "X2"]
    row = out[0]
    assert row.patient_full_name == "Doe, J" and row.office_name == row.facility_name == "P"
    assert row.balance_due_payer == Decimal("1002.50") and row.int_charge_balance_due_pat is None
    assert (row.total_statements, row.total_statement_buckets) == (3, "3-4 statements")
    assert seen.get["charge_balance_due_pat"] == 1 and seen.get["charge_balance_due_ins"] == 0
    assert "instance_key" not in row and len(row) == 41
    with pytest.raises(Exception, match="not a number"):
        marts.ar_aging(report, payers, strict=True).collect()


def test_held_charges_grouping(spark):
    rows_ = [("p", "f1", "s", "c", "$1.00", "i"), ("p", "f2", "s", "c", "$2.00", "i")]
    df = spark.createDataFrame(
        rows_,
        "practice_name string, facility_name string, claim_status string, charge_cpt_code string, "
        "charge_amount string, instance_key string",
    )
    assert sorted(rows(marts.charges_on_hold(df))) == [
        ("p", "s", "c", Decimal("1.00"), "i"),
        ("p", "s", "c", Decimal("2.00"), "i"),
    ]
    assert rows(marts.charges_on_hold(df.drop("facility_name"))) == [
        ("p", "s", "c", Decimal("3.00"), "i")
    ]


# ---- loads --------------------------------------------------------------


def test_load_reports(spark, tmp_path):
    head = "customer_account,instance_key,Practice Name,Claim Status,Charge CPT Code,Charge Amount"
    put(tmp_path / "in" / "one" / "charges_on_hold.csv",
        f"{head},Empty\n12,i1,P,Held,90853,\"$1,000.00\",\n12,i1,P,Held,90853,$1.50,NA\n")
    put(tmp_path / "in" / "two" / "Charges-On Hold.csv", f"{head},Extra\n13,i2,Q,Held,H0015,,9\n")
    put(tmp_path / "in" / "one" / "gross.csv", "customer_account,Paid Date\n1,1/5/2024\n2,\n")
    tables = report_tables(spark, str(tmp_path / "in"))
    held = tables["charges_on_hold"]
    assert held.columns == [
        "customer_account", "instance_key", "practice_name", "claim_status", "charge_cpt_code",
        "charge_amount", "empty",
    ]
    assert {r[6] for r in held.collect()} == {""}
    assert dict(tables["gross"].dtypes) == {"customer_account": "bigint", "paid_date": "date"}
    assert date(2024, 1, 5) in {r.paid_date for r in tables["gross"].collect()}
    loaded = load_reports(spark, str(tmp_path / "in"), str(tmp_path / "store"), database="Load Test")
    assert loaded.views == ["chage_on_hold", "v_charges_on_hold"]
    assert loaded.rows == {"load_test.charges_on_hold": 3, "load_test.gross": 2}
    assert sorted(rows(spark.table("v_charges_on_hold"))) == [
        ("P", "Held", "90853", Decimal("1001.50"), "i1"),
        ("Q", "Held", "H0015", None, "i2"),
    ]
    put(tmp_path / "in" / "one" / "gross.csv", "customer_account,Other\n1,1/5/2024\n")
    with pytest.raises(SchemaMismatch):
        load_reports(spark, str(tmp_path / "in"), str(tmp_path / "store"), database="Load Test")
    assert spark.table("load_test.gross").count() == 2


def test_delivered_report_is_conformed(spark, tmp_path):
    """One listed column is missing, one is delivered twice, one is unknown."""
    put(
        tmp_path / "Write-off Trend.csv",
        "Patient Total Credits,Patient Ins Credits,Patient Total Credits,customer_account,"
        "instance_key,New Thing\n1,2,3,4,i,x\n",
    )
    df = report_tables(spark, str(tmp_path))["write_off_trend"]
    assert df.columns == [
        "customer_account", "instance_key", "patient_total_credits", "patient_ins_credits",
        "patient_credits", "patient_total_credits_1", "patient_total_credits_1_1", "new_thing",
    ]
    assert rows(df) == [(4, "i", 1, 2, "", 1, 3, "x")]


def test_register_marts_with_own_crosswalk(spark, tmp_path):
    columns = (
        "customer_account instance_key practice_name charge_primary_payer_name "
        "charge_primary_payer_name_1 charge_patient_id charge_id charge_claim_id "
        "patient_full_name primary_payer_member_id charge_from_date charge_to_date type_of_bill "
        "charge_cpt_code charge_units_sum charge_amount charge_current_payer_name claim_status"
    ).split()
    df = spark.createDataFrame([tuple("x" for _ in columns)], ", ".join(f"{c} string" for c in columns))
    df = df.selectExpr(
        "*", "126L as charge_rev_code", "date'2024-12-20' as charge_entered_date",
        "'12/30/2024' as claim_first_billed_date",
    )
    df.createOrReplaceTempView("gross_billing")
    views = register_marts(spark, as_of=F.lit("2025-01-01").cast("date"))
    row = spark.table("gross_billing_view").first()
    assert "gross_billing_view" in views and row.loc == "DTX"
    assert (row.days_on_hold, row.days_on_hold_range, row.charge_lag) == (12, "11-14 days", 10)
    assert (row.claim_first_billed_week, row.claim_first_billed_ym) == ("Week01", "December 2024")
    assert row.first_billed_week_date == date(2024, 12, 29) and row.int_charge_amount is None
    spark.createDataFrame([(126, "own")], "rev_code int, level_of_care string").createOrReplaceTempView(
        "loc_crosswalk"
    )
    register_marts(spark)
    assert spark.table("gross_billing_view").first().loc == "own"
    for view in ("gross_billing", "gross_billing_view", "loc_crosswalk"):
        spark.catalog.dropTempView(view)


def test_layouts():
    assert {t: len(s) for t, s in REPORT_LAYOUTS.items()} == {
        "ar_aging": 32, "charges_on_hold": 26, "claim_stage_breakdown": 21, "denial_trends": 22,
        "gross_billing": 22, "payment_trend": 31, "quadrant_performance": 39, "rcm_productivity": 8,
    }


def test_flat_load(spark, tmp_path):
    put(tmp_path / "rcm_productivity.dat", "1|u|3|k|d|d|d|open\n2|v\n")
    put(tmp_path / "denial_trends.dat", "")
    audit = load_flat_reports(spark, str(tmp_path), str(tmp_path / "store"), prefix="fl_")
    status = {r.table_name: (r.status, r.rows_loaded, r.rows_adjusted) for r in audit.collect()}
    assert status["rcm_productivity"] == ("loaded", 2, 1)
    assert status["denial_trends"] == ("empty", 0, 0) and status["ar_aging"] == ("failed", 0, 0)
    assert spark.table("fl_rcm_productivity").filter("claim_status is null").count() == 1
    put(tmp_path / "rcm_productivity.dat", "1|u|3|k|more than twenty characters|d|d|open\n")
    with pytest.raises(RuleViolation, match="last_note_date_max"):
        load_flat_reports(spark, str(tmp_path), str(tmp_path / "store"), prefix="fl_")
    assert spark.table("fl_rcm_productivity").count() == 2


def test_snapshot_load(spark, tmp_path):
    folder = tmp_path / "A_20250416_141525"
    put(folder / "ONE.DAT", f"{HEADER}\n{LINE}\n")
    put(folder / "two.dat", "CODE\nx\nx\n")
    args = (spark, str(folder), ddl_catalogue(SCRIPT), str(tmp_path / "store"), "snl_")
    assert sorted(rows(load_snapshot(*args))) == [("snl_one", 1), ("snl_two", 2)]
    with pytest.raises(RuleViolation, match="unique"):
        load_snapshot(*args)
    assert spark.table("snl_one").count() == 1


# ---- stream -------------------------------------------------------------


def land(folder, name, *responses):
    lines = [
        {"customer_account": "a", "report_name": "r", "instance_key": "i", "sequence": n, "response": x}
        for n, x in responses
    ]
    put(folder / name, "\n".join(map(json.dumps, lines)))


def test_stream_resumes_and_ignores_known_runs(spark, tmp_path):
    landing, store, checkpoint = (tmp_path / n for n in ("landing", "store", "checkpoint"))

    def take_in():
        start_ledger_stream(spark, str(landing), str(store), str(checkpoint), 1).awaitTermination()
        found = stream_ledger(spark, str(store)).collect()
        return {(r.identifier, r.sequence, r.status) for r in found}

    land(landing, "1.json", (1, xml(identifier="x1")), (2, "<broken"), (3, xml(status="FAIL")))
    assert take_in() == {("x1", 1, 1)}
    land(landing, "2.json", (4, xml(identifier="x2")), (5, xml(identifier="x1")))
    land(landing, "3.json", (6, xml(identifier="x2")), (7, xml(message="still running")))
    assert take_in() == {("x1", 1, 0), ("x2", 4, 1)}
    assert take_in() == {("x1", 1, 0), ("x2", 4, 1)}
    land(landing, "4.json", (3, xml(identifier="x2")), (2, xml(identifier="x3")))
    assert take_in() == {("x1", 1, 0), ("x2", 3, 1), ("x3", 2, 0)}
