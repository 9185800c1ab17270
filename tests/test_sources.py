import base64
import io
import zipfile
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from revflow.plans.fetch import chosen_payloads, spool_reports
from revflow.sources import envelopes
from revflow.sources.envelopes import (
    broken_envelopes,
    decode_envelopes,
    records_by_name,
    records_by_position,
)
from revflow.sources.reports import (
    collapse_repeats,
    csv_header,
    discover_reports,
    has_line_breaks,
    repair_ragged,
    scan_json_report,
    scan_pipe_dat,
    scan_report_csv,
)
from revflow.sources.snapshots import (
    SNAPSHOT_KEYS,
    data_folder,
    ddl_catalogue,
    read_catalogue,
    scan_snapshot,
    snapshot_files,
    with_timestamps,
)
from revflow.workload import landing


def rows(df):
    return [tuple(r) for r in df.collect()]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def test_csv_with_quotes_breaks_and_na_words(spark, tmp_path):
    path = put(tmp_path / "x.csv", 'A b,A b,C/d\r\n"1,5","say ""x""",NA\r\n"two\nlines",,null\r\n')
    assert csv_header(spark, path) == ["A b", "A b", "C/d"]
    assert has_line_breaks(spark, path)
    df = scan_report_csv(spark, path)
    assert df.columns == ["a_b", "a_b_1", "c_d"]
    assert rows(df) == [("1,5", 'say "x"', None), ("two\nlines", None, None)]
    assert rows(scan_report_csv(spark, path, na_words=False))[0][2] == "NA"


def test_csv_without_breaks_is_split(spark, tmp_path):
    path = put(tmp_path / "x.csv", 'a,b\n1,"x ""y"""\n')
    assert not has_line_breaks(spark, path)
    assert rows(scan_report_csv(spark, path)) == [("1", 'x "y"')]


def test_short_and_long_csv_rows(spark, tmp_path):
    path = put(tmp_path / "x.csv", "a,b\n1\n1,2,3\n")
    assert rows(scan_report_csv(spark, path, long_records="cut")) == [("1", None), ("1", "2")]
    with pytest.raises(Exception, match="record longer than its header in .*x.csv: 1,2,3"):
        rows(scan_report_csv(spark, path))


def test_collapse_repeats(spark, tmp_path):
    path = put(tmp_path / "x.csv", "A,A,B\n1,2,3\n1,,3\n")
    df = scan_report_csv(spark, path)
    assert rows(collapse_repeats(df, csv_header(spark, path))) == [("2", "2", "3"), ("", "", "3")]


def test_discovery(spark, tmp_path):
    put(tmp_path / "one" / "Open Claims.csv", "a\n1\n")
    put(tmp_path / "two" / "open-claims.csv", "a\n1\n")
    put(tmp_path / "three" / "Payments.csv" / "instance=x" / "part-0.csv", "a\n1\n")
    put(tmp_path / "three" / "Payments.csv" / "instance=y" / "part-0.csv", "a\n1\n")
    found = rows(
        discover_reports(spark, str(tmp_path)).select("table_name", "files").orderBy("table_name")
    )
    assert found == [("open_claims", 1), ("open_claims", 1), ("payments", 2)]


def test_ragged_lines(spark):
    df = spark.createDataFrame(
        [("1|2",), ("1|2|3",), ("1|2|3|4",), (" 1||3 \t",), ("",), ('"1|2|3',)], "value string"
    )
    assert rows(repair_ragged(df, ["a", "b", "c"])) == [
        ("1", "2", None, True),
        ("1", "2", "3", False),
        ("1", "2", "3", True),
        ("1", None, "3", False),
        (None, None, None, True),
        ('"1', "2", "3", False),
    ]


def test_pipe_dat_reads_lf_and_crlf(spark, tmp_path):
    path = put(tmp_path / "x.dat", "1|a\r\n2|b\n")
    assert rows(scan_pipe_dat(spark, path, ["k", "v"])) == [("1", "a"), ("2", "b")]


def test_json_array_file(spark, tmp_path):
    path = put(tmp_path / "x.json", '[{"a": 1, "b": null},\n {"a": 2, "b": "x"}]')
    df = scan_json_report(spark, path, "a bigint, b string", F.lit("C1"))
    assert sorted(rows(df)) == [(1, None, "C1"), (2, "x", "C1")]


# ---- envelopes ----------------------------------------------------------


def envelope(**members):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as archive:
        for name, text in members.items():
            archive.writestr(name.replace("_", "."), text)
    return f"<R><Data>{base64.b64encode(blob.getvalue()).decode()}</Data></R>"


def test_envelopes(spark):
    good = envelope(a_csv=' A , B,A\r\n 1 ,"x\ny",3\r\n2\r\n', b_csv="", c_txt="A\n9\n")
    swapped = envelope(a_csv="B,A\nb,a\n")
    long = envelope(a_csv="A\n" + "z" * 200_000 + "\n")
    payloads = spark.createDataFrame(
        [
            ("g", good),
            ("s", swapped),
            ("z", long),
            ("n", "<R/>"),
            ("e", "<R><Data></Data></R>"),
            ("broken", "<R><Data>"),
            ("base", "<R><Data>***</Data></R>"),
        ],
        "id string, xml string",
    )
    assert {r.id for r in broken_envelopes(payloads, "xml").collect()} == {"broken", "base"}
    decoded = decode_envelopes(payloads, "xml", ["id"])
    named = records_by_name(decoded, ["A", "B", "A"], keep=["id"])
    assert named.columns == ["id", "A", "B", "A.1"]
    assert sorted(rows(named), key=str) == [
        ("g", "1", "x\ny", "3"),
        ("g", "2", None, None),
        ("s", "a", "b", None),
        ("z", "z" * 200_000, None, None),
    ]
    placed = records_by_position(decoded, ["x", "y"], keep=["id"])
    assert ("s", "b", "a") in rows(placed)


def test_spooling_of_active_runs(spark, tmp_path):
    rows_ = [
        ("1", "i1", "open", "x1", envelope(a_csv="A,B\n1,2\n")),
        ("1", "i1", "open", "x0", envelope(a_csv="A,B\n8,9\n")),
        ("2", "i2", "open", "x2", envelope(a_csv="B,A\n4,3\n")),
        ("2", "i2", "hollow", "x3", "<R/>"),
    ]
    payloads = spark.createDataFrame(
        rows_,
        "customer_account string, instance_key string, report_name string, identifier string, xml string",
    )
    ledger = payloads.select(
        "customer_account", "instance_key", "report_name", "identifier",
        F.lit(1).cast("bigint").alias("sequence"),
        F.when(F.col("identifier") == "x0", 0).otherwise(1).alias("status"),
    )
    paths = spool_reports(chosen_payloads(payloads, ledger), str(tmp_path))
    assert list(paths) == ["open"]
    first = csv_header(spark, paths["open"], recursive=True)
    assert first[:2] == ["customer_account", "instance_key"] and set(first[2:]) == {"A", "B"}
    df = scan_report_csv(spark, paths["open"], recursive=True)
    got = df.select("customer_account", "instance_key", "a", "b")
    assert sorted(rows(got)) == [("1", "i1", "1", "2"), ("2", "i2", "3", "4")]


# ---- snapshots ----------------------------------------------------------

SCRIPT = """CREATE TABLE ONE (
SEQNO NUMBER(10) PRIMARY KEY,
AMOUNT NUMBER(12,2),
SHARE_OF NUMBER,
DAY DATE,
AT TIMESTAMP,
FLAG CHAR(1),
MEMO VARCHAR2(4000));

CREATE TABLE TWO (
CODE VARCHAR(20));"""


def test_catalogue():
    tables = ddl_catalogue(SCRIPT)
    one = tables["ONE"]
    assert one.key == "SEQNO" and tables["TWO"].key is None
    assert [(f.name, f.dataType.simpleString()) for f in one.schema] == [
        ("SEQNO", "decimal(10,0)"),
        ("AMOUNT", "decimal(12,2)"),
        ("SHARE_OF", "decimal(38,10)"),
        ("DAY", "date"),
        ("AT", "timestamp_ntz"),
        ("FLAG", "string"),
        ("MEMO", "string"),
    ]
    assert one.schema["MEMO"].metadata == {"max_length": 4000}
    assert len(SNAPSHOT_KEYS) == 30 and sum(map(bool, SNAPSHOT_KEYS.values())) == 24


def test_text_stamps_get_their_type_back():
    stored = ddl_catalogue(SCRIPT.replace("AT TIMESTAMP", "AT_TEXT VARCHAR(100)"))["ONE"]
    vendor = ddl_catalogue(SCRIPT)["ONE"]
    typed = with_timestamps(stored, vendor, {"AT_TEXT": "AT"})
    assert isinstance(typed.schema["AT_TEXT"].dataType, T.TimestampNTZType)
    assert typed.key == "SEQNO"


HEADER = "SEQNO\tAMOUNT\tSHARE_OF\tDAY\tAT\tFLAG\tMEMO"
LINE = '1\t12.30\t0.5\t04/16/2025\t04/16/2025 14:15:25\tY\t"half'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_snapshot_scan(spark, tmp_path, end):
    folder = tmp_path / "A7_20250416_141525"
    put(folder / "meta" / "create.sql", SCRIPT)
    put(folder / "5 Customers" / "ONE.DAT", end.join([HEADER, LINE, "2\t\t\t\t\t\t", ""]))
    put(folder / "5 Customers" / "two.dat", end.join(["CODE", "x", ""]))
    found = snapshot_files(spark, str(tmp_path)).orderBy("table_name")
    assert [(r.table_name, r.account, r.extracted_at) for r in found.collect()] == [
        ("ONE", "A7", datetime(2025, 4, 16, 14, 15, 25)),
        ("TWO", "A7", datetime(2025, 4, 16, 14, 15, 25)),
    ]
    assert data_folder(found).first().folder.endswith("Customers")
    table = read_catalogue(spark, str(folder / "meta"))["ONE"]
    df = scan_snapshot(spark, found.first().data_path, table, with_lineage=True)
    stamp = datetime(2025, 4, 16, 14, 15, 25)
    assert sorted(rows(df), key=lambda r: r[0]) == [
        (1, Decimal("12.30"), Decimal("0.5"), date(2025, 4, 16), stamp, "Y", '"half', "A7", stamp),
        (2, None, None, None, None, None, None, "A7", stamp),
    ]


def test_snapshot_scan_refuses_bad_values(spark, tmp_path):
    path = put(tmp_path / "ONE.DAT", f"{HEADER}\nx\t1\t1\t\t\t\t\n")
    table = ddl_catalogue(SCRIPT)["ONE"]
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_snapshot(spark, path, table).collect()
    assert rows(scan_snapshot(spark, path, table, mode="PERMISSIVE"))[0][0] is None


def test_envelopes_are_made_and_opened_in_small_batches(monkeypatch):
    monkeypatch.setattr(landing, "_TEXT", 20_000)
    monkeypatch.setattr(envelopes, "_TEXT", 50_000)
    records = [{"cells": [str(k), "é" * (k % 500)]} for k in range(5000)]
    kinds = pa.schema(
        [("account", pa.string()), ("header", pa.list_(pa.string())), ("records", pa.list_(pa.struct([("cells", pa.list_(pa.string()))])))]
    )
    rows = [{"account": str(a), "header": ["a", "b"], "records": records if a == 3 else records[a : a + 20]} for a in range(150)]
    made = list(landing._zip(iter([pa.RecordBatch.from_pylist(rows, kinds)])))
    assert [a for b in made for a in b.column("account").to_pylist()] == [str(a) for a in range(150)]
    assert len(made) > 2 and max(b.num_rows for b in made) < 100
    blob = base64.b64decode(made[0].column("data")[3].as_py())
    given = pa.RecordBatch.from_pydict({"account": ["3"], "_zip": [blob], "_fault": pa.array([None], pa.string())})
    found = list(envelopes._unzip([("account", pa.string())])(iter([given])))
    assert max(b.nbytes for b in found) < 500_000
    assert [f for b in found for f in b.column("fields").to_pylist()] == [r["cells"] for r in records]


def test_workers_get_envelopes_in_batches_of_some_mb(spark):
    payloads = spark.createDataFrame([("1", "<Result/>")], "id string, xml string")
    decode_envelopes(payloads, "xml", ["id"])
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
