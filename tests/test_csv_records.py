"""Records over line ends in many splits, and records that do not fit their header."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from revflow.sources import csv_records as r
from revflow.sources.reports import scan_report_csv
from revflow.workload import landing


def write(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerows(rows)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(out.getvalue().encode())


def odd_rows(n, seed):
    rng = random.Random(seed)
    texts = ["plain", 'a 5" tube', 'say "hi"', "two\nlines", 'a "quoted\nline", ends', "\n\n", "comma, here", "x" * 300 + "\n" + "y" * 300, "", '"', "é\r\nü"]
    return [[str(i), rng.choice(texts), rng.choice(texts) + str(i)] for i in range(n)]


@pytest.fixture
def small_splits(spark):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
    spark.conf.set("spark.sql.files.openCostInBytes", kept[1])


@pytest.mark.parametrize("small", [100_000, 0])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_splits_equal_the_whole_file(spark, tmp_path, small_splits, monkeypatch, small, end):
    monkeypatch.setattr(r, "_SMALL", small)
    wanted = []
    for i in range(3):
        rows = odd_rows(120, i)
        write(tmp_path / f"f{i}.csv", [["id", "a", "b"], *rows], end)
        wanted += rows
    paths = [str(tmp_path / f"f{i}.csv") for i in range(3)]
    assert spark.read.text(paths).rdd.getNumPartitions() > 20
    df = r.refusing(r.scan_with_faults(spark, paths, ["id", "a", "b"], True))
    found = sorted(tuple(x or "" for x in row) for row in df.collect())
    assert found == sorted(map(tuple, wanted))


def test_a_field_longer_than_splits(spark, tmp_path, small_splits):
    long = "\n".join("line %d" % i for i in range(1000))
    write(tmp_path / "f.csv", [["a", "b"], ["1", "x"], ["2", long], ["3", "y\nz"], ["4", ""]])
    df = r.refusing(r.scan_with_faults(spark, str(tmp_path / "f.csv"), ["a", "b"], True))
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", long), ("3", "y\nz"), ("4", None)]


TEXT = 'a,b\n1,2\n3,4,EXTRA\n5\n"6","x,y","z ""q"""\n,\n7,\n'


LINES = ['a,b', 'a,"b', '"a', '"a"', 'a"b,c', 'a,"b""c', '"a""', '"a"",b', 'x","y', 'x",y', 'x"', '"x,y', 'x""y', '""', ',', ',"', 'a" b,"c', '"a"b,"c']


def state(line, inside):
    """The line's characters one by one."""
    at_field = not inside
    i = 0
    while i < len(line):
        c = line[i]
        if inside and c == '"':
            if line[i + 1 : i + 2] == '"':
                i += 1
            else:
                inside, at_field = False, False
        elif not inside and c == '"' and at_field:
            inside = True
        elif not inside:
            at_field = c == ","
        i += 1
    return inside


def test_lines_act_in_two_ways(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "line string")
    found = df.select("line", r.leaves_open(F.col("line"), False), r.leaves_open(F.col("line"), True)).collect()
    assert [tuple(x) for x in found] == [(x, state(x, False), state(x, True)) for x in LINES]


def test_quotes_within_fields_are_text(spark, tmp_path, small_splits):
    """Quotes that begin no field, in files that have line breaks elsewhere too."""
    lines = [f'{i},{i}" tube' if i % 3 else f'{i},"two\nlines {i}"' for i in range(300)]
    (tmp_path / "f.csv").write_text("a,b\n" + "\n".join(lines) + "\n")
    df = r.refusing(r.scan_with_faults(spark, str(tmp_path / "f.csv"), ["a", "b"], True))
    wanted = {(str(i), f'{i}" tube' if i % 3 else f"two\nlines {i}") for i in range(300)}
    assert set(map(tuple, df.collect())) == wanted


@pytest.mark.parametrize("line_breaks", [False, True])
def test_long_and_short_records(spark, tmp_path, line_breaks):
    (tmp_path / "f.csv").write_text(TEXT + ('8,"two\nlines"\n9,"two\nlines",more\n' if line_breaks else ""))
    df = r.scan_with_faults(spark, str(tmp_path / "f.csv"), ["a", "b"], line_breaks)
    faults = {(x.reason, x.text, tuple(x.fields)) for x in r.faults_of(df).collect()}
    wanted = {(r.LONG, "3,4,EXTRA", ("3", "4", "EXTRA")), (r.LONG, '"6","x,y","z ""q"""', ('"6"', '"x,y"', '"z ""q"""'))}
    if line_breaks:
        wanted.add((r.LONG, '9,"two\nlines",more', ("9", '"two\nlines"', "more")))
    assert faults == wanted
    kept = df.filter(~r.is_refused(F.col(r.FAULT))).select("a", "b", f"{r.FAULT}.reason")
    rows = {("1", "2", None), ("5", None, r.SHORT), (None, None, None), ("7", None, None)} | ({("8", "two\nlines", None)} if line_breaks else set())
    assert set(map(tuple, kept.collect())) == rows
    with pytest.raises(Exception, match="record longer than its header"):
        r.refusing(df).select("a").collect()


def test_a_quote_that_is_never_closed(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text('a,b\n1,2\n3,"open\n' + "4,5\n" * 400)
    df = r.scan_with_faults(spark, str(tmp_path / "f.csv"), ["a", "b"], True)
    assert [x.reason for x in r.faults_of(df).collect()] == [r.OPEN]
    with pytest.raises(Exception, match="quote not closed"):
        r.refusing(df).count()
    (tmp_path / "g.csv").write_text("a,b\n")
    assert r.refusing(r.scan_with_faults(spark, str(tmp_path / "g.csv"), ["a", "b"], True)).collect() == []


def test_a_folder_of_many_lines_gets_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_FILE", 40)
    df = spark.range(1000).selectExpr("id", "CASE WHEN id < 700 THEN 'a' WHEN id < 710 THEN 'b' END AS place")
    path = f"{tmp_path}/out"
    landing.write_files_with_header(df, path, "Key", F.col("id").cast("string"), {"part": F.col("place")})
    files = [f.read_text().splitlines() for f in tmp_path.rglob("*.txt")]
    assert all(lines[0] == "Key" for lines in files) and max(map(len, files)) < 100
    assert sorted(int(x) for lines in files for x in lines[1:]) == list(range(1000))
    found = scan_report_csv(spark, path, ["key"], multi_line=True, recursive=True)
    assert sorted(int(x.key) for x in found.collect()) == list(range(1000))
