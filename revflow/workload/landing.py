"""Landing data derived from the tables in the formats of the readers under test."""

from __future__ import annotations

import base64
import csv
import io
import sys
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from revflow.session import bounded_batches

LINES_PER_FILE = 6_000_000  # some 200 MB: a file is still read in several splits
_RECORDS, _TEXT = 4096, 4 << 20  # records held as Python objects, and characters of a batch of envelopes

# The zip function travels to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def csv_line(cells: Sequence[Column]) -> Column:
    """Quoted CSV record of text columns; NULL is an empty field."""
    quote = F.lit('"')
    return F.concat_ws(
        ",",
        *[F.coalesce(F.concat(quote, F.replace(c, quote, F.lit('""')), quote), F.lit("")) for c in cells],
    )


def write_files_with_header(
    df: DataFrame, path: str, header: str, line: Column, folders: dict[str, Column]
) -> None:
    """One text file per folder, the header line first.

    A folder of more than ``LINES_PER_FILE`` lines gets a folder of its own for each of its files (``piece``), so that a task
    sorts and writes the lines of few files, however many rows there are. Lines are dealt to files by what they hold, the same
    way if a task is run again.
    """
    names = list(folders)
    rows = df.select(*[c.alias(n) for n, c in folders.items()], line.alias("value"))
    counted = rows.groupBy(*names).agg(F.count("*").alias("lines"))
    most, total = counted.agg(F.max("lines"), F.sum("lines")).first()
    parts = names
    heads = counted.select(*names, F.lit(header).alias("value"))
    if most is not None and most > LINES_PER_FILE:
        files = F.ceil(F.col("lines") / LINES_PER_FILE)
        large = counted.filter(F.col("lines") > LINES_PER_FILE).select(*[F.col(n).alias(f"_{n}") for n in names], files.alias("_files"))
        same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
        piece = F.coalesce(F.pmod(F.xxhash64("value"), "_files"), F.lit(0))
        rows = rows.join(F.broadcast(large), same, "left").select(*names, piece.alias("piece"), "value")
        heads = counted.select(*names, F.explode(F.sequence(F.lit(0).cast("long"), files - 1)).alias("piece"), F.lit(header).alias("value"))
        parts = [*names, "piece"]
    # of many files, a task has one, seldom two
    wide = 8 * -(-(total or 0) // LINES_PER_FILE)
    dealt = [wide] if wide > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    names = parts
    heads = heads.select(*names, F.lit(0).alias("rank"), "value")
    (
        heads.unionAll(rows.select(*names, F.lit(1).alias("rank"), "value"))
        .repartition(*dealt, *names)
        .sortWithinPartitions(*names, "rank")
        .drop("rank")
        .write.partitionBy(*names)
        .text(path)
    )


def _envelope(header: Sequence[str], records: pa.Array) -> str:
    """Base64 of the zip of one account; some records at a time become Python objects."""
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
        with archive.open("report.csv", "w") as raw, io.TextIOWrapper(raw, encoding="utf-8", newline="") as text:
            writer = csv.writer(text)
            writer.writerow(header)
            for start in range(0, len(records), _RECORDS):
                writer.writerows(r["cells"] for r in records.slice(start, _RECORDS).to_pylist())
        archive.writestr("empty.csv", "")
        archive.writestr("notes.txt", "no data")
    return base64.b64encode(blob.getvalue()).decode()


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One envelope at a time, given out by some MB."""

    def given(batch: pa.RecordBatch, start: int, out: list[str]) -> pa.RecordBatch:
        accounts = batch.column("account").slice(start, len(out))
        return pa.RecordBatch.from_pydict({"account": accounts, "data": pa.array(out, pa.string())})

    for batch in batches:
        start, out, size = 0, [], 0
        for row in range(batch.num_rows):
            out.append(_envelope(batch.column("header")[row].as_py(), batch.column("records")[row].values))
            size += len(out[-1])
            if size >= _TEXT:
                yield given(batch, start, out)
                start, out, size = row + 1, [], 0
        yield given(batch, start, out)


def envelopes(records: DataFrame) -> DataFrame:
    """(account, xml) from (account, header, records): one zip per row.

    Every tenth account also gets an envelope without data.
    """
    bounded_batches(records.sparkSession)
    zipped = records.mapInArrow(_zip, "account string, data string")
    full = F.concat(F.lit("<Result><Data>"), "data", F.lit("</Data></Result>"))
    hollow = F.when(F.pmod(F.xxhash64("account"), F.lit(10)) == 0, F.array(F.lit("<Result/>")))
    both = F.concat(F.array(full), F.coalesce(hollow, F.array().cast("array<string>")))
    return zipped.select("account", F.explode(both).alias("xml"))
