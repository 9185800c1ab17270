"""Result envelopes: XML around base64 around a zip of CSV members.

Spark reads the XML and the base64. Only the zip needs Python: one envelope
at a time is opened in an Arrow task and its records are streamed out in
batches bounded in rows and text, so a task holds one batch of envelopes of some MB, one zip and one batch of
records, never a whole table.
"""

from __future__ import annotations

import csv
import io
import sys
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from revflow.functions.names import distinct_names
from revflow.functions.text import trim_all, trim_to_null
from revflow.functions.xml import elements, is_broken
from revflow.session import bounded_batches

_BATCH, _TEXT = 4096, 4 << 20  # records and characters of a batch

# The functions below travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _members(blob: bytes) -> Iterator[tuple[str | None, list[str] | None, list[str] | None, str | None]]:
    """(member, header, fields, fault) of every record of the CSV members.

    What cannot be read ends its member with one row that names the fault; a
    record with more fields than its header is a fault of its own.
    """
    csv.field_size_limit(2**31 - 1)  # whole texts, also beyond the default 128 KiB
    try:
        archive = zipfile.ZipFile(io.BytesIO(blob))
    except zipfile.BadZipFile:
        yield None, None, None, "broken zip"
        return
    with archive:
        for info in archive.infolist():
            if not info.filename.endswith(".csv"):
                continue
            try:
                with archive.open(info) as raw:
                    records = csv.reader(io.TextIOWrapper(raw, encoding="utf-8", newline=""))
                    header = next(records, None)
                    for fields in records if header is not None else ():
                        fault = "record longer than its header" if len(fields) > len(header) else None
                        yield info.filename, header, fields, fault
            except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
                yield info.filename, None, None, "broken zip member"
            except UnicodeDecodeError:
                yield info.filename, None, None, "text is not UTF-8"
            except csv.Error:
                yield info.filename, None, None, "broken CSV"


def _unzip(id_fields: list[tuple[str, pa.DataType]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                *id_fields,
                ("member", pa.string()),
                ("header", pa.list_(pa.string())),
                ("fields", pa.list_(pa.string())),
                ("fault", pa.string()),
            ]
        )
        for batch in batches:
            for row in range(batch.num_rows):
                ids = [batch.column(name)[row].as_py() for name, _ in id_fields]
                blob, fault = batch.column("_zip")[row].as_py(), batch.column("_fault")[row].as_py()
                rows, size = [], 0
                for record in _members(blob) if fault is None else [(None, None, None, fault)]:
                    rows.append((*ids, *record))
                    size += sum(len(cell) for cells in record[1:3] for cell in cells or ())
                    if len(rows) == _BATCH or size >= _TEXT:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def envelope_zip(xml: Column) -> Column:
    """Bytes of the envelope's ``Data`` element; NULL without usable data."""
    data = elements(xml, "Data")["Data"]
    return F.when(F.length(F.trim(data)) > 0, F.try_to_binary(data, F.lit("base64")))


def envelope_fault(xml: Column) -> Column:
    """Why an envelope cannot be opened, or NULL. An empty answer is no fault."""
    parsed = elements(xml, "Data")
    data = F.trim(parsed["Data"])
    return F.when(is_broken(parsed), "broken XML").when(
        (F.length(data) > 0) & F.try_to_binary(parsed["Data"], F.lit("base64")).isNull(), "broken base64"
    )


def broken_envelopes(payloads: DataFrame, xml: str) -> DataFrame:
    """Payloads whose XML cannot be read or whose ``Data`` is no base64."""
    return payloads.filter(envelope_fault(F.col(xml)).isNotNull())


def decode_with_faults(payloads: DataFrame, xml: str, ids: Sequence[str]) -> DataFrame:
    """(ids..., member, header, fields, fault): one row per CSV record of each payload, and one per fault.

    ``ids`` are text columns that say where a payload came from. Payloads
    without data have no rows. A record with more fields than its header is
    whole, and marked by its fault. Spread the payload table over enough partitions first if its files
    are few.
    """
    bounded_batches(payloads.sparkSession)
    zipped = payloads.select(
        *[F.col(c).cast("string").alias(c) for c in ids],
        envelope_zip(F.col(xml)).alias("_zip"),
        envelope_fault(F.col(xml)).alias("_fault"),
    ).filter(F.col("_zip").isNotNull() | F.col("_fault").isNotNull())
    text, texts = T.StringType(), T.ArrayType(T.StringType())
    schema = T.StructType(
        [T.StructField(c, text) for c in ids]
        + [
            T.StructField("member", text),
            T.StructField("header", texts),
            T.StructField("fields", texts),
            T.StructField("fault", text),
        ]
    )
    return zipped.mapInArrow(_unzip([(c, pa.string()) for c in ids]), schema)


def envelope_errors(payloads: DataFrame, xml: str, ids: Sequence[str]) -> DataFrame:
    """(ids..., member, fault, faults): what of the payloads cannot be read whole, and how often."""
    faults = decode_with_faults(payloads, xml, ids).filter(F.col("fault").isNotNull())
    return faults.groupBy(*ids, "member", "fault").agg(F.count("*").alias("faults"))


def decode_envelopes(payloads: DataFrame, xml: str, ids: Sequence[str]) -> DataFrame:
    """(ids..., member, header, fields): one row per record that is read whole; ``envelope_errors`` has the rest."""
    return decode_with_faults(payloads, xml, ids).filter(F.col("fault").isNull()).drop("fault")


def _places(cell: str) -> Column:
    """Positions at which the header has this cell."""
    return F.array_compact(F.transform("_header", lambda h, p: F.when(h == cell, p)))


def records_by_name(
    decoded: DataFrame, header: Sequence[str], keep: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """Decoded records under the cells of ``header``, whatever each member's order.

    A repeated cell takes the member's cell of the same name and rank. Values
    are trimmed, blanks are NULL; short records and absent names give NULL.
    Members that have this very header are read by position. ``names`` are the columns'
    names, by default the cells with a number for repeats.
    """
    aligned = decoded.withColumn("_header", F.transform("header", trim_all)).withColumn(
        "_same", F.col("_header") == F.array(*[F.lit(h) for h in header])
    )
    seen: dict[str, int] = {}
    fields = []
    for i, (cell, name) in enumerate(zip(header, names or distinct_names(header))):
        rank = seen.get(cell, 0)
        seen[cell] = rank + 1
        if rank == 0:
            place = F.array_position("_header", F.lit(cell)).cast("int") - 1
        else:
            place = F.get(_places(cell), F.lit(rank))
        value = F.get("fields", F.when(F.col("_same"), F.lit(i)).otherwise(place))
        fields.append(trim_to_null(value).alias(name))
    return aligned.select(*keep, *fields)


def records_by_position(decoded: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Decoded records by position, whatever their member's header says."""
    return decoded.select(
        *keep,
        *[trim_to_null(F.get("fields", F.lit(i))).alias(name) for i, name in enumerate(names)],
    )
