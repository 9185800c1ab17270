"""Vendor snapshots: tab-delimited tables with a header, typed by the DDL they ship.

A snapshot folder is named ``{account}_{yyyymmdd_HHMMSS}`` and carries the
``CREATE TABLE`` script of its tables. The script is the schema registry:
columns are never listed here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SNAPSHOT_DATE = "MM/dd/yyyy"
SNAPSHOT_TIMESTAMP = "MM/dd/yyyy HH:mm:ss"
_DATA_PATH = r"^(.*?/([^/]+)\.[dD][aA][tT])(?:/|$)"

# Tables of a full snapshot and their primary keys ("" = none declared).
SNAPSHOT_KEYS = {
    "AUTHORIZATIONS": "SEQNO", "B_ACTIVITY": "TRANID", "B_APPT": "SEQNO",
    "B_APPTTYPES": "SEQNO", "B_CHARGE": "TRANID", "B_CHARGESTATUS": "",
    "B_CLAIM": "SEQNO", "B_CLAIMSTATUS": "SEQNO", "B_CPTCODE": "",
    "B_CREDIT": "TRANID", "B_FACILITY": "SEQNO", "B_ICDCODE": "",
    "B_LOCATION": "SEQNO", "B_PATIENT": "PACCTNO", "B_PATNOTES": "SEQNO",
    "B_PAYOR": "SEQNO", "B_PRACTICE": "SEQNO", "B_PROVID": "",
    "B_PROVIDER": "SEQNO", "B_REFERRING": "SEQNO", "B_REMITTANCE": "SEQNO",
    "B_RESOURCE": "SEQNO", "CLAIM_ICD_CODE": "SEQNO", "ICDPROC": "",
    "ICLAIM": "SEQNO", "INSCHECK": "SEQNO", "INS_PARTIES": "SEQNO",
    "INS_POLICIES": "SEQNO", "INVENTORY": "SEQNO", "REVCODE": "",
}


@dataclass(frozen=True)
class SnapshotTable:
    name: str
    schema: T.StructType
    key: str | None


def _spark_type(sql_type: str) -> tuple[T.DataType, dict]:
    base, *args = re.findall(r"\w+", sql_type.upper())
    sizes = [int(a) for a in args if a.isdigit()]
    if base in ("DECIMAL", "NUMBER", "NUMERIC"):
        precision, scale = (sizes + [0])[:2] if sizes else (38, 10)
        return T.DecimalType(precision, scale), {}
    if base == "DATE":
        return T.DateType(), {}
    if base in ("TIMESTAMP", "DATETIME"):
        return T.TimestampNTZType(), {}
    return T.StringType(), {"max_length": sizes[0]} if sizes else {}


def ddl_catalogue(script: str) -> dict[str, SnapshotTable]:
    """Table name to columns, types and key, from a ``CREATE TABLE`` script.

    The declared length of a text column is kept as field metadata
    (``max_length``) for the width check.
    """
    tables = {}
    for name, body in re.findall(r"CREATE TABLE (\w+)\s*\((.*?)\)\s*;", script, re.S | re.I):
        fields, key = [], None
        for column, sql_type, rest in re.findall(
            r"(\w+)\s+(\w+(?:\s*\([\d\s,]*\))?)([^,]*)(?:,|$)", body
        ):
            data_type, metadata = _spark_type(sql_type)
            fields.append(T.StructField(column, data_type, True, metadata))
            if "PRIMARY KEY" in rest.upper():
                key = column
        tables[name.upper()] = SnapshotTable(name.upper(), T.StructType(fields), key)
    return tables


def with_timestamps(
    table: SnapshotTable, vendor: SnapshotTable, renamed: dict[str, str] | None = None
) -> SnapshotTable:
    """Give back the time stamps that a relational copy of the DDL stores as text."""
    kinds = {f.name: f.dataType for f in vendor.schema}
    names = renamed or {}
    fields = [
        T.StructField(f.name, T.TimestampNTZType())
        if isinstance(kinds.get(names.get(f.name, f.name)), T.TimestampNTZType)
        else f
        for f in table.schema
    ]
    return SnapshotTable(table.name, T.StructType(fields), table.key)


def read_catalogue(
    spark: SparkSession, path: str, pattern: str = "*.sql", recursive: bool = False
) -> dict[str, SnapshotTable]:
    """Catalogue from the scripts at a path, on any file system Spark can read.

    A table of a full snapshot whose script declares another key than is known is refused.
    """
    read = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
    tables = ddl_catalogue("\n".join(script["value"] for script in read.select("value").collect()))
    for name, table in tables.items():
        if (table.key or "") != SNAPSHOT_KEYS.get(name, table.key or ""):
            raise ValueError(f"{name} declares the key {table.key}, not {SNAPSHOT_KEYS[name] or 'none'}")
    return tables


def snapshot_files(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, data_path, account, extracted_at) of all ``.dat`` files, any case.

    A data path is a file, or a folder named like one around its parts. Only
    the file listing is used.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    path = F.col("path")
    return (
        files.select(
            F.upper(F.regexp_extract(path, _DATA_PATH, 2)).alias("table_name"),
            F.regexp_extract(path, _DATA_PATH, 1).alias("data_path"),
            *lineage(path),
        )
        .filter("data_path <> ''")
        .distinct()
    )


def data_folder(files: DataFrame) -> DataFrame:
    """The first folder, by path, that holds data files; one row."""
    folder = F.regexp_extract("data_path", r"^(.*)/[^/]+$", 1)
    return files.agg(F.min(folder).alias("folder"))


def lineage(path: Column) -> list[Column]:
    """Account and extract time from the nearest ``{account}_{time}`` folder."""
    pattern = r"([^/=]+)_(\d{8}_\d{6})/"
    stamp = F.regexp_extract(path, pattern, 2)
    return [
        F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).alias("account"),
        F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss"))
        .cast("timestamp_ntz")
        .alias("extracted_at"),
    ]


def time_label(ts: Column) -> Column:
    """Time stamp as it stands in a snapshot folder's name."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def scan_snapshot(
    spark: SparkSession,
    paths: str | list[str],
    table: SnapshotTable,
    with_lineage: bool = False,
    mode: str = "FAILFAST",
    check_header: bool = True,
) -> DataFrame:
    """One snapshot table, typed, from its data paths. A value that does not fit its type ends the
    scan, as a bulk load would; ``mode="PERMISSIVE"`` makes it NULL instead.
    Lines may end in LF or CRLF; an empty field is NULL. A header that does not
    name the table's columns in their order ends the scan too; without
    ``check_header`` columns are taken by position, as a bulk load takes them.
    """
    df = (
        spark.read.schema(table.schema)
        .option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", not check_header)
        .option("quote", "")
        .option("nullValue", "")
        .option("dateFormat", SNAPSHOT_DATE)
        .option("timestampNTZFormat", SNAPSHOT_TIMESTAMP)
        .option("recursiveFileLookup", True)
        .option("mode", mode)
        .csv(paths)
    )
    if not with_lineage:
        return df
    return df.select("*", *lineage(F.col("_metadata.file_path")))
