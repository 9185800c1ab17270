"""Report files: quoted CSV, pipe lines, JSON, and the table a file belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from revflow.functions.names import column_names, last_positions, snake_column
from revflow.functions.text import blank_to_null, na_to_null, trim_all
from revflow.sources.csv_records import FAULT, FILE, refusing, scan_with_faults


def has_line_breaks(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> bool:
    """Whether a quoted field runs over a line end anywhere below the paths.

    A line with an odd number of quotes opens or closes such a field; without
    any, every line is a whole record and the files can be split. The search
    ends at the first hit.
    """
    lines = spark.read.option("recursiveFileLookup", recursive).text(paths)
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def csv_header(spark: SparkSession, paths: str | list[str], recursive: bool = False) -> list[str]:
    """Header cells as delivered, repeats and blanks included. Reads one record."""
    first = (
        spark.read.option("header", False)
        .option("escape", '"')
        .option("multiLine", True)
        .option("recursiveFileLookup", recursive)
        .option("maxColumns", 20480)
        .csv(paths)
        .first()
    )
    return [] if first is None else [(c or "") for c in first]


def scan_report_csv(
    spark: SparkSession,
    paths: str | list[str],
    names: Sequence[str] | None = None,
    na_words: bool = True,
    multi_line: bool | None = None,
    recursive: bool = False,
    path_column: str | None = None,
    long_records: str = "refuse",
) -> DataFrame:
    """Header CSV as text columns; types are decided later, over all rows.

    Names default to the normalised header with repeats told apart. Whether
    fields hold line breaks is looked up when ``multi_line`` is not given; files
    with such fields are split as others are. A record with more fields
    than the header, or with a quote that is never closed, ends the scan;
    ``long_records="cut"`` drops what has no column instead, and ``scan_with_faults`` keeps
    such records apart. Records with fewer fields end in NULLs.
    ``path_column`` adds the path of the report each row comes from, as the last column.
    """
    if names is None:
        names = column_names(csv_header(spark, paths, recursive))
    if multi_line is None:
        multi_line = has_line_breaks(spark, paths, recursive)
    found = scan_with_faults(spark, paths, names, multi_line, recursive)
    return report_rows(refusing(found, keep_path=True) if long_records == "refuse" else found, na_words, path_column)


def report_rows(df: DataFrame, na_words: bool = True, path_column: str | None = None) -> DataFrame:
    """The delivered columns of scanned records, NULL for the words that mean it, and the report's path if it is asked for."""
    value = na_to_null if na_words else lambda c: c
    names = [c for c in df.columns if c not in (FILE, FAULT)]
    origin = [folder_of(F.col(FILE)).alias(path_column)] if path_column else []
    return df.select(*[value(F.col(f"`{n}`")).alias(n) for n in names], *origin)


def collapse_repeats(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Give every column of one header name the value of its last repeat.

    ``header`` holds the delivered names of the frame's columns, in order.
    Values that are missing become empty strings.
    """
    sources = [df.columns[i] for i in last_positions(header)]
    return df.select(
        *[
            F.coalesce(F.col(f"`{source}`"), F.lit("")).alias(target)
            for source, target in zip(sources, df.columns)
        ]
    )


def table_of(path: Column) -> Column:
    """Table name of a report file: its stem, or that of a folder named like one."""
    stem = F.regexp_extract(path, r"([^/]+)\.(?:csv|dat)(?:/|$)", 1)
    return snake_column(F.url_decode(stem))


def folder_of(path: Column) -> Column:
    """Path of the report: the file, or the folder named ``*.csv`` around its parts."""
    return F.regexp_extract(path, r"^(.*?[^/]+\.(?:csv|dat))(?:/|$)", 1)


def discover_reports(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(table_name, report_path, files, bytes) for all report files below a root.

    Only the file listing is used; no file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )
    return (
        files.select(
            table_of(F.col("path")).alias("table_name"),
            folder_of(F.col("path")).alias("report_path"),
            "length",
        )
        .groupBy("table_name", "report_path")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def delivered_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(table_name, report_path, file_path, header_line, open_quotes) of each file with lines below a root.

    One pass over all lines finds the first line of each file and whether some
    quoted field of it runs over a line end, so one odd quote does not
    keep other files from being split.
    """
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root)
        .select(F.col("_metadata.file_path").alias("file_path"), place.alias("place"), "value", (quotes % 2 == 1).alias("odd"))
    )
    return (
        lines.groupBy("file_path")
        .agg(F.min_by("value", "place").alias("header_line"), F.bool_or("odd").alias("open_quotes"))
        .select(
            table_of(F.col("file_path")).alias("table_name"),
            folder_of(F.col("file_path")).alias("report_path"),
            "file_path",
            "header_line",
            "open_quotes",
        )
    )


def scan_lines_with_table(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """All lines below a root with the table and the path they belong to."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root)
        .select(
            table_of(F.col("_metadata.file_path")).alias("table_name"),
            folder_of(F.col("_metadata.file_path")).alias("report_path"),
            F.col("value").alias("line"),
        )
    )


# ---- pipe lines ---------------------------------------------------------


def repair_ragged(
    lines: DataFrame, columns: Sequence[str], line: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Pipe lines by position: short rows padded with NULL, long rows cut.

    ``_adjusted`` tells repaired rows. There is no quoting and no escaping; an
    empty field is NULL and white space around the whole line is dropped.
    """
    split = lines.select(*keep, F.split(trim_all(F.col(line)), r"\|").alias("_fields"))
    fields = [
        blank_to_null(F.get("_fields", F.lit(i))).alias(name) for i, name in enumerate(columns)
    ]
    return split.select(
        *keep, *fields, (F.size("_fields") != F.lit(len(columns))).alias("_adjusted")
    )


def scan_pipe_dat(spark: SparkSession, paths: str | list[str], columns: Sequence[str]) -> DataFrame:
    """Headerless ``|`` file as text columns, rows repaired to the table's width."""
    return repair_ragged(spark.read.text(paths), columns).drop("_adjusted")


# ---- JSON ---------------------------------------------------------------


def scan_json_report(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | T.StructType,
    customer_id: Column,
    multi_line: bool = True,
) -> DataFrame:
    """Arrays of objects, one row per object, with the customer they came from.

    With ``multi_line=False`` each line holds a whole array and files split.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .json(paths)
        .withColumn("customer_id", customer_id)
    )
