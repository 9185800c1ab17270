"""Report files: CSV per instance and report, pipe lines, sorted-key lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from revflow.operators.shape import ref

ROWS_PER_FILE = 1_000_000


def write_report_csv(
    df: DataFrame,
    root: str,
    report: str,
    instance: str | None = "instance_key",
    rebalance: bool = True,
) -> str:
    """Write ``{root}/{report}.csv`` with headers and return its path.

    Values keep their outer blanks. With an instance column there is one folder
    per instance below it, and all columns stay in the files. Rows are rebalanced by instance first:
    Spark splits an instance that holds much of the data over many files and
    packs small ones, and a file never exceeds ``ROWS_PER_FILE`` rows. With
    ``rebalance=False`` that shuffle is saved and every task writes a file
    per instance it holds, which suits few instances.
    """
    path = f"{root}/{report}.csv"
    writer_input = df
    if instance is not None:
        folder = "instance"
        while folder in {c.lower() for c in df.columns}:
            folder = f"_{folder}"
        writer_input = df.withColumn(folder, ref(instance))
        if rebalance:
            writer_input = writer_input.hint("rebalance", folder)
    writer = (
        writer_input.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
    )
    if instance is not None:
        writer = writer.partitionBy(folder)
    writer.csv(path)
    return path


def pipe_line(columns: Sequence[Column]) -> Column:
    """Values joined by ``|``; NULL is an empty field, nothing is escaped."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def pipe_lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One text column ``value``; a listed column the frame lacks is empty."""
    cells = [ref(c) if c in df.columns else F.lit("") for c in columns]
    return df.select(pipe_line(cells).alias("value"))


def write_pipe_dat(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    pipe_lines(df, df.columns if columns is None else columns).write.mode("overwrite").text(path)


def write_pipe_csv(df: DataFrame, path: str) -> None:
    """Pipe separated with quoting, so that a ``|`` within a value survives."""
    df.write.mode("overwrite").option("sep", "|").option("escape", '"').csv(path)


def sorted_line(df: DataFrame) -> Column:
    """Values in the order of their column names; NULL prints as ``None``."""
    cells = [F.coalesce(ref(c).cast("string"), F.lit("None")) for c in sorted(df.columns)]
    return F.concat_ws("|", *cells)


def write_sorted_lines(df: DataFrame, path: str) -> None:
    df.select(sorted_line(df).alias("value")).write.mode("overwrite").text(path)
