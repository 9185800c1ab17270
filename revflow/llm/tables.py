"""Tables of the given folder, and tables that cut a plan's lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revflow.session import bounded_batches, run_folder, ship


def frugal(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, unless the session says otherwise: a worker holds a few batches at once.

    Also sends the package to the workers, whose functions come from it.
    """
    ship(spark)
    bounded_batches(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; the files are installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """The rows of ``df``, written once below the shared folder and read from there.

    Later passes and retries read the files instead of repeating the plan, so a
    lost executor costs its own tasks only.
    """
    spark = df.sparkSession
    folder = run_folder(spark, f"llm-{name}")
    df.write.partitionBy(*by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder) if not by else spark.read.parquet(folder)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here remove their shuffle files when they end, which would otherwise stay until
    the driver collects garbage. For writes: what is read again must be stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def crc_of_id(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def buckets(spark: SparkSession) -> int:
    """Number of ranges that hashes are dealt to: the session's shuffle partitions, which grow with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_side(df: DataFrame, bytes_per_row: int, limit: int = 32 << 20) -> DataFrame:
    """``df`` (a stored table) with a broadcast hint if its counted rows fit ``limit``; else it is joined by shuffle."""
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df
