"""The report ledger kept from a landing folder of responses.

Each micro-batch is classified and its new runs are appended to a store with
one folder per stream and batch; a batch that is run again after a failure
overwrites its own folder. A stream is known by the id in its checkpoint, so
a new checkpoint over an old store adds to it and overwrites nothing. The
ledger is the fold over the store. Files that land together may be taken in
any order: a run seen again with a lower sequence number is stored once more,
and the fold takes the lowest, as the batch ledger does.

Within a batch's folder, runs lie in slices by a hash of their group. A batch
looks at the slices it touches only; ``compact_runs`` folds a store of many small
batches into a new one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from revflow.operators.ledger import (
    GROUP,
    SEQUENCE,
    first_sightings,
    parse_responses,
    report_ledger,
    unseen_runs,
)

LANDING_SCHEMA = (
    "customer_account string, report_name string, instance_key string, "
    "sequence bigint, response string"
)
_STORE_SCHEMA = (
    "customer_account string, report_name string, instance_key string, "
    "identifier string, sequence bigint, stream string, batch bigint, slice int"
)
SLICES = 64
_NO_STORE = "PATH_NOT_FOUND"


def stored_runs(spark: SparkSession, store: str) -> DataFrame:
    """All runs of a store; none if it does not exist yet."""
    try:
        return spark.read.schema(_STORE_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(store)
    except AnalysisException as missing:
        if missing.getCondition() == _NO_STORE:
            return spark.createDataFrame([], _STORE_SCHEMA)
        raise


def _sliced(runs: DataFrame) -> DataFrame:
    group = F.xxhash64(*GROUP)
    return runs.select(*GROUP, "identifier", SEQUENCE, F.pmod(group, F.lit(SLICES)).cast("int").alias("slice"))


def _registrar(store: str):
    def register(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        fresh = _sliced(first_sightings(parse_responses(batch), F.col("outcome").isNull()))
        touched = [r[0] for r in fresh.select("slice").distinct().collect()]  # at most SLICES
        own = (F.col("stream") == stream) & (F.col("batch") >= batch_id)
        earlier = stored_runs(spark, store).filter(F.col("slice").isin(touched) & ~own)
        unseen_runs(fresh, earlier).write.mode("overwrite").partitionBy("slice").parquet(
            f"{store}/stream={stream}/batch={batch_id}"
        )

    return register


def compact_runs(spark: SparkSession, store: str, target: str) -> None:
    """Write the runs of a store, each once with its first sighting, to a new store with a file per slice."""
    runs = _sliced(first_sightings(stored_runs(spark, store).select(*GROUP, "identifier", SEQUENCE)))
    runs.repartition("slice").write.mode("errorifexists").partitionBy("slice").parquet(
        f"{target}/stream=compacted/batch=0"
    )


def start_ledger_stream(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Take in all responses that have landed since the last run, then stop."""
    responses = (
        spark.readStream.schema(LANDING_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )
    return (
        responses.writeStream.foreachBatch(_registrar(store))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_ledger(spark: SparkSession, store: str) -> DataFrame:
    """Ledger of all runs the stream has registered."""
    return report_ledger(stored_runs(spark, store).select(*GROUP, "identifier", SEQUENCE))
