"""Session settings and the shared folder used for data that leaves a plan."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(app: str = "revflow", master: str = "local[*]", **conf) -> SparkSession:
    """Session for tests and benches; a cluster job brings its own session."""
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A machine-local folder is made only for a local master, where driver and
    executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="revflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, so that runs never meet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, unless the session says otherwise: a worker holds a few batches at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(8 << 20))


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, which need not have it installed; once per application.

    Spark itself hands the archive out from the driver, so no folder has to be shared for it.
    """
    context = spark.sparkContext
    if getattr(context, "_revflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for folder, _, files in sorted(os.walk(package)):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    place = os.path.join(tempfile.mkdtemp(prefix="revflow-ship-"), "revflow-package.zip")
    with open(place, "wb") as f:
        f.write(content.getvalue())
    context.addPyFile(place)
    context._revflow_shipped = True
