"""Session factory and table loader."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "strideframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every query here assumes: UTC, ANSI and AQE.

    Nothing about sizes is fixed: partition counts come from the cluster's own configuration
    unless the caller passes them.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table under ``root``; read by Spark only, so any store it knows will do."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let checkpoint() write to ``spark.checkpoint.dir``; only local runs without it use a temporary folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="strideframe-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    context.setCheckpointDir(path)
