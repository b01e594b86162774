"""What the training-data operators share: table access and written intermediate tables."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset, and only in local mode (tests), a temporary folder stands in for it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="strideframe-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def written_bytes(df: DataFrame) -> int:
    """Size of a table written by save()."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(df.saved_at)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(where).getLength()


def forget(*frames: DataFrame) -> None:
    """Delete tables written by save() that no later read needs."""
    for df in frames:
        path = df.saved_at
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished, unreferenced plans now."""
    gc.collect()  # Python's references to plans hold the JVM's
    spark._jvm.System.gc()


def text_of(column: str) -> Column:
    """A text column with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))
