"""Listings of files and what to take from them: discovery, prefixes, settled and unseen files, ledgers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "path string, modificationTime timestamp, length long, content binary"


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, name, length, modified of every file below root whose name fits; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def prefixes(files: DataFrame, root: str, depth: int) -> DataFrame:
    """The distinct first ``depth`` path segments below root that hold a file, with files and bytes."""
    below = F.substring_index("path", root.rstrip("/") + "/", -1)
    parts = F.split(below, "/")
    deep = files.withColumn("_p", parts).where(F.size("_p") > depth)
    return deep.groupBy(F.array_join(F.slice("_p", 1, depth), "/").alias("prefix")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def glob_rule(pattern: str) -> str:
    """A shell pattern as a regular expression over whole paths."""
    out = "".join(".*" if ch == "*" else "." if ch == "?" else "\\" + ch if ch in r"\.[]{}()+-^$|" else ch for ch in pattern)
    return f"^{out}$"


def selected(path: Column, include: list[str], exclude: list[str]) -> Column:
    """The path fits an include pattern (or there is none) and no exclude pattern."""
    any_of = lambda ps: F.array_contains(F.array(*[path.rlike(glob_rule(p)) for p in ps]), True) if ps else F.lit(False)
    return (any_of(include) if include else F.lit(True)) & ~any_of(exclude)


def settled(files: DataFrame, as_of: Column, seconds: int) -> DataFrame:
    """Files not modified for at least ``seconds``: younger ones may still be written."""
    return files.where(F.unix_seconds(as_of) - F.unix_seconds("modified") >= seconds)


def to_upload(files: DataFrame, episodes: DataFrame, ledger: DataFrame, include: list[str], exclude: list[str]) -> DataFrame:
    """Files to send with their target prefix: selected, of known episodes, not yet in the ledger.

    files: episode_id, path, length; episodes: episode_id, accepted (null: unjudged); ledger: path, length.
    """
    home = F.when(F.col("accepted").isNull(), "_unjudged").when(F.col("accepted"), "accepted").otherwise("_rejected")
    fresh = files.where(selected(F.col("path"), include, exclude)).join(ledger.select("path", "length"), ["path", "length"], "left_anti")
    return fresh.join(episodes.select("episode_id", "accepted"), "episode_id").select("episode_id", "path", "length", home.alias("verdict"))


def each_file_once(spark: SparkSession, root: str, checkpoint: str, take: Callable[[DataFrame, int], None], pattern: str = "*") -> None:
    """Hand every file below root that no earlier call has handed on to take(batch, id), and return.

    The stream's checkpoint is the ledger: after a crash a batch is repeated under the same id, so an idempotent take
    sees each file exactly once.
    """
    stream = spark.readStream.schema(LISTING).format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    named = stream.select("path", F.substring_index("path", "/", -1).alias("name"), "length", F.col("modificationTime").alias("modified"), "content")
    named.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
