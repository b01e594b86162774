"""Versioned tables: whole snapshots under one folder, made known by a commit file that only one writer can create.

``root/data-<id>`` holds a snapshot's Parquet files, ``root/commits/<version>`` names it. Readers take the highest version, so they see a
whole snapshot, the old or the new one. A writer names the version it has read; if another committed meanwhile, its commit fails and nothing of it is seen.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has committed this version."""


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def create_once(spark: SparkSession, path: str, body: str) -> bool:
    """Create a file with a body unless it exists; false if it does. Local files by O_EXCL, others by the store's own create without overwrite."""
    where, fs = _path(spark, path)
    fs.mkdirs(where.getParent())
    local = urlparse(str(fs.makeQualified(where).toString()))
    if local.scheme == "file":
        beside = f"{local.path}.{uuid.uuid4().hex}"
        with open(beside, "w") as f:
            f.write(body)
        try:
            os.link(beside, local.path)  # whole or not at all, and only if there is none
        except FileExistsError:
            return False
        finally:
            os.unlink(beside)
        return True
    try:
        out = fs.create(where, False)
    except Exception as e:
        if "AlreadyExists" in str(e) or fs.exists(where):
            return False
        raise
    out.write(bytearray(body.encode()))
    out.close()
    return True


def version(spark: SparkSession, root: str) -> int:
    """The highest committed version; 0: none."""
    where, fs = _path(spark, f"{root}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def read(spark: SparkSession, root: str, schema: str, at: int | None = None) -> DataFrame:
    """The table at a version (default: the latest); without any an empty one."""
    at = version(spark, root) if at is None else at
    if not at:
        return spark.createDataFrame([], schema)
    folder = spark.read.text(f"{root}/commits/{at}").first()["value"]
    return spark.read.schema(schema).parquet(f"{root}/{folder}")


def commit(df: DataFrame, root: str, after: int) -> int:
    """Write a snapshot that follows version ``after`` and return its version; Conflict if another writer was first."""
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    if not create_once(spark, f"{root}/commits/{after + 1}", folder):
        where, fs = _path(spark, f"{root}/{folder}")
        fs.delete(where, True)
        raise Conflict(f"version {after + 1} of {root} is taken")
    return after + 1


def probed(files: DataFrame, root: str, probe: Callable[[DataFrame], DataFrame], value: str) -> DataFrame:
    """files with the probe's value, from the cache where path, modified and length are the same; the rest is probed and cached.

    files: path, modified, length; probe adds the column ``value`` (DDL, like ``seconds double``). On a conflict the
    loser starts again from the winner's snapshot.
    """
    spark, key = files.sparkSession, ["path", "modified", "length"]
    schema = f"path string, modified timestamp, length long, {value}"
    name = value.split()[0]
    while True:
        now = version(spark, root)
        known = read(spark, root, schema, now)
        fresh = probe(files.select(*key).join(known, key, "left_anti")).select(*key, name)
        if now and not fresh.limit(1).count():
            break
        # what is no longer there is forgotten
        kept = known.join(files.select(*key), key, "left_semi")
        try:
            now = commit(kept.unionByName(fresh), root, now)
            break
        except Conflict:
            continue
    return files.join(read(spark, root, schema, now).select(*key, F.col(name)), key)
