"""Files of a store as a Spark source, walked prefix by prefix on the executors.

``spark.dataSource.register(PrefixWalk)``, then ``spark.read.format("prefix_walk").load(root)``. The driver lists the
top level only, as one delimiter call does; every prefix found there is a partition whose subtree an executor walks, folder by folder. A filter on
``prefix`` leaves the other subtrees unlisted. The store is any that pyarrow.fs knows by its URI; a path without a scheme is local.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "prefix string, path string, name string, length long, modified timestamp"
CHUNK = 1 << 20


def store(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)


@dataclass
class Prefix(InputPartition):
    prefix: str | None  # None: the files at the top itself

    def __init__(self, prefix: str | None):
        super().__init__(prefix)
        self.prefix = prefix


class PrefixReader(DataSourceReader):
    def __init__(self, root: str):
        self.root, self.wanted = root.rstrip("/"), None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("prefix",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[Prefix]:
        if self.wanted is not None:
            return [Prefix(p or None) for p in sorted(self.wanted)]
        fs, top = store(self.root)
        folders = [i.base_name for i in fs.get_file_info(pafs.FileSelector(top)) if i.type == pafs.FileType.Directory]
        return [Prefix(None), *(Prefix(p) for p in sorted(folders))]

    def read(self, part: Prefix) -> Iterator[pa.RecordBatch]:
        fs, top = store(self.root)
        start = top if part.prefix is None else f"{top}/{part.prefix}"
        todo = [start]
        while todo:
            at, files = todo.pop(), []
            for i in fs.get_file_info(pafs.FileSelector(at, allow_not_found=True)):
                if i.type == pafs.FileType.Directory and part.prefix is not None:
                    todo.append(i.path)
                elif i.type == pafs.FileType.File:
                    files.append(i)
            if files:
                below = [i.path[len(top) :].lstrip("/") for i in files]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.prefix or ""] * len(files)), pa.array(below), pa.array([i.base_name for i in files]), pa.array([i.size for i in files], pa.int64()), pa.array([i.mtime for i in files], pa.timestamp("us", "UTC"))],
                    names=["prefix", "path", "name", "length", "modified"],
                )


class PrefixWalk(DataSource):
    @classmethod
    def name(cls) -> str:
        return "prefix_walk"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PrefixReader:
        return PrefixReader(self.options["path"])


def walk(spark: SparkSession, root: str, only: list[str] | None = None) -> DataFrame:
    """prefix (first folder below root, "" for files at the top), path below root, name, length, modified; ``only``: prefixes to walk."""
    spark.dataSource.register(PrefixWalk)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    files = spark.read.format("prefix_walk").load(root)
    return files if only is None else files.where(F.col("prefix").isin(only))


def digests(files: DataFrame, root: str) -> DataFrame:
    """path, length, sha256 of every file of walk(): read as a stream of CHUNK bytes on the executors, so a file may have any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = store(root.rstrip("/"))
        for batch in batches:
            got = []
            for path in batch.column(0).to_pylist():
                sha = hashlib.sha256()
                with fs.open_input_stream(f"{top}/{path}", buffer_size=None) as f:
                    while chunk := f.read(CHUNK):
                        sha.update(chunk)
                got.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], names=["path", "length", "sha256"])

    # one task a few files: a few large files of one folder spread as well
    dealt = files.select("path", "length").repartition("path")
    return dealt.mapInArrow(run, "path string, length long, sha256 string")


def sha256_manifest(spark: SparkSession, root: str, name: str = "files.sha256") -> DataFrame:
    """path, sha256 of every file below root but the manifest itself, in path order."""
    files = walk(spark, root).where(F.col("name") != name)
    return digests(files, root).select("path", "sha256").orderBy("path")
