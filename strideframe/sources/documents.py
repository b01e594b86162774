"""Small documents beside the tables: JSON files, logs, Markdown indexes, dual metadata, binary meshes."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

META = "map<string,string>"


def json_documents(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """path, ok, doc: one JSON document per file; an unreadable one gives ok false and a null doc."""
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = raw.withColumn("d", F.from_json("value", schema + ", _bad string", options))
    ok = F.col("d").isNotNull() & F.col("d._bad").isNull()
    names = [f.name for f in parsed.schema["d"].dataType.fields if f.name != "_bad"]
    return parsed.select("path", ok.alias("ok"), F.when(ok, F.struct(*[F.col(f"d.{n}") for n in names])).alias("doc"))


def failed_materials(lines: DataFrame, log: str = "file", text: str = "value") -> DataFrame:
    """log, proven, failures, n_failures: assets that fell back to the default material.

    A log counts as clean only if it proves to be an editor log that reached shader compilation.
    """
    hit = F.col(text).contains("Failed to compile Material")
    asset = F.regexp_extract(text, r"Content/(\S+?)\.uasset", 1)
    named = F.when(hit, F.coalesce(F.nullif(asset, F.lit("")), F.substring(F.trim(text), 1, 120)))
    has = lambda w: F.bool_or(F.col(text).contains(w))
    return lines.groupBy(log).agg((has("LogInit") & has("LogShaderCompilers")).alias("proven"), F.array_sort(F.collect_set(named)).alias("failures"), F.count_if(hit).alias("n_failures"))


def index_entries(texts: DataFrame, text: str = "value") -> DataFrame:
    """key, title, project of a Markdown index: sections ``## <key> · <title>`` with a link to Projects/<project>/."""
    sections = F.filter(F.split(text, r"(?m)^## "), lambda s: s.rlike(r"^\w+ · "))
    rows = texts.select(F.explode(sections).alias("s"))
    at = lambda p: F.regexp_extract("s", p, 1)
    return rows.select(at(r"^(\w+) · ").alias("key"), F.trim(at(r"^\w+ · ([^\n]*)")).alias("title"), F.nullif(at(r"\[Projects/([^/\]]+)/"), F.lit("")).alias("project")).where("project IS NOT NULL")


def read_metadata(text: Column) -> Column:
    """A JSON object, or else ``key: value`` lines (the first of a key counts), as a map of texts."""
    pairs = F.filter(F.split(text, r"\r?\n"), lambda s: s.contains(":"))
    entries = F.transform(pairs, lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)).alias("key"), F.trim(F.regexp_replace(s, r"^[^:]*:", "")).alias("value")))
    first = F.aggregate(entries, F.create_map().cast(META), lambda m, e: F.when(F.map_contains_key(m, e["key"]), m).otherwise(F.map_concat(m, F.create_map(e["key"], e["value"]))))
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, META)).otherwise(first)


def overlay(base: Column, over: Column) -> Column:
    """Both maps; a key of ``over`` wins. Null maps are empty."""
    none = F.create_map().cast(META)
    b, o = F.coalesce(base, none), F.coalesce(over, none)
    return F.map_concat(F.map_filter(b, lambda k, _: ~F.map_contains_key(o, k)), o)


def _mesh(kind: str):
    def run(batches):
        for batch in batches:
            for path, content, side in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                meta = json.loads(side)
                v, t = int(meta["vertex_count"]), int(meta["triangle_count"])
                if len(content) != 12 * (v + t):
                    raise ValueError(f"{path}: {len(content)} bytes for {v} vertices and {t} triangles")
                if kind == "vertices":
                    a, names = np.frombuffer(content, "<f4", 3 * v).reshape(v, 3), ("v", "x", "y", "z")
                else:
                    a, names = np.frombuffer(content, "<i4", 3 * t, 12 * v).reshape(t, 3), ("t", "a", "b", "c")
                cast = np.float64 if kind == "vertices" else np.int64
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(a)), pa.array(np.arange(len(a), dtype=np.int64)), *[pa.array(a[:, i].astype(cast)) for i in range(3)]], names=["mesh", *names])

    return run


def read_meshes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Vertices (mesh, v, x, y, z) and triangles (mesh, t, a, b, c) of little-endian float32 and int32 files with a JSON sidecar.

    A file x.bin needs x.json with vertex_count and triangle_count; a wrong length raises.
    """
    read = lambda p: spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", p).load(root)
    stem = F.regexp_replace("path", r"\.(bin|json)$", "").alias("mesh")
    files = read("*.bin").select(stem, "content").join(read("*.json").select(stem, F.col("content").cast("string").alias("side")), "mesh")
    return files.mapInArrow(_mesh("vertices"), "mesh string, v long, x double, y double, z double"), files.mapInArrow(_mesh("triangles"), "mesh string, t long, a long, b long, c long")
