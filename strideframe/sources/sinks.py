"""Where results go: Parquet and CSV tables with totals taken on the way, one-row documents, uploads by verdict."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Parquet; types are those of the DataFrame, so nothing is guessed from text. An existing table is not overwritten."""
    writer = df.write.mode("error")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def write_csv(df: DataFrame, path: str, totals: dict[str, Column]) -> dict:
    """CSV with a header; the totals are aggregated while the rows are written, in one pass."""
    seen = Observation()
    watched = df.observe(seen, *[c.alias(n) for n, c in totals.items()])
    watched.write.mode("error").option("header", True).csv(path)
    return seen.get


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as one JSON file at ``path``: written beside it and renamed, so readers see the old or the new one."""
    row = [r[0] for r in df.selectExpr("to_json(struct(*))").limit(2).collect()]
    if len(row) != 1:
        raise ValueError(f"a document is one row, not {len(row)}")
    spark = df.sparkSession
    jvm = spark._jvm
    target, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".writing")
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(json.loads(row[0]), indent=1, ensure_ascii=False).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(target), overwrite)


def write_by_verdict(files: DataFrame, path: str) -> None:
    """Rows under one folder per verdict; run it from an idempotent batch, as it appends."""
    files.write.mode("append").partitionBy("verdict").parquet(path)
