"""A document pipeline of five stages, each written as Parquet and read again by the next.

No SQL twin exists: the classifier and the packing plan are iterative, so ORACLE_SQL is None; tests/llm
holds a run over planted documents against a brute-force version of what each stage must keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strideframe.llm import common
from strideframe.llm.decontaminate import clean
from strideframe.llm.exact_dedup import keep_last
from strideframe.llm.jaccard_join import keep_one
from strideframe.llm.packing import pack
from strideframe.llm.quality_crf import keep_good

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, common.table(spark, sf_dir, "labels"), training=common.table(spark, sf_dir, "documents"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_last(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, common.table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("benchmark decontamination", decontaminate), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; a stage's table goes once the next one is written."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = common.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            common.forget(before)
        before = docs
    return docs
