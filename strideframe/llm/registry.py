"""The queries and oracle statements of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .conversation_repair import repair
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .html_extract import html_extract
from .jaccard_join import jaccard_components
from .license_scan import NAMED, license_scan
from .lm_score import lm_scores
from .packing import pack
from .quality_crf import quality_scores
from .secret_scan import secret_scan
from .suffix_dedup import remove_repeats
from .url_filter import url_filter
from .whitening import whiten

TOKENIZER = "byte_bpe_50k.json"


def _documents(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(common.table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), common.table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(common.table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_documents(spark, sf_dir))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that is a path or url is the document's own, so one that ends in LICENSE licenses those below; other sources are folders without licence files."""
    docs = _documents(spark, sf_dir)
    own = F.regexp_replace("source", "[?#].*$", "")
    folder = F.concat_ws("/", "lang", "source", F.col("doc_id").cast("string"))
    return license_scan(docs.withColumn("path", F.when(own.contains("/") | own.rlike(NAMED), own).otherwise(folder)))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_documents(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(common.table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_suffix_array_dedup, op2_packing, op3_url_filter, op4_decontamination, op5_quality_classifier, op6_exact_dedup, op7_html_extraction,
        op8_secret_scan, op9_ngram_jaccard_join, op10_license_scan, op11_lm_scoring, op12_conversation_repair, op13_embedding_whitening,
    )
    return {f.__name__: f for f in named}


ORACLES = {
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
