"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontamination import contaminated_regions
from millrace.llm.fuzzy_passages import repeated_stretches
from millrace.llm import kd_shards as _kd
from millrace.llm import secret_scan as _secrets
from millrace.llm.kd_shards import kd_shards
from millrace.llm.main_text import extract_pages
from millrace.llm.media_source import media_columns
from millrace.llm import merkle as _merkle
from millrace.llm.merkle import document_manifest
from millrace.llm.near_dedup import near_duplicate_classes
from millrace.llm.packing import pack_documents
from millrace.llm.quality import quality_scores
from millrace.llm.secret_scan import secret_report
from millrace.llm.token_counts import token_counts
from millrace.llm.url_filter import judge_urls
from millrace.llm.whitening import whitened_components


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_regions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_table(spark, sf_dir, "documents")).drop("node")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"))


def op9_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_stretches(_table(spark, sf_dir, "documents"))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(_table(spark, sf_dir, "documents"), shards=40)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(_table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(_table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_best_fit_packing,
        op3_secret_scan,
        op4_token_counts,
        op5_media_columns,
        op6_quality,
        op7_near_dedup,
        op8_url_filter,
        op9_fuzzy_passages,
        op10_kd_shards,
        op11_whitening,
        op12_merkle,
        op13_main_text,
    )
}
#: Equivalents in DuckDB SQL; the other queries are tested against brute force.
ORACLES: dict[str, str] = {"op3_secret_scan": _secrets.oracle_sql(), "op10_kd_shards": _kd.oracle_sql(40), "op12_merkle": _merkle.oracle_sql()}
