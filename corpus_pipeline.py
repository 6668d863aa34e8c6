"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._shared import written
from millrace.llm.decontamination import decontaminate
from millrace.llm.near_dedup import near_duplicate_classes
from millrace.llm.packing import pack_documents
from millrace.llm.quality import keep_quality
from millrace.llm.secret_scan import redact

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Rows stay as they are; a null text is judged as an empty one; without
    labels all are kept."""
    return keep_quality(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that with the least doc_id, null ids last; of repeated rows one stays.
    A null text is an empty one, and empty texts are one class."""
    docs = docs.select(*COLUMNS)
    none, number = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    kept = near_duplicate_classes(docs).filter("is_kept").select(none.alias("_none"), number.alias("_id"), F.col("node").alias("_node"))
    keyed = docs.select(*COLUMNS, none.alias("_none"), number.alias("_id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("_node"))
    return keyed.join(kept, ["_none", "_id", "_node"], "left_semi").dropDuplicates(["_none", "_id", "_node"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; rows stay as they are."""
    return decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans that the secret scan reports replaced by a mask, and n_chars of the new texts; a null
    text stays null and has null n_chars."""
    clean = redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; a null text has the end id alone."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", packing),
]
#: SQL can't express the classifier, the signatures or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{i}")
    return docs
