"""Curation of a corpus: documents pass the stages below in turn, each written and
read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import packing, robust_rules, simhash, weak_labels
from tallyhouse.llm.shared import read_table, tokenizer_path, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return robust_rules.kept_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_labels.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("packing", packed),
]

# The estimates and the model of the stages are iterative: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
