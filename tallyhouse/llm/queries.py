"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    attention_lm,
    checking_sql,
    forest,
    host_trust,
    id_blocks,
    merkle,
    packing,
    page_text,
    piece_transducer,
    prefix_counts,
    robust_rules,
    simhash,
    spelling,
    weak_labels,
)
from tallyhouse.llm.shared import read_table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    pieces = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_forest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return forest.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op3_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    counts = prefix_counts.token_counts(docs, tokenizer_path("byte_bpe_50k.json"), (1024,))
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "chars_within_1024"
    )


def op4_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.page_texts(read_table(spark, folder, "pages"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_piece_transducer(spark: SparkSession, folder: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    encoded = piece_transducer.encode(read_table(spark, folder, "documents"), model)
    return piece_transducer.decode(encoded, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op7_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.classify(read_table(spark, folder, "documents"))


def op8_attention_lm(spark: SparkSession, folder: str) -> DataFrame:
    return attention_lm.score(read_table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_robust_rules(spark: SparkSession, folder: str) -> DataFrame:
    return robust_rules.quality_rules(read_table(spark, folder, "documents"))


def op10_id_blocks(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return id_blocks.placed(id_blocks.write_ids(docs, tokenizer_path("byte_bpe_50k.json")))


def op11_host_trust(spark: SparkSession, folder: str) -> DataFrame:
    judged = host_trust.judge(read_table(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.proof_table(read_table(spark, folder, "documents"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_forest": op2_forest,
    "op3_prefix_counts": op3_prefix_counts,
    "op4_page_text": op4_page_text,
    "op5_simhash": op5_simhash,
    "op6_piece_transducer": op6_piece_transducer,
    "op7_weak_labels": op7_weak_labels,
    "op8_attention_lm": op8_attention_lm,
    "op9_robust_rules": op9_robust_rules,
    "op10_id_blocks": op10_id_blocks,
    "op11_host_trust": op11_host_trust,
    "op12_merkle": op12_merkle,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op11_host_trust": checking_sql.HOST_TRUST,
    "op12_merkle": checking_sql.MERKLE,
    "op13_spelling": checking_sql.SPELLING,
}
