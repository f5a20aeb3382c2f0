"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import (
    bisectors,
    brown,
    byte_cnn,
    decontamination,
    partenum,
    quotes,
    rule_ledger,
    secrets,
    toxic_segments,
    va_file,
    whitening,
)
from corridor.llm.batches import table
from corridor.llm.packing import pack_documents
from corridor.llm.prefix_tokens import count_tokens

Query = Callable[[SparkSession, str], DataFrame]


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op4_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op5_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_documents(table(spark, sf_dir, "documents"))


def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_segments.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(table(spark, sf_dir, "documents"))


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.apply_rules(table(spark, sf_dir, "documents"))


def op11_bisectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return va_file.search(vectors, vectors.where(F.col("vec_id") % va_file.QUERY_EVERY == 0))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_quotes": op1_quotes,
    "op2_packing": op2_packing,
    "op3_prefix_tokens": op3_prefix_tokens,
    "op4_entropy_secrets": op4_entropy_secrets,
    "op5_brown": op5_brown,
    "op6_byte_cnn": op6_byte_cnn,
    "op7_toxic_segments": op7_toxic_segments,
    "op8_decontamination": op8_decontamination,
    "op9_partenum": op9_partenum,
    "op10_rule_ledger": op10_rule_ledger,
    "op11_bisectors": op11_bisectors,
    "op12_va_file": op12_va_file,
    "op13_whitening": op13_whitening,
}

#: SQL that DuckDB runs on the same tables, where SQL can express the query.
ORACLE_SQL: dict[str, str] = {
    "op1_quotes": quotes.ORACLE,
    "op4_entropy_secrets": secrets.oracle(),
    "op8_decontamination": decontamination.ORACLE,
    "op9_partenum": partenum.ORACLE,
    "op10_rule_ledger": rule_ledger.ORACLE,
    "op11_bisectors": bisectors.oracle(),
    "op12_va_file": va_file.oracle(),
}
