"""A corpus pipeline: five stages from documents to packed training sequences.

Every stage takes (spark, documents, data folder) and returns a table; all but the last
return the columns of documents. Stages see what their predecessor kept, stored as
Parquet. Empty tables pass through; null texts are empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.llm import byte_cnn, decontamination, packing, partenum, secrets
from corridor.llm.batches import ready, table
from corridor.llm.stored import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, fitted on these documents' labels, rejects."""
    labels = table(spark, sf_dir, "labels")
    net = byte_cnn.fit(*byte_cnn.training_rows(docs, labels, "quality"))
    return byte_cnn.accepted(docs, net)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    ready(spark)
    return partenum.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets; ``n_chars`` follows the text."""
    ready(spark)
    masked = secrets.mask_secrets(docs)
    if "n_chars" not in masked.columns:
        return masked
    kind = masked.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("secret_scan", secret_scan),
    ("pack", pack),
]

#: SQL cannot express the network and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
