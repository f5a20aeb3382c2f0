"""Table readers and writers. ``fmt`` is any format the session knows, such as
``parquet``, ``orc``, ``json`` or, with its jar present, ``delta``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.sources.folders import Folder


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Batch scan of a stored table."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Batch write, also used to publish scored Gold rows."""
    df.write.format(fmt).mode(mode).save(path)


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """A stored table as a stream of its new rows. File formats need the schema."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def list_files(
    spark: SparkSession, path: str, pattern: str = "*.parquet", recursive: bool = True
) -> DataFrame:
    """Path, size and modification time of the files below ``path``; contents are not read.

    Where a file sink has written, Spark lists the files by the sink's commit log: what a
    failed or unfinished attempt left in the folder is not among them.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "modificationTime", "length")
    )


def read_recent_files(
    spark: SparkSession, path: str, n: int, recursive: bool = True, **options: str
) -> DataFrame:
    """Rows of the ``n`` most recently modified Parquet files below ``path``.

    Only the ``n`` names reach the driver. Columns are aligned by name.
    """
    newest = (
        list_files(spark, path, recursive=recursive)
        .orderBy(F.desc("modificationTime"), F.desc("path"))
        .limit(n)
    )
    paths = [row["path"] for row in newest.select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no Parquet files below {path}")
    return spark.read.option("mergeSchema", "true").options(**options).parquet(*paths)


def has_files(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    """Does the folder hold any Parquet file?"""
    return Folder(spark, path).has() and not list_files(spark, path, recursive=recursive).isEmpty()


def read_with_fallback(
    spark: SparkSession, primary: str, sample: str, schema: T.StructType, n: int | None = None
) -> tuple[DataFrame, bool]:
    """The primary table, else the sample, else no rows; and whether it is the sample.

    With ``n`` only the newest ``n`` files are read. The primary folder is read with all
    folders below it, the sample without them.
    """
    for path, is_sample in ((primary, False), (sample, True)):
        nested = not is_sample
        if not has_files(spark, path, nested):
            continue
        if n:
            return read_recent_files(spark, path, n, nested), is_sample
        reader = spark.read.option("recursiveFileLookup", str(nested).lower())
        return reader.option("pathGlobFilter", "*.parquet").parquet(path), is_sample
    return spark.createDataFrame([], schema), False


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns aligned by name; a column a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
