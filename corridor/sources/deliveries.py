"""Write derived log rows as files that arrive one after another.

A stand-in for a running log: each delivery covers a range of event numbers, and
file times rise with the delivery number, which is the order a file stream reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.sources.tables import list_files

DELIVERIES = 10
MIN_ROWS = 500
LATE_BY = 3


def rows_per_delivery(rows: DataFrame, deliveries: int = DELIVERIES) -> int:
    """Rows per delivery that make about ``deliveries`` of them, 500 at least."""
    total = rows.agg(F.count("*")).first()[0]
    return max(MIN_ROWS, -(-total // deliveries))


def files_per_trigger(files: int, triggers: int = DELIVERIES) -> str:
    """File stream option that reads ``files`` in about ``triggers`` batches."""
    return str(-(-files // triggers))


def write_deliveries(
    rows: DataFrame, path: str, rows_each: int, late_period: int | None = None
) -> int:
    """Write ``rows`` (which carry the number ``n``) and return the number of files.

    With ``late_period`` every such row is delivered ``LATE_BY`` deliveries later, and
    each delivery is one file.
    """
    number = F.floor(F.col("n") / rows_each).cast("int")
    if late_period:
        number = number + F.when(F.col("n") % late_period == 0, LATE_BY).otherwise(0)
    numbered = rows.withColumn("delivery", number).drop("n")
    if late_period:
        numbered = numbered.repartition("delivery")
    return write_in_turn(numbered, path, "delivery")


def write_in_turn(rows: DataFrame, path: str, part: str) -> int:
    """Write one folder per value of ``part``; return the number of files.

    The files get modification times one second apart, in the order of ``part``.
    """
    rows.write.partitionBy(part).parquet(path)
    spark = rows.sparkSession
    number = F.regexp_extract("path", rf"{part}=(\d+)", 1).cast("int")
    files = list_files(spark, path).select("path", number.alias("d")).orderBy("d", "path")
    names = [row["path"] for row in files.collect()]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    first = jvm.java.lang.System.currentTimeMillis() - 1000 * (len(names) + 1)
    for i, name in enumerate(names):
        target = jvm.org.apache.hadoop.fs.Path(name)
        target.getFileSystem(conf).setTimes(target, first + 1000 * i, -1)
    return len(names)
