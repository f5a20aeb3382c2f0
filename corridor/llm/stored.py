"""Intermediate tables in the folder all executors share, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.session import new_path

#: Rows of at most 16 bytes or so that may be sent to every executor.
BROADCAST_ROWS = 2_000_000


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """A stored table of ids with a broadcast hint, if it is small enough for one."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of undirected ``edges`` (a, b); the smallest node names it.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to
    its larger ones, then to its smaller ones. Each is an aggregate that combines before
    the shuffle and a join, so a node with many neighbours does not meet them in one task.
    """
    a, b = F.col("a"), F.col("b")
    links = stored(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        both = links.union(links.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(a, F.least("a", "m").alias("m"))
        larger = (
            both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
        )
        links = stored(larger.where(a != b).distinct(), "links")
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        smaller = (
            links.join(least, "a")
            .select(F.explode(F.array(F.struct(a, F.col("m").alias("b")), F.struct(b.alias("a"), F.col("m").alias("b")))))
            .select("col.*")
        )
        links = stored(smaller.where(a != b).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(a.alias("node"), b.alias("component")).union(
                links.select(b, b).distinct()
            )
        before = now
