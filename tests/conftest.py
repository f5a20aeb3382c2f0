import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from corridor.session import prepare  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def layers(spark):
    """Bronze to Gold at sf0.01, each stored once as a table."""
    from corridor.plans.layers import Layers
    from corridor.session import new_path

    stored = Layers(spark, SF)
    for name in ("bronze", "silver", "occupancy", "gold"):
        path = new_path(spark, name)
        getattr(stored, name).write.parquet(path)
        stored.__dict__[name] = spark.read.parquet(path)
    return stored


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
