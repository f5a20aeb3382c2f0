"""The tables of the medallion, derived lazily from one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.config import DEFAULT, CorridorConfig
from corridor.operators import evaluation as ev
from corridor.operators import scoring, serving
from corridor.operators.advisories import with_advisories
from corridor.operators.events import parse_events, validate_events
from corridor.operators.occupancy import occupancy
from corridor.session import prepare
from corridor.sources.movements import log_rows


def example_network(shift: int = 0) -> tuple[scoring.Layer, scoring.Layer]:
    """A small 8-4-5 network with weights from a formula; no trained model is given."""

    def layer(n_out: int, n_in: int) -> scoring.Layer:
        weights = tuple(
            tuple(((31 * i + 17 * j + shift) % 13 - 6) / 10 for j in range(n_in))
            for i in range(n_out)
        )
        return scoring.Layer(weights, tuple(((7 * i + shift) % 5 - 2) / 10 for i in range(n_out)))

    return layer(4, 8), layer(5, 4)


def other_network() -> tuple[scoring.Layer, scoring.Layer]:
    """One that advises other speeds for some observations."""
    return example_network(shift=4)


def wide_network(seed: int = 1) -> tuple[scoring.Layer, ...]:
    """An 8-64-64-5 network, the usual size, with weights from a formula."""

    def layer(n_out: int, n_in: int, k: int) -> scoring.Layer:
        return scoring.Layer(
            tuple(
                tuple(((37 * i + 101 * j + i * j * k) % 211 - 105) / 400 for j in range(n_in))
                for i in range(n_out)
            ),
            tuple(((53 * i + k) % 97 - 48) / 200 for i in range(n_out)),
        )

    return layer(64, 8, seed), layer(64, 64, seed + 1), layer(5, 64, seed + 2)


def edge(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, for results that leave Spark."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals: sums and means depend on the order of addition."""
    return df.select(
        *(
            F.round(F.col(f.name), 6).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


class Layers:
    """Bronze, Silver, occupancy, Gold and what is built on them."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        cfg: CorridorConfig = DEFAULT,
        fleet: bool = False,
    ) -> None:
        self.spark, self.sf_dir, self.cfg, self.fleet = prepare(spark), sf_dir, cfg, fleet

    @cached_property
    def log(self) -> DataFrame:
        return log_rows(self.spark, self.sf_dir, self.fleet)

    @cached_property
    def bronze(self) -> DataFrame:
        return parse_events(self.log)

    @cached_property
    def silver(self) -> DataFrame:
        return validate_events(self.bronze, self.cfg)

    @cached_property
    def occupancy(self) -> DataFrame:
        return occupancy(self.silver, self.cfg)

    @cached_property
    def gold(self) -> DataFrame:
        return with_advisories(self.occupancy, self.cfg)

    @cached_property
    def latest(self) -> DataFrame:
        return serving.latest_per_train(self.gold, self.cfg)

    @cached_property
    def featured(self) -> DataFrame:
        return scoring.with_features(self.gold, self.cfg)

    @cached_property
    def scored(self) -> DataFrame:
        return scoring.score_policy(self.featured, example_network())

    @cached_property
    def steps(self) -> DataFrame:
        return ev.with_episodes(ev.step_rewards(self.silver, self.cfg), self.cfg)

    @cached_property
    def episodes(self) -> DataFrame:
        """Complete episodes; trains with an odd number form the base policy."""
        number = F.expr("substring(train_id, 3)").cast("bigint")
        return ev.episode_metrics(self.steps, self.cfg).withColumn(
            "policy", F.when(number % 2 == 1, "base").otherwise("candidate")
        )
