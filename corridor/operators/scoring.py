"""Policy scoring over Gold rows, distributed and without collecting them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.config import DEFAULT, SPEED_TARGETS_MPH, CorridorConfig
from corridor.functions import policy as P
from corridor.operators.advisories import with_blocks_count
from corridor.operators.network import network_state

SCORE = "rl_advisory_speed_mph"


@dataclass(frozen=True)
class Layer:
    """Dense layer; ``weights[i][j]`` leads from input ``j`` to output ``i``."""

    weights: tuple[tuple[float, ...], ...]
    bias: tuple[float, ...]


def with_features(gold: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add ``blocks_count`` and the observation array ``obs``."""
    counted = gold if "blocks_count" in gold.columns else with_blocks_count(gold)
    obs = P.observation(
        F.col("speed_mph"),
        F.col("signal_aspect"),
        F.col("blocks_count"),
        F.col("schedule_adherence_sec"),
        F.col("track_grade_pct"),
        F.col("block_idx"),
        cfg,
    )
    return counted.withColumn("obs", obs)


def with_network_features(snapshot: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add the observation a train makes of its corridor, from which blocks are occupied.

    Signal aspect and number of occupied blocks ahead come from one pass over the
    snapshots, not from what the events report.
    """
    obs = P.observation(
        F.col("speed_mph"),
        F.col("derived_aspect"),
        F.col("n_ahead"),
        F.col("schedule_adherence_sec"),
        F.col("track_grade_pct"),
        F.col("block_idx"),
        cfg,
    )
    return network_state(snapshot, cfg).withColumn("obs", obs)


def apply_policy(
    df: DataFrame, policy: Callable[[Column], Column], column: str = SCORE
) -> DataFrame:
    """Speed advised by any policy that maps an observation to an action id."""
    return df.withColumn(column, P.target_speed(policy(F.col("obs"))))


# Activations by name, for columns and for arrays.
COLUMN_ACTIVATIONS = {"relu": lambda x: F.greatest(x, F.lit(0.0)), "tanh": F.tanh}
ARRAY_ACTIVATIONS = {"relu": lambda x: np.maximum(x, 0.0), "tanh": np.tanh}


def _forward(
    layers: tuple[Layer, ...], activation: str
) -> Callable[[np.ndarray], np.ndarray]:
    """The network's outputs for a matrix of observations, one matrix product per layer."""
    squash = ARRAY_ACTIVATIONS[activation]
    dense = [(np.array(layer.weights, float).T, np.array(layer.bias, float)) for layer in layers]

    def run(x: np.ndarray) -> np.ndarray:
        for weights, bias in dense[:-1]:
            x = squash(x @ weights + bias)
        weights, bias = dense[-1]
        return x @ weights + bias

    return run


def network_udf(layers: tuple[Layer, ...], activation: str = "relu"):
    """A function of an observation column: the advised speed, in Arrow batches.

    A null observation, or one of another length than the network's input, gives null.
    Of equal outputs the first counts.
    """
    targets = np.array(SPEED_TARGETS_MPH)
    width = len(layers[0].weights[0])
    forward = _forward(layers, activation)

    @F.arrow_udf(T.DoubleType())
    def advise(obs: pa.Array) -> pa.Array:
        fits = pc.fill_null(pc.equal(pc.list_value_length(obs), width), False)
        known = obs.filter(fits)
        speeds = np.full(len(obs), np.nan)
        if len(known):
            matrix = known.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            speeds[fits.to_numpy(zero_copy_only=False)] = targets[forward(matrix).argmax(axis=1)]
        return pa.array(speeds, mask=np.isnan(speeds))

    return advise


def score_policy(
    featured: DataFrame,
    layers: tuple[Layer, ...],
    activation: str = "relu",
    column: str = SCORE,
) -> DataFrame:
    """Add the speed the network advises for ``obs``, for a network of any size."""
    return featured.withColumn(column, network_udf(layers, activation)(F.col("obs")))


def score_columns(
    featured: DataFrame,
    layers: tuple[Layer, ...],
    activation: str = "relu",
    column: str = SCORE,
) -> DataFrame:
    """The same as column arithmetic without Python, for a caller with a small network.

    Each layer is one projection, so a unit is computed once and not once per use.
    """
    squash, df = COLUMN_ACTIVATIONS[activation], featured
    inputs = [F.col("obs")[j] for j in range(len(layers[0].weights[0]))]
    helpers = []
    for depth, layer in enumerate(layers):
        names = [f"_unit_{depth}_{i}" for i in range(len(layer.bias))]
        units = {}
        for name, row, bias in zip(names, layer.weights, layer.bias, strict=True):
            total = F.lit(float(bias))
            for weight, value in zip(row, inputs, strict=True):
                total = total + F.lit(float(weight)) * value
            units[name] = squash(total) if depth < len(layers) - 1 else total
        df = df.withColumns(units)
        inputs = [F.col(n) for n in names]
        helpers += names
    return df.withColumn(column, P.target_speed(P.argmax_action(F.array(*inputs)))).drop(*helpers)


def register_udfs(
    spark: SparkSession,
    layers: tuple[Layer, ...],
    activation: str = "relu",
    name: str = "rl_advisory",
) -> None:
    """Make the network callable from SQL as ``rl_advisory(obs)``."""
    spark.udf.register(name, network_udf(layers, activation))


def advisory_agreement(
    scored: DataFrame,
    rule_col: str = "advisory_speed_mph",
    other_col: str = SCORE,
    tolerance_mph: float = 5.0,
) -> DataFrame:
    """Per aspect: how often two advices differ by more than the tolerance."""
    gap = F.abs(F.col(other_col) - F.col(rule_col))
    return scored.groupBy("signal_aspect").agg(
        F.count("*").alias("n_rows"),
        F.count_if(gap > tolerance_mph).alias("n_differ"),
        F.avg(rule_col).alias("avg_rule_mph"),
        F.avg(other_col).alias("avg_other_mph"),
    )


def score_parity(
    a: DataFrame,
    b: DataFrame,
    keys: list[str],
    column: str = SCORE,
    atol: float = 1e-5,
    rtol: float = 1e-5,
) -> DataFrame:
    """One row: do two score sets agree within ``atol + rtol * |b|``?

    A row that only one side has counts as a mismatch.
    """
    left = a.select(*keys, F.col(column).alias("_a"))
    right = b.select(*keys, F.col(column).alias("_b"))
    close = F.coalesce(
        F.abs(F.col("_a") - F.col("_b")) <= F.lit(atol) + F.lit(rtol) * F.abs("_b"), F.lit(False)
    )
    return left.join(right, keys, "full").agg(
        F.count("*").alias("n_rows"),
        F.count_if(~close).alias("n_mismatch"),
        F.coalesce(F.bool_and(close), F.lit(True)).alias("matches"),
    )
