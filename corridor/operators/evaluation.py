"""Rewards, episodes and policy figures from logged events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.config import DEFAULT, CorridorConfig
from corridor.functions.policy import known
from corridor.functions.rewards import step_reward
from corridor.operators.lookup import attach_by_key
from corridor.operators.ordering import number_rows

METRICS = ("reward", "final_adherence_sec", "avg_speed_mph")


def step_rewards(silver: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Per event: step number of its train, previous speed and reward.

    The first event of a train has no braking cost. Unknown adherence counts as 0.
    """
    order = ["event_time", "event_id"]
    return rewarded(number_rows(step_columns(silver, cfg), cfg.keys, order, ["current_speed_mph"]), cfg)


def step_columns(silver: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """What rewards need of the events."""
    return silver.select(
        *cfg.keys,
        "event_time",
        "event_id",
        "signal_aspect_ahead",
        "current_speed_mph",
        "schedule_adherence_sec",
    )


def rewarded(numbered: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Step number, previous speed and reward of events numbered per train."""
    speed = F.col("current_speed_mph")
    previous = F.coalesce("prev_current_speed_mph", speed)
    return (
        numbered.withColumn("prev_speed_mph", previous)
        .withColumn(
            "reward",
            step_reward(
                F.col("schedule_adherence_sec"),
                speed,
                F.col("prev_speed_mph"),
                F.col("signal_aspect_ahead"),
                cfg.max_speed_mph,
            ),
        )
        .drop("prev_current_speed_mph")
        .withColumnRenamed("row_no", "step")
    )


def with_episodes(steps: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add ``episode_no`` (from 0) and ``episode_step`` (from 1)."""
    zero_based = F.col("step") - 1
    length = F.lit(cfg.episode_steps)
    return steps.withColumns(
        {
            "episode_no": F.floor(zero_based / length).cast("bigint"),
            "episode_step": (zero_based % length + 1).cast("bigint"),
        }
    )


def with_running_reward(episodic: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add the reward collected so far in the episode, a group of fixed size."""
    so_far = (
        Window.partitionBy(*cfg.keys, "episode_no")
        .orderBy("episode_step")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return episodic.withColumn("running_reward", F.sum("reward").over(so_far))


def episode_metrics(episodic: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Total reward, final adherence and mean speed of every complete episode."""
    last_known = known(F.col("schedule_adherence_sec"))
    return (
        episodic.groupBy(*cfg.keys, "episode_no")
        .agg(
            F.count("*").alias("n_steps"),
            F.sum("reward").alias("reward"),
            F.max_by(last_known, "episode_step").alias("final_adherence_sec"),
            F.avg("current_speed_mph").alias("avg_speed_mph"),
        )
        .where(F.col("n_steps") == cfg.episode_steps)
        .drop("n_steps")
    )


def policy_metrics(episodes: DataFrame, by: str = "policy") -> DataFrame:
    """Figures per policy label; the spread is the population standard deviation."""
    return episodes.groupBy(by).agg(
        F.count("*").alias("n_episodes"),
        F.avg("reward").alias("mean_reward"),
        F.stddev_pop("reward").alias("std_reward"),
        F.avg("final_adherence_sec").alias("mean_adherence_sec"),
        F.avg("avg_speed_mph").alias("mean_avg_speed_mph"),
    )


def compare_policies(metrics: DataFrame, base: str, by: str = "policy") -> DataFrame:
    """Difference of every other policy to the one named ``base``.

    The figures are computed once: a window over them, one row per policy, finds those of
    the base. Other policies without a base are an error, not silent nulls.
    """
    figures = F.struct("mean_reward", "mean_adherence_sec")
    all_policies = Window.partitionBy(F.lit(0))
    found = F.max(F.when(F.col(by) == base, figures)).over(all_policies)

    def delta(c: str) -> Column:
        absent = F.raise_error(F.lit(f"no figures of the base policy {base!r}")).cast("double")
        return F.col(c) - F.when(F.col("_base").isNull(), absent).otherwise(F.col("_base")[c])

    return metrics.withColumn("_base", found).where(~F.col(by).eqNullSafe(base)).select(
        by,
        "n_episodes",
        delta("mean_reward").alias("delta_reward"),
        delta("mean_adherence_sec").alias("delta_adherence_sec"),
    )


def finite(value: Column) -> Column:
    """The value as a double, null unless it is a finite number."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def _by_metric(metrics: Sequence[str], with_value: bool = False) -> Column:
    """One row per metric with its range and, on demand, its value."""

    def line(m: str) -> Column:
        value = [F.col(m).cast("double").alias("value")] if with_value else []
        return F.struct(F.lit(m).alias("metric"), F.col(f"_range_{m}").alias("span"), *value)

    return F.inline(F.array(*(line(m) for m in metrics)))


def histogram(
    episodes: DataFrame,
    by: str = "policy",
    metrics: Sequence[str] = METRICS,
    bins: int = 20,
) -> DataFrame:
    """Equal-width bins per label and metric over that group's own range.

    The last bin includes the maximum; empty bins are listed. A group with a
    single value gets the range half a unit either side of it. ``mean`` is the
    group's mean line. Null, NaN and infinite values lie in no bin and count in no range
    or mean; a group without any other value lists its bins without edges.
    """
    episodes = episodes.select(by, *(finite(F.col(m)).alias(m) for m in metrics))
    low, high = F.col("low"), F.col("high")
    flat = F.col("min_value") == F.col("max_value")
    wide = [
        F.struct(
            F.min(m).alias("min_value"), F.max(m).alias("max_value"), F.avg(m).alias("mean")
        ).alias(m)
        for m in metrics
    ]
    per_label = episodes.groupBy(by).agg(*wide)
    ranges = {m: f"_range_{m}" for m in metrics}
    ranged = attach_by_key(
        episodes.select(by, *metrics), per_label.withColumnsRenamed(ranges), [by]
    )

    def edged(df: DataFrame) -> DataFrame:
        return df.select("*", "span.*").select(
            *df.columns,
            "mean",
            F.when(flat, F.col("min_value") - 0.5).otherwise(F.col("min_value")).alias("low"),
            F.when(flat, F.col("max_value") + 0.5).otherwise(F.col("max_value")).alias("high"),
        )

    def edge(i: Column) -> Column:
        return F.when(i == bins, high).otherwise(i * ((high - low) / F.lit(float(bins))) + low)

    guess = F.least(
        F.floor((F.col("value") - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1)
    ).cast("int")
    # A value sits in the bin whose printed edges enclose it, also after rounding.
    settled = (
        F.when(F.col("value") < edge(F.col("guess")), F.col("guess") - 1)
        .when(
            (F.col("value") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1),
            F.col("guess") + 1,
        )
        .otherwise(F.col("guess"))
    )
    counted = (
        edged(ranged.select(by, _by_metric(metrics, with_value=True)))
        .withColumn("guess", guess)
        .groupBy(by, "metric", settled.cast("int").alias("bin"))
        .agg(F.count("value").alias("n"))
    )
    every_bin = edged(per_label.withColumnsRenamed(ranges).select(by, _by_metric(metrics))).withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
    )
    return every_bin.join(counted, [by, "metric", "bin"], "left").select(
        by,
        "metric",
        "bin",
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "mean",
    )
