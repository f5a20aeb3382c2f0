"""Every registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor.config import FLEET
from corridor.functions import policy as P
from corridor.operators import evaluation as ev
from corridor.operators import network, quality, scoring, serving
from corridor.operators.advisories import sample_columns
from corridor.operators.events import explode_blocks_ahead, parse_events, validate_events
from corridor.operators.ordering import number_rows
from corridor.plans import dashboard
from corridor.plans.layers import Layers, edge, example_network, other_network, rounded, wide_network
from corridor.schema import GOLD, OCCUPANCY, SILVER_EVENT, TRAIN_EVENT
from corridor.session import new_path
from corridor.sources import deliveries, keyed_log, log, tables
from corridor.streaming import jobs, sinks
from corridor.streaming.late import LateRows

Query = Callable[[SparkSession, str], DataFrame]

EVENT_FIELDS = [f for f in SILVER_EVENT.fieldNames() if f != "blocks_ahead_occupied"]
# Integers with nulls leave as doubles: pandas has no other common form for them.
WHOLE_OR_NULL = ["block_idx", "gross_tonnage"]
REWARD_FIELDS = ["train_id", "event_id", "step", "prev_speed_mph", "reward"]


def _flat_events(events: DataFrame) -> DataFrame:
    """Events with the nested list reduced to its length."""
    flat = [c for c in events.columns if c != "blocks_ahead_occupied"]
    return events.select(*flat, F.size("blocks_ahead_occupied").alias("n_blocks_ahead"))


# --- parsing, validation, windows -------------------------------------------


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze_columns(Layers(spark, sf_dir).bronze)


def _bronze_columns(events: DataFrame) -> DataFrame:
    known = F.when(F.col("blocks_ahead_occupied").isNotNull(), F.size("blocks_ahead_occupied"))
    flat = [c for c in EVENT_FIELDS if c not in ("event_time", *WHOLE_OR_NULL)]
    return events.select(
        *flat,
        *(F.col(c).cast("double").alias(c) for c in WHOLE_OR_NULL),
        known.cast("double").alias("n_blocks_ahead"),
    )


def silver_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(_flat_events(Layers(spark, sf_dir).silver))


def blocks_ahead_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(explode_blocks_ahead(Layers(spark, sf_dir).silver))


def occupancy_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(Layers(spark, sf_dir).occupancy)


def gold_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(Layers(spark, sf_dir).gold)


def gold_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(Layers(spark, sf_dir, FLEET, fleet=True).gold)


def advisory_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [
        "train_id",
        "signal_aspect",
        "shockwave_delay_sec",
        "advisory_speed_mph",
        "delay_severity",
    ]
    return sample_columns(Layers(spark, sf_dir).gold, cols, 5, ["window_start", "train_id"])


def keyed_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, sf_dir)
    return _flat_events(parse_events(log.to_keyed_json(layers.silver.drop("event_time"))))


# --- quality ------------------------------------------------------------------


def dq_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_bronze(Layers(spark, sf_dir).bronze)


def dq_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_silver(Layers(spark, sf_dir).silver)


def dq_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_occupancy(Layers(spark, sf_dir).occupancy)


def dq_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_gold(Layers(spark, sf_dir).gold)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Layers(spark, sf_dir)
    return quality.derived_report(t.bronze, t.gold, t.cfg)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Layers(spark, sf_dir)
    return quality.derived_counts(t.bronze, t.gold, t.cfg)


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks' predicates on unvalidated rows, where they find something."""
    bronze = Layers(spark, sf_dir).bronze
    speed, signal = F.col("current_speed_mph"), F.col("signal_aspect_ahead")
    return quality.count_violations(
        bronze,
        {
            "null_train": F.col("train_id").isNull(),
            "bad_signal": quality.not_among(signal, ["clear", "approach", "stop"]),
            "bad_speed": quality.outside(speed, 0, 79),
        },
    )


# --- network ------------------------------------------------------------------


def derived_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = network.derive_signals(Layers(spark, sf_dir).occupancy)
    return edge(rows.select("window_start", "train_id", "block_idx", "derived_aspect"))


def derived_signals_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, sf_dir, FLEET, fleet=True)
    rows = network.derive_signals(layers.occupancy, FLEET)
    return edge(
        rows.select("window_start", "subdivision", "train_id", "block_idx", "derived_aspect")
    )


def blocks_ahead_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(network.blocks_ahead(Layers(spark, sf_dir).occupancy))


def blocks_ahead_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = network.blocks_ahead_count(Layers(spark, sf_dir).occupancy)
    return edge(rows.select("window_start", "train_id", "block_idx", "n_ahead"))


def next_block_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = network.next_block_free(Layers(spark, sf_dir).occupancy)
    return edge(rows.select("window_start", "train_id", "block_idx"))


def occupied_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(network.occupied_blocks(Layers(spark, sf_dir).occupancy))


def shockwave_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(network.shockwave_cascade(Layers(spark, sf_dir).gold))


# --- serving ------------------------------------------------------------------


def latest_per_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(Layers(spark, sf_dir).latest)


def track_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.track_map(Layers(spark, sf_dir).latest)


def advisory_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.advisory_feed(Layers(spark, sf_dir).latest)


def corridor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.corridor_summary(Layers(spark, sf_dir).latest))


def marey_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(serving.marey_series(Layers(spark, sf_dir).gold))


def rl_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlay of the network's advice, not of the rule's."""
    latest = serving.latest_per_train(Layers(spark, sf_dir).scored.drop("obs"))
    return serving.rl_overlay(latest, scoring.SCORE).drop("differs")


def absent_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of a table that lacks columns: their defaults are shown."""
    latest = Layers(spark, sf_dir).latest
    lacking = ["signal_aspect", "speed_mph", "delay_severity", "block_id", "advisory_speed_mph"]
    return serving.advisory_feed(latest.drop(*lacking))


def keyed_log_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key of the log: rows, partitions, and rows that come before an earlier one."""
    path = new_path(spark, "log")
    keyed_log.append_events(Layers(spark, sf_dir).log, path, ["timestamp", "n"])
    keyed_log.register(spark)
    rows = spark.read.format(keyed_log.FORMAT).options(path=path).load()
    times = number_rows(rows.select("partition", "offset", "key", "timestamp"), ["partition"], ["offset"],
        ["timestamp"], F.floor(F.col("offset") / 10_000))
    return times.groupBy(F.col("key").cast("string").alias("train_id")).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("partition").alias("n_partitions"),
        F.count_if(F.col("prev_timestamp") > F.col("timestamp")).alias("n_disorder"),
    )


def _split_by_window(occupancy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Even and odd windows; the even ones lack a column."""
    even = F.expr("unix_seconds(window_start) div 10 % 2 = 0")
    return occupancy.where(even).drop("track_grade_pct"), occupancy.where(~even)


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _split_by_window(Layers(spark, sf_dir).occupancy)
    return edge(tables.union_tables(parts))


def recent_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten generations of files written in turn; read the files of the newest eight."""
    path = new_path(spark, "recent")
    generation = F.expr("cast(unix_seconds(window_start) div 10 % 10 as int)")
    rows = Layers(spark, sf_dir).occupancy.withColumn("generation", generation)
    deliveries.write_in_turn(rows, path, "generation")
    files = tables.list_files(spark, path)
    newest = files.where(F.regexp_extract("path", r"generation=(\d+)", 1).cast("int") >= 2)
    return edge(tables.read_recent_files(spark, path, newest.count()))


# --- policy -------------------------------------------------------------------


def policy_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(
        Layers(spark, sf_dir).featured.select(
            "window_start",
            "train_id",
            "blocks_count",
            *(F.col("obs")[i].alias(name) for i, name in enumerate(P.OBSERVATION)),
        )
    )


def policy_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(Layers(spark, sf_dir).scored.select("window_start", "train_id", scoring.SCORE))


def policy_scores_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    scoring.register_udfs(spark, example_network())
    Layers(spark, sf_dir).featured.createOrReplaceTempView("corridor_features")
    return edge(
        spark.sql(
            "select window_start, train_id, rl_advisory(obs) as rl_advisory_speed_mph "
            "from corridor_features"
        )
    )


def rule_policy_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = P.rule_policy(F.col("obs"))
    rows = scoring.apply_policy(Layers(spark, sf_dir).featured, P.rule_policy, "target_speed_mph")
    return edge(
        rows.select("window_start", "train_id", action.alias("action"), "target_speed_mph")
    )


def advisory_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.advisory_agreement(Layers(spark, sf_dir).scored))


def policy_scores_64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network of the usual size."""
    rows = scoring.score_policy(Layers(spark, sf_dir).featured, wide_network(), "tanh")
    return edge(rows.select("window_start", "train_id", scoring.SCORE))


def score_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One network by Arrow batches and by columns, then two different networks."""
    layers = Layers(spark, sf_dir)
    keys = ["window_start", "train_id"]
    columns = scoring.score_columns(layers.featured, example_network())
    other = scoring.score_columns(layers.featured, other_network())
    same = scoring.score_parity(layers.scored, columns, keys)
    different = scoring.score_parity(layers.scored, other, keys)
    return same.withColumn("pair", F.lit("same network")).unionByName(
        different.withColumn("pair", F.lit("other network"))
    )


def network_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from derived signals and counted blocks."""
    rows = scoring.with_network_features(Layers(spark, sf_dir).occupancy)
    return edge(
        rows.select(
            "window_start",
            "train_id",
            *(F.col("obs")[i].alias(name) for i, name in enumerate(P.OBSERVATION)),
        )
    )


# --- evaluation ---------------------------------------------------------------


def step_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Layers(spark, sf_dir).steps.select(*REWARD_FIELDS)


def running_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, sf_dir)
    rows = ev.with_running_reward(layers.steps, layers.cfg)
    return rounded(
        rows.select("train_id", "event_id", "episode_no", "episode_step", "running_reward")
    )


def episode_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Layers(spark, sf_dir).episodes.drop("policy"))


def policy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.policy_metrics(Layers(spark, sf_dir).episodes))


def policy_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ev.policy_metrics(Layers(spark, sf_dir).episodes)
    return rounded(ev.compare_policies(metrics, "base"))


def metric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.histogram(Layers(spark, sf_dir).episodes))


# --- streaming ----------------------------------------------------------------


class _Feed:
    """A validated stream over freshly written deliveries, and folders for results.

    With ``late_period`` every such row comes three deliveries late, and each trigger
    reads one delivery.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, late_period: int | None = None) -> None:
        layers = Layers(spark, sf_dir)
        self.spark, self.base = spark, new_path(spark, "stream")
        rows_each = deliveries.rows_per_delivery(layers.log)
        files = deliveries.write_deliveries(layers.log, f"{self.base}/log", rows_each, late_period)
        self.log = log.read_event_stream(
            spark,
            "parquet",
            f"{self.base}/log",
            maxFilesPerTrigger="1" if late_period else deliveries.files_per_trigger(files),
            recursiveFileLookup="true",
        )
        self.silver = validate_events(parse_events(self.log))

    def at(self, name: str) -> str:
        return f"{self.base}/{name}"

    def occupancy(self, mode: str) -> str:
        path = self.at(f"occupancy_{mode}")
        with self.state():
            jobs.finish([jobs.start_occupancy(self.silver, path, self.at(f"check_{mode}"), mode)])
        return path

    def state(self):
        """State partitions to suit the cores, whatever the session shuffles with."""
        return jobs.state_settings(self.spark, self.spark.sparkContext.defaultParallelism)


def dashboard_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per train from the newest eight files of Gold."""
    path = _gold_in_turn(spark, sf_dir)
    return edge(dashboard.load_state(spark, path, f"{path}-sample")[0])


def dashboard_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-distance series from the newest twenty files of Gold."""
    path = _gold_in_turn(spark, sf_dir)
    return edge(dashboard.load_history(spark, path, f"{path}-sample"))


def _gold_in_turn(spark: SparkSession, sf_dir: str) -> str:
    """Gold as 25 files that came one after another; a window's file follows from its time."""
    path = new_path(spark, "gold")
    turn = F.expr("cast(unix_seconds(window_start) div 10 % 25 as int)")
    gold = Layers(spark, sf_dir).gold.withColumn("turn", turn)
    deliveries.write_in_turn(gold.repartition("turn"), path, "turn")
    return path


def stream_silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log to Bronze table to Silver table, with occupancy as a second sink."""
    feed = _Feed(spark, sf_dir)
    jobs.finish([jobs.start_bronze(feed.log, feed.at("bronze"), feed.at("check_bronze"))])
    bronze = tables.read_table_stream(
        spark,
        feed.at("bronze"),
        TRAIN_EVENT,
        maxFilesPerTrigger=deliveries.files_per_trigger(
            tables.list_files(spark, feed.at("bronze")).count()
        ),
    )
    with feed.state():
        jobs.finish(
            jobs.start_silver(bronze, feed.at("silver"), feed.at("occupancy"), feed.at("check"))
        )
    return edge(_flat_events(tables.read_table(spark, feed.at("silver"), schema=SILVER_EVENT)))


def stream_occupancy_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and occupancy committed together by one query; the second of them."""
    feed = _Feed(spark, sf_dir)
    path = feed.at("tables")
    jobs.finish([jobs.start_silver_and_occupancy(parse_events(feed.log), path, feed.at("check"))])
    return edge(jobs.read_silver_and_occupancy(spark, path)[1])


def stream_occupancy_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _Feed(spark, sf_dir).occupancy("append")
    return edge(tables.read_table(spark, path, schema=OCCUPANCY))


def stream_occupancy_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(sinks.read_complete(spark, _Feed(spark, sf_dir).occupancy("complete")))


def stream_occupancy_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _Feed(spark, sf_dir).occupancy("update")
    return edge(sinks.read_upserted(spark, path, jobs.occupancy_keys()))


def stream_keyed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from a log with offsets, half of it appended while the query is stopped."""
    layers, base = Layers(spark, sf_dir), new_path(spark, "keyed")
    half = F.pmod(F.col("n"), F.lit(2))
    for turn in (0, 1):
        rows = layers.log.where(half == turn)
        keyed_log.append_events(rows, f"{base}/log", ["timestamp", "n"])
        raw = log.read_event_stream(
            spark, keyed_log.FORMAT, f"{base}/log", startingOffsets="earliest", failOnDataLoss="true"
        )
        jobs.finish([jobs.start_bronze(raw, f"{base}/bronze", f"{base}/check")])
    return _bronze_columns(tables.read_table(spark, f"{base}/bronze", schema=TRAIN_EVENT))


LATE_PERIOD = 97


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows without the rows that came later than the watermark allows."""
    path = _Feed(spark, sf_dir, LATE_PERIOD).occupancy("append")
    return edge(tables.read_table(spark, path, schema=OCCUPANCY))


def stream_late_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the same stream drops."""
    feed = _Feed(spark, sf_dir, LATE_PERIOD)
    with LateRows(spark, feed.at("late")) as late, feed.state():
        query = jobs.start_occupancy(feed.silver, feed.at("occupancy"), feed.at("check"))
        jobs.finish([query])
        dropped = late.count(query)
    return spark.range(1).select(F.lit(dropped).cast("bigint").alias("n_dropped"))


def stream_step_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewards from state per train; of events the last watermark has passed."""
    feed = _Feed(spark, sf_dir)
    with feed.state():
        jobs.finish([jobs.start_step_rewards(feed.silver, feed.at("steps"), feed.at("check"))])
    return tables.read_table(spark, feed.at("steps")).select(*REWARD_FIELDS)


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _Feed(spark, sf_dir)
    closed = tables.read_table_stream(spark, feed.occupancy("append"), OCCUPANCY)
    jobs.finish([jobs.start_gold(closed, feed.at("gold"), feed.at("check_gold"))])
    return edge(tables.read_table(spark, feed.at("gold"), schema=GOLD))


def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of closed windows published with the network's advice."""
    feed = _Feed(spark, sf_dir)
    closed = tables.read_table_stream(spark, feed.occupancy("append"), OCCUPANCY)
    jobs.finish([jobs.start_gold(closed, feed.at("gold"), feed.at("check_gold"))])
    gold = tables.read_table_stream(spark, feed.at("gold"), GOLD)
    jobs.finish(
        [jobs.start_scored(gold, example_network(), feed.at("scored"), feed.at("check_scored"))]
    )
    rows = sinks.read_batches(spark, feed.at("scored"))
    return edge(rows.select("window_start", "train_id", "delay_severity", scoring.SCORE))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        bronze_parse,
        silver_validated,
        blocks_ahead_exploded,
        occupancy_sliding,
        gold_advisories,
        gold_fleet,
        advisory_sample,
        keyed_json_roundtrip,
        dq_bronze,
        dq_silver,
        dq_occupancy,
        dq_gold,
        dq_report,
        table_counts,
        rule_violations,
        derived_signals,
        derived_signals_fleet,
        blocks_ahead_list,
        blocks_ahead_count,
        next_block_free,
        occupied_blocks,
        shockwave_cascade,
        latest_per_train,
        track_map,
        advisory_feed,
        corridor_summary,
        marey_series,
        rl_overlay,
        absent_columns,
        keyed_log_order,
        union_by_name,
        recent_files_scan,
        dashboard_state,
        dashboard_history,
        policy_features,
        policy_scores,
        policy_scores_sql,
        policy_scores_64,
        network_features,
        rule_policy_actions,
        advisory_agreement,
        score_parity,
        step_rewards,
        running_reward,
        episode_metrics,
        policy_metrics,
        policy_compare,
        metric_histogram,
        stream_silver_append,
        stream_occupancy_from_silver,
        stream_occupancy_append,
        stream_occupancy_complete,
        stream_occupancy_update,
        stream_keyed_log,
        stream_late,
        stream_late_count,
        stream_step_rewards,
        stream_gold,
        stream_scored,
    )
}
