"""Signals and lookahead from which blocks are occupied at the same instant.

A snapshot is all rows that agree on ``cfg.snapshot_keys``. Occupancy is first
reduced to one row per snapshot whose size is limited by the number of blocks,
then brought back to the trains with ``attach_by_key``; trains are never paired
with trains.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor.config import DEFAULT, CorridorConfig
from corridor.functions.ring import block_name, ring
from corridor.operators.lookup import attach_by_key

LOOKAHEAD = 2
WORD_BITS = 64


def _on_corridor(cfg: CorridorConfig) -> Column:
    return F.col("block_idx").between(0, cfg.n_blocks - 1)


def occupied_blocks(snapshot: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Distinct occupied blocks per snapshot."""
    return snapshot.select(*cfg.snapshot_keys, "block_idx").distinct()


def _words(cfg: CorridorConfig) -> range:
    """Numbers of the 64-bit words that hold one bit per block."""
    return range(-(-cfg.n_blocks // WORD_BITS))


def _with_occupied(snapshot: DataFrame, cfg: CorridorConfig) -> DataFrame:
    """Add the occupied blocks of each row's snapshot as bits: fixed size, hash aggregated."""
    idx = F.col("block_idx")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(idx, F.lit(WORD_BITS)))
    per_snapshot = snapshot.groupBy(*cfg.snapshot_keys).agg(
        *(
            F.bit_or(
                F.when(_on_corridor(cfg) & (F.floor(idx / WORD_BITS) == w), bit).otherwise(
                    F.lit(0).cast("bigint")
                )
            ).alias(f"_word_{w}")
            for w in _words(cfg)
        ),
    )
    return attach_by_key(snapshot, per_snapshot, cfg.snapshot_keys)


def _is_occupied(k: int, cfg: CorridorConfig) -> Column:
    at = ring(F.col("block_idx"), k, cfg.n_blocks)
    taken = [
        (F.floor(at / WORD_BITS) == w)
        & (F.getbit(f"_word_{w}", F.pmod(at, F.lit(WORD_BITS))) == 1)
        for w in _words(cfg)
    ]
    return reduce(lambda a, b: a | b, taken)


def _drop_occupied(df: DataFrame, cfg: CorridorConfig) -> DataFrame:
    return df.drop(*(f"_word_{w}" for w in _words(cfg)))


def network_state(snapshot: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add what a train sees ahead: ``derived_aspect`` and ``n_ahead``.

    The aspect is stop before an occupied block and approach one block earlier; the
    number counts the occupied ones of the next two blocks.
    """
    aspect = (
        F.when(_is_occupied(1, cfg), "stop")
        .when(_is_occupied(2, cfg), "approach")
        .otherwise("clear")
    )
    count = sum(_is_occupied(k, cfg).cast("int") for k in range(1, LOOKAHEAD + 1))
    known = _with_occupied(snapshot, cfg)
    return _drop_occupied(known.withColumns({"derived_aspect": aspect, "n_ahead": count}), cfg)


def derive_signals(snapshot: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add ``derived_aspect``: stop before an occupied block, approach one block earlier."""
    return network_state(snapshot, cfg).drop("n_ahead")


def blocks_ahead_count(snapshot: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """Add ``n_ahead``: how many of the next two blocks are occupied."""
    return network_state(snapshot, cfg).drop("derived_aspect")


def next_block_free(snapshot: DataFrame, cfg: CorridorConfig = DEFAULT) -> DataFrame:
    """The trains that may advance: nobody stands in their next block."""
    known = _with_occupied(snapshot, cfg)
    return _drop_occupied(known.where(~_is_occupied(1, cfg)), cfg)


def _with_holders(snapshot: DataFrame, cfg: CorridorConfig) -> DataFrame:
    """Add ``holders``, a map from occupied block to its train (the last id wins)."""
    per_block = (
        snapshot.where(_on_corridor(cfg))
        .groupBy(*cfg.snapshot_keys, "block_idx")
        .agg(F.max("train_id").alias("holder"))
    )
    # At most n_blocks entries per snapshot.
    per_snapshot = per_block.groupBy(*cfg.snapshot_keys).agg(
        F.map_from_entries(F.collect_list(F.struct("block_idx", "holder"))).alias("holders")
    )
    return attach_by_key(snapshot, per_snapshot, cfg.snapshot_keys)


def blocks_ahead(
    snapshot: DataFrame,
    cfg: CorridorConfig = DEFAULT,
    depth: int = LOOKAHEAD,
    wrap: bool = False,
) -> DataFrame:
    """One row per train and occupied block within ``depth``, the train itself excluded.

    Without ``wrap`` the corridor ends after its last block.
    """
    n = cfg.n_blocks
    idx = F.col("block_idx")

    def candidate(k: int) -> Column:
        at = ring(idx, k, n) if wrap else idx + k
        return F.struct(
            F.lit(k).alias("ahead"),
            at.alias("ahead_block_idx"),
            F.try_element_at("holders", at).alias("occupying_train"),
        )

    return (
        _with_holders(snapshot, cfg)
        .select(
            *cfg.snapshot_keys,
            "train_id",
            "block_idx",
            F.inline(F.array(*(candidate(k) for k in range(1, depth + 1)))),
        )
        .where(F.col("occupying_train") != F.col("train_id"))
        .withColumn("ahead_block_id", block_name(F.col("ahead_block_idx")))
    )


def shockwave_cascade(
    gold: DataFrame, cfg: CorridorConfig = DEFAULT, sec_per_block: float = 60.0, ahead: int = 1
) -> DataFrame:
    """Delay handed to the followers of a stopped train, per snapshot, around the ring.

    ``gap * (speed lost by the leader / line speed)``, the gap being the blocks to the
    leader times ``sec_per_block``. Each row looks at the ``ahead`` trains in front of it
    and takes the largest delay; ``lead_train`` is the one directly in front (null for a
    train alone). Each occupied block is represented by the train with the last id, so a
    snapshot has at most ``n_blocks`` rows when it is put in block order.
    """
    state = F.struct("train_id", "speed_mph", "signal_aspect")
    per_block = (
        gold.where(_on_corridor(cfg))
        .groupBy(*cfg.snapshot_keys, "block_idx")
        .agg(F.max(state).alias("state"))
        .select(*cfg.snapshot_keys, "block_idx", "state.*")
    )
    whole = Window.partitionBy(*cfg.snapshot_keys)
    in_order = F.array_sort(
        F.collect_list(F.struct("block_idx", "train_id", "speed_mph", "signal_aspect")).over(whole)
    )
    limit = F.lit(float(cfg.max_speed_mph))
    placed = per_block.withColumn("_ring", in_order)
    place = F.array_position(
        F.transform("_ring", lambda t: t["block_idx"]), F.col("block_idx")
    ).cast("int")
    size = F.size("_ring")
    leaders = []
    for k in range(1, ahead + 1):
        lead = F.element_at("_ring", F.pmod(place - 1 + k, size) + 1)
        leaders.append(F.when(size > k, lead))

    def delay(lead: Column) -> Column:
        blocks = F.pmod(lead["block_idx"] - F.col("block_idx"), F.lit(cfg.n_blocks))
        lost = (limit - lead["speed_mph"]) / limit
        return F.when(
            lead["signal_aspect"] == "stop", blocks * F.lit(sec_per_block) * lost
        ).otherwise(F.lit(0.0))

    delays = [delay(lead) for lead in leaders]
    return placed.select(
        *cfg.snapshot_keys,
        "block_idx",
        "train_id",
        leaders[0]["train_id"].alias("lead_train"),
        (delays[0] if ahead == 1 else F.greatest(*delays)).alias("cascade_delay_sec"),
    )
