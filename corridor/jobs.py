"""Run one stage until it is stopped: ``python -m corridor.jobs STAGE OPTIONS``.

A stage reads its predecessor's table as a stream and goes on from its checkpoint. It ends
on SIGTERM or Ctrl-C, after the batch it is working on; with ``--available-now`` when
everything that is there has been worked on. A failed query ends the process with code 1.
Session settings come from ``spark-submit`` or ``spark-defaults.conf``.
"""

from __future__ import annotations

import argparse
import json
import signal
import sys
import threading
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from corridor.operators.scoring import Layer
from corridor.schema import GOLD, OCCUPANCY, TRAIN_EVENT
from corridor.session import prepare
from corridor.sources.folders import Folder
from corridor.sources.log import read_event_stream
from corridor.sources.tables import read_table_stream
from corridor.streaming import jobs

STAGES = ("bronze", "silver", "occupancy-update", "tables", "gold", "scored", "step-rewards")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="corridor.jobs", description=__doc__.splitlines()[0])
    out.add_argument("stage", choices=STAGES)
    out.add_argument("--source", help="table or log to read; not needed for kafka")
    out.add_argument("--source-format", default="parquet", help="of the log: kafka, keyed_log, ...")
    out.add_argument("--start", help="startingOffsets of the log; new rows by default")
    out.add_argument("--out", required=True, help="folder of the table to write")
    out.add_argument("--occupancy-out", help="silver: folder of the second table")
    out.add_argument("--checkpoint", required=True)
    out.add_argument("--format", default="parquet", help="of the tables")
    out.add_argument("--every", default="10 seconds", help="time between triggers")
    out.add_argument("--available-now", action="store_true", help="stop at the end of the source")
    out.add_argument("--state-partitions", type=int, default=200, help="fixed by the first start")
    out.add_argument("--network", help="scored: JSON file with layers and activation")
    out.add_argument("--grace", type=float, default=60.0, help="seconds a batch may take to end")
    return out


def read_network(spark: SparkSession, path: str) -> tuple[tuple[Layer, ...], str]:
    """Layers and activation from ``{"activation": .., "layers": [{"weights", "bias"}]}``."""
    folder, name = path.rsplit("/", 1)
    found = json.loads(Folder(spark, folder).read(name))
    layers = tuple(
        Layer(tuple(map(tuple, layer["weights"])), tuple(layer["bias"])) for layer in found["layers"]
    )
    return layers, found.get("activation", "relu")


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Start the queries of a stage."""
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.every}
    to = {"fmt": args.format, "trigger": trigger}

    def source(schema):
        return read_table_stream(spark, args.source, schema, args.format)

    match args.stage:
        case "bronze":
            options = {"startingOffsets": args.start} if args.start else {}
            raw = read_event_stream(spark, args.source_format, args.source, **options)
            return [jobs.start_bronze(raw, args.out, args.checkpoint, **to)]
        case "silver":
            return list(
                jobs.start_silver(
                    source(TRAIN_EVENT), args.out, args.occupancy_out, args.checkpoint, **to
                )
            )
        case "occupancy-update":
            silver = jobs.validate_events(source(TRAIN_EVENT))
            return [jobs.start_occupancy(silver, args.out, args.checkpoint, "update", **to)]
        case "tables":
            events = source(TRAIN_EVENT)
            return [jobs.start_silver_and_occupancy(events, args.out, args.checkpoint, **to)]
        case "gold":
            return [jobs.start_gold(source(OCCUPANCY), args.out, args.checkpoint, **to)]
        case "scored":
            layers, activation = read_network(spark, args.network)
            return [
                jobs.start_scored(
                    source(GOLD), layers, args.out, args.checkpoint, activation=activation, **to
                )
            ]
        case _:
            silver = jobs.validate_events(source(TRAIN_EVENT))
            return [jobs.start_step_rewards(silver, args.out, args.checkpoint, **to)]


def main(argv: Sequence[str] | None = None) -> int:
    cli = parser()
    args = cli.parse_args(argv)
    if args.stage == "silver" and not args.occupancy_out:
        cli.error("silver writes two tables: --occupancy-out is missing")
    if args.stage == "scored" and not args.network:
        cli.error("scored needs --network")
    if not args.source and not (args.stage == "bronze" and args.source_format == "kafka"):
        cli.error("--source is missing")
    stop = threading.Event()
    for name in (signal.SIGTERM, signal.SIGINT):
        signal.signal(name, lambda *_: stop.set())
    builder = SparkSession.builder.appName(f"corridor-{args.stage}").config("spark.ui.enabled", "false")
    spark = prepare(builder.getOrCreate())
    jobs.prepare_state(spark, args.state_partitions)
    try:
        jobs.run_until_stopped(start(spark, args), stop, grace_sec=args.grace)
    except PySparkException as error:
        print(f"corridor-{args.stage}: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
