"""Run one stage of the mart, for ``spark-submit`` or ``python -m ridemart``.

    lines   --base B --checkpoint C --source S --topic T --bootstrap-servers H  messages into Silver
    files   --base B --checkpoint C --source S --input F                        CSV files into Silver
    land    --output F --checkpoint C --topic T --bootstrap-servers H           messages into CSV files
    publish --input F --topic T --bootstrap-servers H                           CSV files as messages
    union | gold | export | run  --base B                                       the chain, or one step
    compact --base B                                                            small partitions into few
    sql     --base B --text "..."                                               statements separated by ;
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ridemart.operators.incremental import ROCKSDB, STATE_STORE
from ridemart.operators.serve import export_mart, register_mart, run_sql_script
from ridemart.plans.gold import build_gold
from ridemart.plans.mart import MartPaths, compact_mart, run_mart
from ridemart.plans.silver import union_silver
from ridemart.sources.rides import (
    parse_ride_lines, publish_rides, read_lines_stream, read_ride_files, split_ride_lines, stream_ride_files,
)
from ridemart.streaming.feeds import land_rides, start_feed


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ridemart", description="Stages of the trip mart.")
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, *required: str, messages: bool = False) -> argparse.ArgumentParser:
        sub = stages.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        if messages:
            sub.add_argument("--topic", required=True)
            sub.add_argument("--bootstrap-servers", default="localhost:9092")
            sub.add_argument("--starting-offsets", default="latest")
            sub.add_argument("--max-offsets", type=int, help="messages per trigger")
        return sub

    for sub in (
        stage("lines", "base", "checkpoint", "source", messages=True),
        stage("files", "base", "checkpoint", "source", "input"),
    ):
        sub.add_argument("--dedup", choices=("stored", "state"), default="stored")
        sub.add_argument("--max-files", type=int, default=5)
        sub.add_argument("--once", action="store_true", help="stop when the input is used up")
    land = stage("land", "output", "checkpoint", messages=True)
    land.add_argument("--every", default="10 seconds")
    stage("publish", "input", messages=True)
    for name in ("union", "gold", "compact", "export", "run"):
        stage(name, "base")
    sql = stage("sql", "base", "text")
    sql.add_argument("--rows", type=int, default=1000, help="rows to print of each result")
    return parser


def messages(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    """The lines of a topic, not parsed."""
    kafka = {
        "kafka.bootstrap.servers": options.bootstrap_servers, "subscribe": options.topic,
        "startingOffsets": options.starting_offsets,
    }
    if options.max_offsets:
        kafka["maxOffsetsPerTrigger"] = options.max_offsets
    return read_lines_stream(spark, "kafka", **kafka)


def run_stage(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.stage in ("lines", "files"):
        from_topic = options.stage == "lines"
        if from_topic:
            rides = parse_ride_lines(messages(spark, options))
        else:
            rides = stream_ride_files(spark, options.input, options.max_files)
        feed = MartPaths(options.base).feed(
            options.source, stream=from_topic, audit=options.dedup == "stored", dedup=options.dedup,
        )
        if options.dedup == "state":
            spark.conf.set(STATE_STORE, ROCKSDB)
        trigger = {"availableNow": True} if options.once else {}
        start_feed(rides, feed, options.checkpoint, **trigger).awaitTermination()
    elif options.stage == "land":
        lines = split_ride_lines(messages(spark, options))
        land_rides(lines, options.output, options.checkpoint, options.every).awaitTermination()
    elif options.stage == "publish":
        topic = {"kafka.bootstrap.servers": options.bootstrap_servers, "topic": options.topic}
        publish_rides(read_ride_files(spark, options.input), "kafka", **topic)
    elif options.stage == "sql":
        register_mart(spark, options.base)
        for result in run_sql_script(spark, options.text):
            result.show(options.rows, truncate=False)
    else:
        print(run_chain(spark, MartPaths(options.base), options.stage))


def run_chain(spark: SparkSession, paths: MartPaths, stage: str) -> object:
    if stage == "union":
        feeds = [paths.batch_output, paths.stream_output]
        return union_silver(spark, feeds, paths.unified, paths.unified_progress)
    if stage == "gold":
        return build_gold(spark, paths.unified, paths.gold, unique=True)
    if stage == "compact":
        return compact_mart(spark, paths)
    if stage == "export":
        return export_mart(spark, paths.base)
    return run_mart(spark, paths)


def main(argv: Sequence[str] | None = None) -> None:
    options = arguments().parse_args(argv)
    run_stage(SparkSession.builder.appName(f"ridemart-{options.stage}").getOrCreate(), options)


if __name__ == "__main__":
    main()
