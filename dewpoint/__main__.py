"""``python -m dewpoint watch|monitor``: the two jobs against Kafka or folders.

A name with a slash is a folder of message files, any other name a topic; an option
that does not apply to the one given is an error. Brokers and credentials come from the
``KAFKA_*`` environment variables.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql.streaming import StreamingQuery

from dewpoint import session
from dewpoint.operators import load_rules
from dewpoint.schemas import WATERMARK, WINDOW_SIZE, WINDOW_SLIDE
from dewpoint.sources import (
    AVAILABLE_NOW,
    ConsoleEndpoint,
    FileEndpoint,
    KafkaEndpoint,
    KafkaSettings,
    first_start,
)
from dewpoint.streaming import run, start_fan_out, start_monitor, supervise


def parser() -> argparse.ArgumentParser:
    commands = argparse.ArgumentParser(prog="dewpoint")
    jobs = commands.add_subparsers(dest="job", required=True)

    watch = jobs.add_parser("watch", help="readings to alerts")
    watch.add_argument("--readings", required=True, help="topic or folder with readings")
    watch.add_argument("--alerts", required=True, help="topic or folder for alerts")
    watch.add_argument("--rules", required=True, help="rule CSV all executors can read")
    watch.add_argument("--checkpoint", required=True)
    watch.add_argument("--size", default=WINDOW_SIZE)
    watch.add_argument("--slide", default=WINDOW_SLIDE)
    watch.add_argument("--watermark", default=WATERMARK)
    watch.add_argument("--trigger", default=None, help="interval or availableNow")
    watch.add_argument("--max-offsets", type=int, default=None, help="per micro-batch; topics")
    watch.add_argument("--min-partitions", type=int, default=None, help="reading tasks; topics")
    watch.add_argument("--quiet", action="store_true", help="nothing on the console")

    monitor = jobs.add_parser("monitor", help="alerts to the console")
    monitor.add_argument("--alerts", required=True, help="topic or folder with alerts")
    monitor.add_argument("--checkpoint", required=True)
    monitor.add_argument("--reports", default=None, help="topic or folder for all reports")
    monitor.add_argument("--statistics", default=None, help="topic or folder for the counts")
    monitor.add_argument("--group", default=None, help="start of the consumer group's name; topics")
    monitor.add_argument("--trigger", default=None, help="interval or availableNow")
    for job, start in ((watch, "earliest"), (monitor, "latest")):
        job.add_argument("--restarts", type=int, default=0, help="after failures in a row")
        job.add_argument("--pause", type=float, default=1.0, help="seconds before a restart")
        job.add_argument("--max-files", type=int, default=None, help="per micro-batch; folders")
        job.add_argument(
            "--start",
            choices=("earliest", "latest"),
            default=start,
            help="where a first start begins; later ones go on from the checkpoint",
        )
    return commands


def endpoint(
    name: str, *, max_files: int | None = None, start: str = "earliest", **topic_options
) -> KafkaEndpoint | FileEndpoint:
    """The topic or folder of a name. ``start`` on a folder is left to ``main``."""
    if "/" in name:
        wrong = [option for option, value in topic_options.items() if value is not None]
        if wrong:
            raise ValueError(f"{', '.join(wrong)}: for topics only, {name} is a folder")
        return FileEndpoint(name, max_files=max_files)
    if max_files is not None:
        raise ValueError(f"max_files: for folders only, {name} is a topic")
    return KafkaEndpoint(
        KafkaSettings.from_env(), name, starting_offsets=start, **topic_options
    )


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    common = {"max_files": args.max_files, "start": args.start}
    if args.job == "watch":
        source = endpoint(
            args.readings,
            max_offsets=args.max_offsets,
            min_partitions=args.min_partitions,
            **common,
        )
    else:
        source = endpoint(args.alerts, group_prefix=args.group, **common)
    spark = session.build(f"dewpoint-{args.job}")
    try:
        if isinstance(source, FileEndpoint) and args.start == "latest":
            source = replace(source, since=first_start(spark, args.checkpoint))
        console = [] if args.job == "monitor" or args.quiet else [ConsoleEndpoint()]
        if console:
            load_rules(spark, args.rules).show()

        def watch() -> list[StreamingQuery]:
            return [
                start_fan_out(
                    spark,
                    source,
                    args.rules,
                    checkpoint=args.checkpoint,
                    alerts_to=[endpoint(args.alerts), *console],
                    windows_to=console,
                    size=args.size,
                    slide=args.slide,
                    watermark=args.watermark,
                    trigger=args.trigger,
                )
            ]

        def monitor() -> list[StreamingQuery]:
            return start_monitor(
                spark,
                source,
                checkpoint=args.checkpoint,
                reports_to=endpoint(args.reports) if args.reports else ConsoleEndpoint(),
                statistics_to=endpoint(args.statistics) if args.statistics else ConsoleEndpoint(),
                trigger=args.trigger,
            )

        start = watch if args.job == "watch" else monitor
        if args.restarts:
            supervise(spark, start, restarts=args.restarts, pause=args.pause)
            return
        queries = start()
        if args.trigger == AVAILABLE_NOW:
            for query in queries:
                query.awaitTermination()
        else:
            run(spark, queries)
    except KeyboardInterrupt:
        pass
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
