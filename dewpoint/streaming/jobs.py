"""Starting, awaiting and stopping the alerting and monitoring queries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from dewpoint.operators import (
    counts_row,
    decode_alerts,
    each_once,
    encode_alerts,
    format_alerts,
    format_counts,
    load_rules,
    running_counts,
)
from dewpoint.plans import alerts_of, windows_of
from dewpoint.schemas import KNOWN_CODES, WATERMARK, WINDOW_SIZE, WINDOW_SLIDE
from dewpoint.sources import (
    AVAILABLE_NOW,
    ConsoleEndpoint,
    FileEndpoint,
    KafkaEndpoint,
    read_stream,
    write_batch,
    write_stream,
)
from dewpoint.sources.endpoints import Endpoint


def start_fan_out(
    spark: SparkSession,
    source: KafkaEndpoint | FileEndpoint,
    rules_path: str,
    *,
    checkpoint: str,
    alerts_to: Sequence[Endpoint],
    windows_to: Sequence[Endpoint] = (),
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
    trigger: str | None = None,
    measured: bool = False,
) -> StreamingQuery:
    """One query that reads the input once, keeps one state and writes every sink.

    The rule file is read, and its size checked, in every micro-batch that closes
    windows, so an edit shows in the next one. All alerts of a batch carry the same
    time. Sinks see a batch at least once; a topic may hold an alert twice after a
    failure, under the same window and code. ``measured`` is for ``BatchMeasurements``.
    """
    windows = windows_of(
        read_stream(spark, source),
        size=size,
        slide=slide,
        watermark=watermark,
        measured=measured,
    )

    def publish(closed: DataFrame, batch_id: int) -> None:
        now = datetime.now(timezone.utc)
        closed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Most batches close no window; counting also completes their state.
            if closed.count() == 0:
                return
            for sink in windows_to:
                write_batch(closed, sink, batch_id)
            if not alerts_to:
                return
            # Matched once: all sinks get the same alerts, also if the file is edited.
            alerts = alerts_of(closed, load_rules(closed.sparkSession, rules_path), now)
            alerts.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                for sink in alerts_to:
                    shown = alerts if isinstance(sink, ConsoleEndpoint) else encode_alerts(alerts)
                    write_batch(shown, sink, batch_id)
            finally:
                alerts.unpersist()
        finally:
            closed.unpersist()

    writer = (
        windows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    return _triggered(writer, trigger).start()


def start_separate(
    spark: SparkSession,
    source: KafkaEndpoint | FileEndpoint,
    rules_path: str,
    *,
    checkpoint: str,
    alerts_to: KafkaEndpoint | FileEndpoint,
    console: ConsoleEndpoint = ConsoleEndpoint(),
    alerts_shown: Endpoint | None = None,
    windows_shown: Endpoint | None = None,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
    trigger: str | None = None,
) -> list[StreamingQuery]:
    """Three queries: alerts to a topic or files, alerts and windows to the console.

    Each reads the input and keeps the state on its own; ``start_fan_out`` does not. Like
    there, the rules are read and measured in every micro-batch that closes windows, so a
    rule added to the file later gives its alerts. ``alerts_shown`` and ``windows_shown``
    replace the console, which keeps its own interval unless a ``trigger`` is given.
    """
    root = checkpoint.rstrip("/")

    def start(name: str, **sinks: Sequence[Endpoint]) -> StreamingQuery:
        (sink,) = [s for chosen in sinks.values() for s in chosen]
        every = trigger or (sink.trigger if isinstance(sink, ConsoleEndpoint) else None)
        return start_fan_out(
            spark,
            source,
            rules_path,
            checkpoint=f"{root}/{name}",
            size=size,
            slide=slide,
            watermark=watermark,
            trigger=every,
            **({"alerts_to": ()} | sinks),
        )

    return [
        start("alerts", alerts_to=[alerts_to]),
        start("alerts-console", alerts_to=[alerts_shown or console]),
        start("windows-console", windows_to=[windows_shown or console]),
    ]


def start_running_counts(
    spark: SparkSession,
    source: KafkaEndpoint | FileEndpoint,
    *,
    checkpoint: str,
    counted_to: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Every alert of a stream with the counts per code and the total up to and including it.

    Alerts are taken in order of their micro-batches, within a batch as ``running_counts``
    takes them. A batch's alerts go to ``counted_to/alerts/batch_id=N`` with their counts,
    its own totals, a row, to ``counted_to/totals/batch_id=N``. The counts start at the
    totals of the batches before, so they go on after a restart, and a batch that is
    delivered again replaces what it wrote. No state is kept per alert: the ledger of
    totals has a row a batch, and their sum is the count of all alerts so far (see
    ``ledger_counts``).
    """
    alerts = decode_alerts(read_stream(spark, source))
    names = [*KNOWN_CODES.values(), "total"]

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = _totals(session, counted_to).filter(F.col("batch_id") < batch_id)
            start = before.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
            counted = running_counts(batch).withColumns(
                {n: F.col(n) + F.lit(start[n]) for n in names}
            )
            counted.write.mode("overwrite").parquet(f"{counted_to}/alerts/batch_id={batch_id}")
            # The totals come last: without them the batch has not been counted.
            counts_row(batch).write.mode("overwrite").parquet(
                f"{counted_to}/totals/batch_id={batch_id}"
            )
        finally:
            batch.unpersist()

    writer = alerts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
    return _triggered(writer, trigger).start()


def _totals(spark: SparkSession, counted_to: str) -> DataFrame:
    schema = ", ".join(f"{name} long" for name in (*KNOWN_CODES.values(), "total", "batch_id"))
    try:
        return spark.read.schema(schema).parquet(f"{counted_to}/totals")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def ledger_counts(spark: SparkSession, counted_to: str) -> DataFrame:
    """``code, alerts`` of all batches that ``start_running_counts`` has counted.

    Adds up a row a batch; codes that no alert had are left out, as in ``count_by_code``.
    """
    sums = _totals(spark, counted_to).agg(*[F.sum(n).alias(n) for n in KNOWN_CODES.values()])
    pairs = [
        F.struct(F.lit(code).alias("code"), F.col(name).alias("alerts"))
        for code, name in KNOWN_CODES.items()
    ]
    return sums.select(F.inline(F.array(*pairs))).filter("alerts > 0")


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def start_monitor(
    spark: SparkSession,
    source: KafkaEndpoint | FileEndpoint,
    *,
    checkpoint: str,
    reports_to: Endpoint = ConsoleEndpoint(),
    statistics_to: Endpoint = ConsoleEndpoint(),
    delay: str | None = None,
    trigger: str | None = None,
) -> list[StreamingQuery]:
    """Two queries over the alert sink: each alert's report, and the counts so far.

    A topic or folder gets every report and, per micro-batch, the statistics, as messages
    with their line breaks. A console is a preview: it shows the first ``rows`` of
    a batch, on one line each. Counting is a second aggregation after the windows, which
    one query cannot do, so it works on the written alerts; an alert that was delivered
    again counts once (see ``each_once`` for ``delay``). The counts survive a restart.
    """
    alerts = decode_alerts(read_stream(spark, source))
    root = checkpoint.rstrip("/")
    counts = format_counts(counts_row(each_once(alerts, delay)))
    return [
        _start_texts(
            format_alerts(alerts), "report", reports_to, f"{root}/reports", "append", trigger
        ),
        _start_texts(
            counts, "statistics", statistics_to, f"{root}/statistics", "complete", trigger
        ),
    ]


def _start_texts(
    df: DataFrame, column: str, sink: Endpoint, checkpoint: str, mode: str, trigger: str | None
) -> StreamingQuery:
    """Texts to a console as they are, to a topic or folder as message values."""
    if isinstance(sink, ConsoleEndpoint):
        return write_stream(
            df.select(column), sink, checkpoint=checkpoint, mode=mode, trigger=trigger
        )
    writer = (
        df.select(df[column].alias("value"))
        .writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, sink, batch_id))
    )
    return _triggered(writer, trigger).start()


def run(
    spark: SparkSession, queries: Sequence[StreamingQuery], timeout: int | None = None
) -> bool | None:
    """Wait until any query ends or fails (or ``timeout`` seconds), then stop them all."""
    try:
        if timeout is None:
            return spark.streams.awaitAnyTermination()
        return spark.streams.awaitAnyTermination(timeout)
    finally:
        for query in queries:
            query.stop()
