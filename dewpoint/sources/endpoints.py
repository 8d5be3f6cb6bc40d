"""Endpoints: descriptions of a source or sink, and the calls that open them.

A topic and a folder of files are interchangeable: both hold messages with
``key``, ``value`` and ``timestamp``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from dewpoint.schemas import ENVELOPE_SCHEMA
from dewpoint.sources.kafka import KafkaSettings, kafka_options

AVAILABLE_NOW = "availableNow"


@dataclass(frozen=True)
class KafkaEndpoint:
    """A topic. Offsets apply to a first start; later ones come from the checkpoint.

    ``max_offsets`` bounds one micro-batch, so that starting at the earliest offset
    of a long topic does not become a single batch. ``min_partitions`` splits topic
    partitions over more tasks. ``group_prefix`` begins the consumer group's name;
    the rest is generated, because queries sharing a group disturb each other.
    """

    settings: KafkaSettings
    topic: str
    starting_offsets: str = "earliest"
    group_prefix: str | None = None
    max_offsets: int | None = None
    min_partitions: int | None = None

    def source_options(self) -> dict[str, str]:
        options = kafka_options(self.settings) | {
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
        }
        if self.group_prefix:
            options["groupIdPrefix"] = self.group_prefix
        if self.max_offsets:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def sink_options(self) -> dict[str, str]:
        return kafka_options(self.settings) | {"topic": self.topic}


@dataclass(frozen=True)
class FileEndpoint:
    """A folder of files; ``schema`` is that of messages unless given.

    ``max_files`` bounds one micro-batch. ``since`` leaves out messages written earlier or
    without a time: with a job's ``first_start`` that job begins at the latest message.
    """

    path: str
    format: str = "parquet"
    schema: T.StructType | str = ENVELOPE_SCHEMA
    glob: str | None = None
    max_files: int | None = None
    since: datetime | None = None

    def source_options(self) -> dict[str, str]:
        # Folders per micro-batch are no partition columns: a stream that started
        # before the first of them would stop at the unexpected column.
        options = {"recursiveFileLookup": "true"}
        if self.glob:
            options["pathGlobFilter"] = self.glob
        if self.max_files:
            options["maxFilesPerTrigger"] = str(self.max_files)
        return options


@dataclass(frozen=True)
class ConsoleEndpoint:
    """The driver's console; shows the first ``rows`` rows of each batch."""

    truncate: bool = False
    rows: int = 20
    trigger: str = "10 seconds"


Endpoint = KafkaEndpoint | FileEndpoint | ConsoleEndpoint


def read_stream(spark: SparkSession, source: KafkaEndpoint | FileEndpoint) -> DataFrame:
    """The messages of a source as a stream."""
    return _open(spark.readStream, source)


def read_batch(spark: SparkSession, source: KafkaEndpoint | FileEndpoint) -> DataFrame:
    """The messages a source holds now; a folder that no batch has made yet holds none."""
    try:
        return _open(spark.read, source)
    except AnalysisException as problem:
        if isinstance(source, FileEndpoint) and problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], source.schema)
        raise


def _open(
    reader: DataFrameReader | DataStreamReader, source: KafkaEndpoint | FileEndpoint
) -> DataFrame:
    if isinstance(source, KafkaEndpoint):
        return reader.format("kafka").options(**source.source_options()).load()
    found = (
        reader.format(source.format)
        .schema(source.schema)
        .options(**source.source_options())
        .load(source.path)
    )
    return found if source.since is None else found.filter(F.col("timestamp") >= source.since)


def first_start(spark: SparkSession, checkpoint: str) -> datetime:
    """When the job with this checkpoint folder first asked, kept as a file in the folder.

    A restarted job gets the time of its first start, so that it reads what was written
    while it was stopped.
    """
    path = f"{checkpoint.rstrip('/')}/first-start"
    try:
        known = spark.read.schema("micros long").parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        now = F.unix_micros(F.current_timestamp()).alias("micros")
        spark.range(1).select(now).write.parquet(path)
        known = spark.read.schema("micros long").parquet(path)
    return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=known.first()[0])


def write_stream(
    df: DataFrame,
    sink: Endpoint,
    *,
    checkpoint: str | None = None,
    mode: str = "append",
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that writes ``df`` to a sink.

    ``trigger`` is an interval, ``"availableNow"`` or None (as fast as possible; a
    console keeps its own interval). Topics and files need an explicit checkpoint
    folder: under a generated one a restarted query would read its input again.
    """
    if checkpoint is None and not isinstance(sink, ConsoleEndpoint):
        raise ValueError("a persistent sink needs a checkpoint folder")
    if isinstance(sink, KafkaEndpoint):
        writer = df.writeStream.format("kafka").options(**sink.sink_options())
    elif isinstance(sink, FileEndpoint):
        writer = _stamped(df).writeStream.format(sink.format).option("path", sink.path)
    else:
        writer = (
            df.writeStream.format("console")
            .option("truncate", sink.truncate)
            .option("numRows", sink.rows)
        )
        trigger = trigger or sink.trigger
    writer = writer.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if trigger == AVAILABLE_NOW:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def write_batch(df: DataFrame, sink: Endpoint, batch_id: int | None = None) -> None:
    """Write a batch to a sink.

    With a ``batch_id``, files go to a ``batch_id=N`` folder of their own that is
    overwritten, so a batch repeated after a failure leaves no duplicates there.
    """
    if isinstance(sink, KafkaEndpoint):
        df.write.format("kafka").options(**sink.sink_options()).save()
    elif isinstance(sink, FileEndpoint):
        path, mode = sink.path, "append"
        if batch_id is not None:
            path, mode = f"{path.rstrip('/')}/batch_id={batch_id}", "overwrite"
        _stamped(df).write.format(sink.format).mode(mode).save(path)
    else:
        df.show(sink.rows, truncate=sink.truncate)


def _stamped(df: DataFrame) -> DataFrame:
    """Messages in the stored schema, stamped with the time of writing as by a broker."""
    if "value" not in df.columns or "timestamp" in df.columns:
        return df
    key = F.col("key") if "key" in df.columns else F.lit(None)
    return df.select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
