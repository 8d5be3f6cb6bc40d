"""Where messages come from and go to."""

from dewpoint.sources.endpoints import (
    AVAILABLE_NOW,
    ConsoleEndpoint,
    FileEndpoint,
    KafkaEndpoint,
    first_start,
    read_batch,
    read_stream,
    write_batch,
    write_stream,
)
from dewpoint.sources.kafka import KafkaSettings, kafka_options

__all__ = [
    "AVAILABLE_NOW",
    "ConsoleEndpoint",
    "FileEndpoint",
    "KafkaEndpoint",
    "KafkaSettings",
    "first_start",
    "kafka_options",
    "read_batch",
    "read_stream",
    "write_batch",
    "write_stream",
]
