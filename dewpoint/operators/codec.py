"""JSON messages to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dewpoint.schemas import ALERT_SCHEMA, READING_SCHEMA


def decode_readings(messages: DataFrame) -> DataFrame:
    """Messages (``value``, ``timestamp``) to typed readings, one row per message.

    Unreadable text gives nulls instead of an error, and so does an unreadable
    event time.
    """
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), READING_SCHEMA).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    reading = F.struct(
        F.col("data.id").alias("sensor_id"),
        F.col("data.temperature").alias("temperature"),
        F.col("data.humidity").alias("humidity"),
        F.try_to_timestamp(F.col("data.timestamp")).alias("event_time"),
    )
    return parsed.select(_fields(reading), "kafka_timestamp")


def _fields(record: Column) -> Column:
    """The fields of a struct as columns; a null struct gives nulls.

    Filters on fields taken with ``data.x`` are pushed below the projection that
    parses the text, and each of them parses it again. They stop at a generator.
    """
    return F.inline(F.array(record))


def encode_readings(readings: DataFrame, key: str | None = "id") -> DataFrame:
    """Readings (``id, temperature, humidity, timestamp``) to keyed JSON messages.

    ``key`` names the column that becomes the message key; None leaves it null.
    A ``timestamp`` column that is not text is written as ISO-8601.
    """
    time = F.col("timestamp")
    if not isinstance(readings.schema["timestamp"].dataType, T.StringType):
        time = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = F.struct(
        F.col("id").cast("string").alias("id"),
        F.col("temperature"),
        F.col("humidity"),
        time.alias("timestamp"),
    )
    message_key: Column = F.lit(None) if key is None else F.col(key)
    return readings.select(
        message_key.cast("string").alias("key"), F.to_json(fields).alias("value")
    )


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts to one JSON ``value`` each, with the fields in schema order."""
    return alerts.select(F.to_json(F.struct(*ALERT_SCHEMA.fieldNames())).alias("value"))


def decode_alerts(messages: DataFrame) -> DataFrame:
    """JSON messages to alert columns; unreadable text gives a row of nulls."""
    return messages.select(_fields(F.from_json(F.col("value").cast("string"), ALERT_SCHEMA)))
