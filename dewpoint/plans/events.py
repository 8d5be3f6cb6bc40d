"""The ``events`` table seen as sensor readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dewpoint.operators import encode_readings

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def event_readings(events: DataFrame) -> DataFrame:
    """The user as sensor, ``value`` as temperature and ``props.k`` as humidity."""
    return events.select(
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("value").alias("temperature"),
        F.from_json("props", "k INT").getField("k").cast("double").alias("humidity"),
        # Watermarks need an instant, not a zoneless timestamp.
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def event_messages(events: DataFrame, key: str | None = "id") -> DataFrame:
    """The same readings as JSON messages, without a time of arrival."""
    readings = event_readings(events).select(
        F.col("sensor_id").alias("id"),
        "temperature",
        "humidity",
        F.col("event_time").alias("timestamp"),
    )
    return encode_readings(readings, key).withColumn(
        "timestamp", F.lit(None).cast("timestamp")
    )
