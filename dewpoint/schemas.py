"""Schemas and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

READING_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField(
            "window",
            T.StructType(
                [T.StructField("start", T.StringType()), T.StructField("end", T.StringType())]
            ),
        ),
        T.StructField("t_avg", T.DoubleType()),
        T.StructField("h_avg", T.DoubleType()),
        T.StructField("code", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

RULE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("humidity_min", T.DoubleType()),
        T.StructField("humidity_max", T.DoubleType()),
        T.StructField("temperature_min", T.DoubleType()),
        T.StructField("temperature_max", T.DoubleType()),
        T.StructField("code", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

WINDOW_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("t_avg", T.DoubleType()),
        T.StructField("h_avg", T.DoubleType()),
    ]
)

# The part of a broker message the operators use; file endpoints store the same.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BOUND_COLUMNS = ("humidity_min", "humidity_max", "temperature_min", "temperature_max")

# The bound that means "not checked", the four counted alert codes
# with their counter names and labels, and the four rules shipped by default.
NO_BOUND = -999
KNOWN_CODES = {"101": "too_dry", "102": "too_wet", "103": "too_cold", "104": "too_hot"}
CODE_LABELS = {"101": "Too dry", "102": "Too wet", "103": "Too cold", "104": "Too hot"}
DEFAULT_RULES = (
    (1, 0.0, 40.0, -999.0, -999.0, "101", "It's too dry"),
    (2, 60.0, 100.0, -999.0, -999.0, "102", "It's too wet"),
    (3, -999.0, -999.0, -300.0, 30.0, "103", "It's too cold"),
    (4, -999.0, -999.0, 40.0, 300.0, "104", "It's too hot"),
)

# Window length, slide and allowed lateness.
WINDOW_SIZE = "30 seconds"
WINDOW_SLIDE = "10 seconds"
WATERMARK = "5 seconds"
