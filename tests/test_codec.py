import json
import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dewpoint.operators import (
    count_by_code,
    decode_alerts,
    decode_readings,
    encode_alerts,
    encode_readings,
    shape_alerts,
    sliding_averages,
)
from dewpoint.schemas import READING_SCHEMA

NO_SHRINK = [Phase.explicit, Phase.generate]
READING = '{"id":"a","temperature":1.5,"humidity":2.5,"timestamp":"2024-11-24T12:00:00"}'


def decode_one(spark, value):
    messages = spark.createDataFrame([(value,)], "value string").withColumn(
        "timestamp", F.lit("2024-11-24 13:00:00").cast("timestamp")
    )
    rows = decode_readings(messages).collect()
    assert len(rows) == 1
    return rows[0]


def test_reading(spark):
    row = decode_one(spark, READING)
    assert tuple(row) == (
        "a",
        1.5,
        2.5,
        datetime(2024, 11, 24, 12),
        datetime(2024, 11, 24, 13),
    )


def test_binary_payload(spark):
    messages = spark.createDataFrame([(READING.encode(),)], "value binary").withColumn(
        "timestamp", F.current_timestamp()
    )
    assert decode_readings(messages).first()["sensor_id"] == "a"


@pytest.mark.parametrize(
    "value", ["garbage", '[{"id":"q"}]', None, "", "{}", '{"unrelated":1}']
)
def test_unreadable_gives_nulls(spark, value):
    row = decode_one(spark, value)
    assert (row.sensor_id, row.temperature, row.humidity, row.event_time) == (None,) * 4


def test_wrong_fields(spark):
    row = decode_one(spark, '{"id":5,"temperature":"x","humidity":2.0,"timestamp":"bad"}')
    assert (row.sensor_id, row.temperature, row.humidity, row.event_time) == ("5", None, 2.0, None)
    assert decode_one(spark, '{"temperature":"45"}').temperature is None
    assert decode_one(spark, READING[:-1] + ',"extra":[1,2]}').sensor_id == "a"


def test_text_is_parsed_once(spark):
    messages = spark.range(9).select(
        F.format_string('{"code":"%d"}', "id").alias("value"),
        F.current_timestamp().alias("timestamp"),
    )
    frames = [
        sliding_averages(decode_readings(messages)),
        count_by_code(decode_alerts(messages)),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("from_json") == 1


def test_unusual_numbers(spark):
    assert math.isnan(decode_one(spark, '{"temperature":NaN}').temperature)
    assert decode_one(spark, '{"temperature":1e400}').temperature == math.inf


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-11-24T12:00:00+02:00", datetime(2024, 11, 24, 10)),
        ("2024-11-24T12:00:00.123456", datetime(2024, 11, 24, 12, 0, 0, 123456)),
        ("2024-11-24 12:00:00", datetime(2024, 11, 24, 12)),
        ("12:99", None),
    ],
)
def test_event_time(spark, text, expected):
    assert decode_one(spark, json.dumps({"timestamp": text})).event_time == expected


def test_encode_readings(spark):
    readings = spark.createDataFrame([("s1", 1.25, 50.0, "2024-11-24T12:00:00")], READING_SCHEMA)
    row = encode_readings(readings).first()
    assert row.key == "s1"
    assert list(json.loads(row.value).items()) == [
        ("id", "s1"),
        ("temperature", 1.25),
        ("humidity", 50.0),
        ("timestamp", "2024-11-24T12:00:00"),
    ]
    unkeyed = encode_readings(readings, key=None).first()
    assert unkeyed.key is None and unkeyed.value == row.value


def test_encode_reading_with_instant(spark):
    readings = spark.sql(
        "select 7 id, 1.0D temperature, 2.0D humidity, "
        "timestamp'2024-11-24 12:00:00.000001' timestamp"
    )
    row = encode_readings(readings).first()
    assert row.key == "7"
    assert json.loads(row.value)["timestamp"] == "2024-11-24T12:00:00.000001"


def test_alert_json(spark):
    matches = spark.sql(
        "select timestamp'2024-11-24 12:00:00' window_start, "
        "timestamp'2024-11-24 12:00:30' window_end, 45.0D t_avg, "
        "cast(null as double) h_avg, 104 code, \"It's too hot\" message"
    )
    alerts = shape_alerts(matches, datetime(2024, 11, 24, 13))
    value = encode_alerts(alerts).first().value
    assert list(json.loads(value).items()) == [
        ("window", {"start": "2024-11-24 12:00:00", "end": "2024-11-24 12:00:30"}),
        ("t_avg", 45.0),
        ("code", "104"),
        ("message", "It's too hot"),
        ("timestamp", "2024-11-24 13:00:00"),
    ]
    assert decode_alerts(encode_alerts(alerts)).collect() == alerts.collect()


def test_unreadable_alert(spark):
    row = decode_alerts(spark.createDataFrame([("nonsense",)], "value string")).first()
    assert all(v is None for v in row)


def test_alert_time_is_now_by_default(spark):
    matches = spark.sql(
        "select current_timestamp() window_start, current_timestamp() window_end, "
        "1.0D t_avg, 1.0D h_avg, '1' code, 'm' message"
    )
    row = shape_alerts(matches).first()
    assert row["timestamp"] == row["window"]["start"]


@settings(max_examples=5, deadline=None, derandomize=True, phases=NO_SHRINK,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(
    st.tuples(
        st.text(st.characters(exclude_categories=["Cs"]), max_size=20),
        st.floats(allow_nan=False, allow_infinity=False),
        st.one_of(st.none(), st.floats(0, 100)),
        st.datetimes(datetime(1950, 1, 1), datetime(2100, 1, 1)).map(
            lambda t: t.replace(fold=0)
        ),
    ),
    min_size=1, max_size=30))
def test_encoding_and_decoding_is_the_identity(spark, rows):
    readings = spark.createDataFrame(
        rows, "id string, temperature double, humidity double, timestamp timestamp"
    )
    messages = encode_readings(readings).withColumn("timestamp", F.current_timestamp())
    decoded = decode_readings(messages).drop("kafka_timestamp").collect()
    assert sorted(map(repr, map(tuple, decoded))) == sorted(map(repr, rows))


def test_naive_times_are_read_in_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert decode_one(spark, READING).event_time == datetime(2024, 11, 24, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
