from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dewpoint.operators import sliding_averages
from dewpoint.operators.windows import _micros

NO_SHRINK = [Phase.explicit, Phase.generate]
NOON = datetime(2024, 11, 24, 12)
SCHEMA = "event_time timestamp, temperature double, humidity double"


def averages(spark, rows, *args):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {
        (r.window_start, r.window_end): (r.t_avg, r.h_avg)
        for r in sliding_averages(frame, *args).collect()
    }


def at(seconds):
    return NOON + timedelta(seconds=seconds)


def test_probe_reading_is_in_three_windows(spark):
    found = averages(spark, [(NOON, 25.0, 50.0)])
    assert found == {(at(s), at(s + 30)): (25.0, 50.0) for s in (-20, -10, 0)}


def test_start_inclusive_end_exclusive(spark):
    found = averages(spark, [(at(0), 10.0, 1.0), (at(30), 20.0, 2.0)])
    assert found[(at(0), at(30))] == (10.0, 1.0)
    assert found[(at(10), at(40))] == (20.0, 2.0)


def test_all_sensors_together(spark):
    rows = [(at(1), t, h) for t, h in ((45.0, 10.0), (25.0, 85.0), (50.0, 95.0), (15.0, 5.0))]
    assert set(averages(spark, rows).values()) == {(33.75, 48.75)}


def test_nulls(spark):
    rows = [(at(0), None, 10.0), (at(5), 20.0, None), (at(100), None, None), (None, 1.0, 1.0)]
    found = averages(spark, rows)
    assert found[(at(0), at(30))] == (20.0, 10.0)
    assert found[(at(100), at(130))] == (None, None)
    assert len(found) == 6


def test_nan_poisons_the_average(spark):
    found = averages(spark, [(at(0), float("nan"), 1.0), (at(1), 3.0, 1.0)])
    assert str(found[(at(0), at(30))][0]) == "nan"


def test_before_1970(spark):
    early = datetime(1969, 12, 31, 23, 59, 59)
    found = averages(spark, [(early, 1.0, 1.0)])
    assert min(found)[0] == datetime(1969, 12, 31, 23, 59, 30)
    assert len(found) == 3


def test_empty(spark):
    assert averages(spark, []) == {}


@pytest.mark.parametrize(
    "size, slide", [("30 seconds", "10 seconds"), ("25 seconds", "10 seconds"),
                    ("10 seconds", "10 seconds"), ("1 minute", "30 seconds")]
)
@settings(max_examples=5, deadline=None, derandomize=True, phases=NO_SHRINK,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(
    st.tuples(st.integers(-90_000, 90_000), st.integers(-50, 50), st.integers(0, 100)),
    min_size=1, max_size=20))
def test_same_as_brute_force(spark, size, slide, rows):
    length, step = (micros // 1000 for micros in _micros(spark, size, slide))
    members = defaultdict(list)
    for ms, t, h in rows:
        first = (ms // step) * step
        while first + length > ms:
            members[first].append((t, h))
            first -= step
    expected = {
        (NOON + timedelta(milliseconds=s), NOON + timedelta(milliseconds=s + length)): (
            sum(t for t, _ in m) / len(m),
            sum(h for _, h in m) / len(m),
        )
        for s, m in members.items()
    }
    data = [(NOON + timedelta(milliseconds=ms), float(t), float(h)) for ms, t, h in rows]
    assert averages(spark, data, size, slide) == expected


@pytest.mark.parametrize(
    ("text", "micros"),
    [("30 seconds", 30_000_000), ("1 minute 30 seconds", 90_000_000),
     ("interval 30 seconds", 30_000_000), ("1.5 seconds", 1_500_000), ("1 week", 604_800_000_000)],
)
def test_durations_are_read_by_spark(spark, text, micros):
    assert _micros(spark, text) == [micros]


def test_no_duration(spark):
    with pytest.raises(Exception):
        _micros(spark, "soon")


def test_each_reading_is_shuffled_once(spark):
    """The readings meet an aggregate before the first exchange and before any expand."""
    readings = spark.range(1000).select(
        F.timestamp_seconds("id").alias("event_time"),
        F.rand(1).alias("temperature"),
        F.rand(2).alias("humidity"),
    )
    plan = sliding_averages(readings)._jdf.queryExecution().sparkPlan().toString()
    lines = plan.splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("HashAggregate" in line for line in lines[expand + 1 :])
