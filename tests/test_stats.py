import random

import pytest
from pyspark.sql import functions as F

from dewpoint.functions import two_places
from dewpoint.operators import (
    count_by_code,
    counts_row,
    format_alerts,
    format_counts,
    running_counts,
)
from dewpoint.operators import stats
from dewpoint.schemas import ALERT_SCHEMA, KNOWN_CODES

START, END = "2024-11-24 12:00:00", "2024-11-24 12:00:30"


def alerts(spark, items):
    """Alerts of (start, code) or (start, code, message)."""
    rows = [
        ((s, END) if s else None, 45.0, 10.0, c, *(rest or ("m",)), "2024-11-24 13:00:00")
        for s, c, *rest in items
    ]
    return spark.createDataFrame(rows, ALERT_SCHEMA)


MIXED = [(START, "101"), (START, "104"), (START, "104"), (START, "105"), (START, None)]


def test_count_by_code(spark):
    found = {r.code: r.alerts for r in count_by_code(alerts(spark, MIXED)).collect()}
    assert found == {"101": 1, "104": 2}


def test_counts_row(spark):
    assert counts_row(alerts(spark, MIXED)).collect() == [(1, 0, 0, 2, 3)]
    assert counts_row(alerts(spark, [])).collect() == [(0, 0, 0, 0, 0)]


def test_running_counts(spark):
    items = [
        (f"2024-11-{day:02} 12:00:{s:02}", c, f"{day}{s}{c}")
        for day in (3, 4, 20)
        for s in (0, 10, 20)
        for c in ("101", "103", "105")
    ]
    random.Random(1).shuffle(items)
    rows = running_counts(alerts(spark, items)).collect()
    rows.sort(key=lambda r: (r.window.start, r.code if r.code in KNOWN_CODES else ""))
    dry = cold = 0
    for row in rows:
        dry += row.code == "101"
        cold += row.code == "103"
        assert (row.too_dry, row.too_wet, row.too_cold, row.too_hot, row.total) == (
            dry, 0, cold, 0, dry + cold,
        )
    assert len(rows) == len(items)


@pytest.mark.parametrize("copies_per_row", [2, 100_000])
def test_running_counts_with_copies_and_crowds(spark, monkeypatch, copies_per_row):
    """Copies, many alerts of one window and code, and alerts without a window."""
    monkeypatch.setattr(stats, "_COPIES_PER_ROW", copies_per_row)
    items = (
        [(START, "104", "same")] * 7
        + [(START, "104", f"m{i}") for i in range(60)]
        + [(None, "101", "x")] * 3
        + [("2024-11-25 00:00:00", "104", "next day")]
    )
    rows = running_counts(alerts(spark, items)).collect()
    assert len(rows) == len(items)
    assert sorted(r.too_hot for r in rows if r.code == "104") == list(range(1, 69))
    assert sorted(r.too_dry for r in rows if r.code == "101") == [1, 2, 3]
    assert sorted(r.total for r in rows) == list(range(1, 72))
    assert [r.too_hot for r in rows if r.message == "next day"] == [68]


def test_running_counts_of_one_day_take_several_ranges(spark):
    """A window every second of one day; alerts of one window hold half of the rows."""
    items = [
        (f"2024-11-24 {s // 3600:02}:{s // 60 % 60:02}:{s % 60:02}", ("101", "104")[s % 2])
        for s in range(0, 86_400, 60)
    ]
    items += [(START, "103", f"m{i}") for i in range(1_000)]
    frame = alerts(spark, items)
    order = ["window", "code", "message"]
    dealt = stats._in_ranges(frame, order, 8)
    sizes = [r["count"] for r in dealt.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < len(items) / 3
    rows = running_counts(frame, ranges=8).collect()
    rows.sort(key=lambda r: (r.window.start, r.code, r.total))
    assert [r.total for r in rows] == list(range(1, len(items) + 1))
    for code, name in KNOWN_CODES.items():
        own = [r[name] for r in rows if r.code == code]
        assert own == list(range(1, len(own) + 1))


def test_running_counts_read_their_input_once(spark, tmp_path):
    alerts(spark, MIXED).write.parquet(str(tmp_path / "alerts"))
    found = running_counts(spark.read.parquet(str(tmp_path / "alerts")))
    assert str(tmp_path) not in found._jdf.queryExecution().toString()


def test_report(spark):
    row = format_alerts(alerts(spark, [(START, "104", "It's too hot")])).first()
    assert row.report.split("\n") == [
        "=" * 80,
        "🚨 ALERT: It's too hot",
        "-" * 80,
        "📊 Code:        104",
        "🌡️  Temperature: 45.00°C",
        "💧 Humidity:    10.00%",
        "⏰ Window:      2024-11-24 12:00:00 to 2024-11-24 12:00:30",
        "🕐 Alert Time:  2024-11-24 13:00:00",
        "=" * 80,
    ]


def test_report_defaults(spark):
    row = format_alerts(spark.createDataFrame([(None,) * 6], ALERT_SCHEMA)).first()
    lines = row.report.split("\n")
    assert lines[1] == "🚨 ALERT: Unknown"
    assert lines[3] == "📊 Code:        N/A"
    assert lines[4] == "🌡️  Temperature: 0.00°C"
    assert lines[6] == "⏰ Window:      N/A to N/A"
    assert lines[7] == "🕐 Alert Time:  N/A"


def test_statistics(spark):
    row = format_counts(counts_row(alerts(spark, MIXED))).first()
    assert row.statistics.split("\n") == [
        "📈 Statistics:",
        "   Too dry:  1",
        "   Too wet:  0",
        "   Too cold: 0",
        "   Too hot:  2",
        "   Total:    3",
    ]


def test_two_places_rounds_the_stored_value(spark):
    draw = random.Random(3)
    values = [39.955, 0.125, 2.675, -0.001, -7.345, 1234567.895, float("nan"), float("inf"),
              float("-inf"), 0.0, -0.0]
    values += [draw.randint(-10**6, 10**6) / 1000 for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for row in frame.select("v", two_places(F.col("v")).alias("text")).collect():
        assert row.text == f"{row.v:.2f}"
