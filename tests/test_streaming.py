import json
import os
import subprocess
import sys
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dewpoint.operators import (
    count_by_code,
    decode_alerts,
    decode_readings,
    default_rules,
    encode_alerts,
    match_rules,
    shape_alerts,
    sliding_averages,
)
from dewpoint.schemas import ALERT_SCHEMA, ENVELOPE_SCHEMA, WINDOW_SCHEMA
from dewpoint.sources import (
    AVAILABLE_NOW,
    ConsoleEndpoint,
    FileEndpoint,
    read_batch,
    read_stream,
    write_batch,
    write_stream,
)
from dewpoint.streaming import (
    ledger_counts,
    open_windows,
    run,
    start_fan_out,
    start_monitor,
    start_running_counts,
    start_separate,
)

LOCAL = (
    "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 "
    "pyspark-shell"
)
NOON = datetime(2024, 11, 24, 12)


class Topic:
    """A folder of JSON envelopes, one file per micro-batch and in order of time."""

    def __init__(self, path: Path):
        self.path = path
        self.files = 0
        path.mkdir()

    def send(self, *readings):
        lines = [
            json.dumps(
                {
                    "id": "s",
                    "temperature": float(t),
                    "humidity": 50.0,
                    "timestamp": (NOON + timedelta(seconds=s)).isoformat(),
                }
            )
            for s, t in readings
        ]
        self.send_text(*lines)

    def send_text(self, *lines):
        file = self.path / f"{self.files:03}.txt"
        file.write_text("\n".join(lines))
        os.utime(file, (1_700_000_000 + self.files,) * 2)
        self.files += 1

    @property
    def endpoint(self):
        return FileEndpoint(str(self.path), "text", "value string", max_files=1)

    def messages(self, spark):
        return read_stream(spark, self.endpoint).withColumn(
            "timestamp", F.current_timestamp()
        )


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "readings")


def closed_windows(spark, topic, folder):
    """Runs the stream over what the topic holds, gives start second, average and batch."""
    seen = []

    def keep(batch, batch_id):
        for r in batch.collect():
            seen.append((int((r.window_start - NOON).total_seconds()), r.t_avg, batch_id))

    query = (
        sliding_averages(decode_readings(topic.messages(spark)))
        .writeStream.outputMode("append")
        .option("checkpointLocation", str(folder / "checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    return sorted(seen)


def test_late_readings_and_restart(spark, topic, tmp_path):
    topic.send((0, 10), (5, 20))
    topic.send((35, 50))
    topic.send((4, 90), (36, 60))  # 90 is late, but judged by the previous watermark
    topic.send((15, 70))  # late for two of its windows
    topic.send((120, 45))
    windows = closed_windows(spark, topic, tmp_path)
    assert [(s, t) for s, t, _ in windows] == [
        (-20, 40.0), (-10, 40.0), (0, 40.0), (10, 60.0), (20, 55.0), (30, 55.0),
    ]
    early = {batch for s, _, batch in windows if s <= 0}
    late = {batch for s, _, batch in windows if s > 0}
    assert max(early) < min(late)

    topic.send((180, 45))
    assert [(s, t) for s, t, _ in closed_windows(spark, topic, tmp_path)] == [
        (100, 45.0), (110, 45.0), (120, 45.0),
    ]


def test_window_closes_exactly_at_the_watermark(spark, topic, tmp_path):
    topic.send((0, 10))
    topic.send((34.999999, 10))
    assert [s for s, _, _ in closed_windows(spark, topic, tmp_path)] == [-20, -10]
    topic.send((35, 10))
    assert [s for s, _, _ in closed_windows(spark, topic, tmp_path)] == [0]


def test_malformed_messages_do_not_stop_the_stream(spark, topic, tmp_path):
    topic.send_text("garbage", "", "[1]", '{"timestamp":"never","temperature":1}')
    topic.send((0, 10))
    topic.send((600, 10))
    assert [(s, t) for s, t, _ in closed_windows(spark, topic, tmp_path)] == [
        (-20, 10.0), (-10, 10.0), (0, 10.0),
    ]


def test_stream_equals_batch_up_to_the_watermark(spark, topic, tmp_path):
    times = [(7 * i % 1000, i % 50) for i in range(0, 1000)]
    times.sort()
    for part in range(0, 1000, 250):
        topic.send(*times[part : part + 250])
    streamed = [(s, t) for s, t, _ in closed_windows(spark, topic, tmp_path)]
    messages = (
        spark.read.text(str(topic.path)).withColumn("timestamp", F.current_timestamp())
    )
    batch = sliding_averages(decode_readings(messages)).filter(
        F.col("window_end") <= F.lit(NOON + timedelta(seconds=999 - 5))
    )
    assert streamed == sorted(
        (int((r.window_start - NOON).total_seconds()), r.t_avg) for r in batch.collect()
    )


@pytest.fixture
def readings(spark, tmp_path):
    """Messages in a file endpoint: three scenarios apart, then one that closes them."""
    folder = FileEndpoint(str(tmp_path / "in"))
    rows = [
        (s, json.dumps({"id": "s", "temperature": t, "humidity": h,
                        "timestamp": (NOON + timedelta(seconds=s)).isoformat()}))
        for s, t, h in ((0, 45.0, 10.0), (60, 25.0, 85.0), (120, 35.0, 50.0), (300, 1.0, 50.0))
    ]
    write_batch(spark.createDataFrame(rows, "s int, value string").select("value"), folder)
    return folder


def fired(spark, folder):
    rows = decode_alerts(read_batch(spark, folder)).collect()
    return sorted((r.window.start[11:], r.code) for r in rows)


EXPECTED = sorted(
    [(s, c) for s in ("11:59:40", "11:59:50", "12:00:00") for c in ("101", "104")]
    + [(s, c) for s in ("12:00:40", "12:00:50", "12:01:00") for c in ("102", "103")]
)


def test_fan_out(spark, readings, rule_file, tmp_path, capfd):
    found = FileEndpoint(str(tmp_path / "alerts"))
    closed = FileEndpoint(str(tmp_path / "windows"), schema=WINDOW_SCHEMA)
    options = dict(
        checkpoint=str(tmp_path / "checkpoint"),
        alerts_to=[found, ConsoleEndpoint()],
        windows_to=[closed],
        trigger=AVAILABLE_NOW,
    )
    start_fan_out(spark, readings, rule_file, **options).awaitTermination()
    assert fired(spark, found) == EXPECTED
    assert read_batch(spark, closed).count() == 9
    assert "It's too hot" in capfd.readouterr().out
    stamps = {r.timestamp for r in decode_alerts(read_batch(spark, found)).collect()}
    assert len(stamps) == 1

    # The last batch is repeated when its commit is missing, and changes nothing.
    commits = sorted(
        (p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()),
        key=lambda p: int(p.name),
    )
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    start_fan_out(spark, readings, rule_file, **options).awaitTermination()
    assert fired(spark, found) == EXPECTED
    assert read_batch(spark, closed).count() == 9


def test_rule_edit_shows_in_the_next_batch(spark, topic, rule_file, tmp_path):
    found = FileEndpoint(str(tmp_path / "alerts"))

    def watch():
        start_fan_out(
            spark,
            FileEndpoint(str(tmp_path / "messages")),
            rule_file,
            checkpoint=str(tmp_path / "checkpoint"),
            alerts_to=[found],
            trigger=AVAILABLE_NOW,
        ).awaitTermination()

    def send(second, temperature):
        text = json.dumps({"id": "s", "temperature": temperature, "humidity": 50.0,
                           "timestamp": (NOON + timedelta(seconds=second)).isoformat()})
        write_batch(
            spark.createDataFrame([(text,)], "value string"),
            FileEndpoint(str(tmp_path / "messages")),
        )

    send(0, 45.0)
    send(100, 45.0)
    watch()
    Path(rule_file).write_text(
        "id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n"
        "1,-999,-999,-999,-999,201,always\n2,-999,-999,44,46,202,so-so\n"
    )
    send(200, 45.0)
    watch()
    assert fired(spark, found) == sorted(
        [(s, "104") for s in ("11:59:40", "11:59:50", "12:00:00")]
        + [(s, c) for s in ("12:01:20", "12:01:30", "12:01:40") for c in ("201", "202")]
    )


def sink_of(query):
    """Waits for the query; the JVM's own console cannot be captured here."""
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) > 0
    sink = query.lastProgress["sink"]["description"]
    return "console" if "Console" in sink else sink.split("[")[0]


def test_separate_queries(spark, readings, rule_file, tmp_path):
    found = FileEndpoint(str(tmp_path / "alerts"))
    queries = start_separate(
        spark,
        readings,
        rule_file,
        checkpoint=str(tmp_path / "checkpoint"),
        alerts_to=found,
        trigger=AVAILABLE_NOW,
    )
    assert [sink_of(query) for query in queries] == ["ForeachBatchSink"] * 3
    assert fired(spark, found) == EXPECTED


def test_monitor(spark, readings, rule_file, tmp_path):
    found = FileEndpoint(str(tmp_path / "alerts"))
    start_fan_out(
        spark, readings, rule_file, checkpoint=str(tmp_path / "c1"), alerts_to=[found],
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    queries = start_monitor(
        spark, found, checkpoint=str(tmp_path / "c2"), trigger=AVAILABLE_NOW
    )
    assert [sink_of(query) for query in queries] == ["console", "console"]


def test_large_rule_tables_on_a_stream(spark, topic, tmp_path):
    topic.send((0, 45), (600, 45))
    windows = sliding_averages(decode_readings(topic.messages(spark)))
    alerts = shape_alerts(match_rules(windows, default_rules(spark), broadcast_bytes=0))
    found = FileEndpoint(str(tmp_path / "alerts"))
    write_stream(
        encode_alerts(alerts), found, checkpoint=str(tmp_path / "c"), trigger=AVAILABLE_NOW
    ).awaitTermination()
    assert fired(spark, found) == [
        (s, "104") for s in ("11:59:40", "11:59:50", "12:00:00")
    ]


def test_counts_go_on_after_a_restart(spark, tmp_path):
    folder = FileEndpoint(str(tmp_path / "alerts"))
    latest = {}

    def count():
        def keep(batch, _):
            latest.update({r.code: r.alerts for r in batch.collect()})

        (
            count_by_code(decode_alerts(read_stream(spark, folder)))
            .writeStream.outputMode("complete")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
            .awaitTermination()
        )

    values = spark.createDataFrame(
        [('{"code":"101"}',), ('{"code":104}',), ('{"code":"105"}',)], "value string"
    )
    write_batch(values, folder)
    count()
    assert latest == {"101": 1, "104": 1}
    write_batch(values, folder)
    count()
    assert latest == {"101": 2, "104": 2}


def test_counts_started_before_the_first_batch(spark, tmp_path):
    (tmp_path / "alerts").mkdir()
    folder = FileEndpoint(str(tmp_path / "alerts"))
    totals = []
    query = (
        count_by_code(decode_alerts(read_stream(spark, folder)))
        .writeStream.outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .foreachBatch(lambda batch, _: totals.extend(r.alerts for r in batch.collect()))
        .start()
    )
    try:
        for batch_id in range(2):
            alert = spark.createDataFrame([('{"code":"101"}',)], "value string")
            write_batch(alert, folder, batch_id)
            patience = time.time() + 120
            while totals[-1:] != [batch_id + 1] and time.time() < patience:
                query.processAllAvailable()
    finally:
        query.stop()
    assert totals == [1, 2]


def test_command_line_on_folders(spark, readings, rule_file, tmp_path):
    """In a process and session of its own."""
    found = str(tmp_path / "alerts")

    def dewpoint(command):
        done = subprocess.run(
            [sys.executable, "-m", "dewpoint", *command.split(), "--trigger", "availableNow"],
            cwd=Path(__file__).parents[1],
            env=os.environ | {"PYSPARK_SUBMIT_ARGS": LOCAL},
            capture_output=True,
            text=True,
            timeout=300,
        )
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    shown = dewpoint(
        f"watch --readings {readings.path} --alerts {found} --rules {rule_file} "
        f"--checkpoint {tmp_path}/c1"
    )
    assert "humidity_min" in shown and "window_start" in shown and "It's too hot" in shown
    assert fired(spark, FileEndpoint(found)) == EXPECTED

    shown = dewpoint(f"monitor --alerts {found} --checkpoint {tmp_path}/c2 --start earliest")
    assert "🚨 ALERT: It's too cold" in shown and "Total:    12" in shown


def test_run_stops_all_when_one_fails(spark, tmp_path):
    spark.streams.resetTerminated()
    rate = spark.readStream.format("rate").load()

    def fail(batch, batch_id):
        raise RuntimeError("no")

    healthy = rate.writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "a")
    ).start()
    failing = (
        rate.writeStream.foreachBatch(fail)
        .option("checkpointLocation", str(tmp_path / "b"))
        .start()
    )
    with pytest.raises(Exception):
        run(spark, [healthy, failing], timeout=60)
    assert not healthy.isActive and not failing.isActive
    spark.streams.resetTerminated()


def test_run_with_timeout(spark, tmp_path):
    spark.streams.resetTerminated()
    query = write_stream(
        spark.readStream.format("rate").load().select(F.col("value").cast("string")),
        FileEndpoint(str(tmp_path / "out")),
        checkpoint=str(tmp_path / "c"),
        trigger="1 second",
        name="ticks",
    )
    started = time.time()
    assert run(spark, [query], timeout=3) is False
    assert time.time() - started < 60 and not query.isActive
    assert read_batch(spark, FileEndpoint(str(tmp_path / "out"))).schema == ENVELOPE_SCHEMA


def test_running_counts_after_a_batch_is_delivered_again(spark, tmp_path):
    """The last batch is forgotten by the checkpoint, but not by the ledger."""
    folder = FileEndpoint(str(tmp_path / "alerts"), max_files=1)
    checkpoint, counted = tmp_path / "checkpoint", str(tmp_path / "counted")

    def count():
        start_running_counts(
            spark, folder, checkpoint=str(checkpoint), counted_to=counted, trigger=AVAILABLE_NOW
        ).awaitTermination()

    def send(minute, *codes):
        rows = [((f"2024-01-01 00:0{minute}:00", "x"), 1.0, 2.0, c, "m", "t") for c in codes]
        write_batch(encode_alerts(spark.createDataFrame(rows, ALERT_SCHEMA).coalesce(1)), folder)

    def totals():
        rows = spark.read.parquet(f"{counted}/alerts").select("window.start", "code", "too_dry", "total")
        return sorted(map(tuple, rows.collect()), key=str)

    assert ledger_counts(spark, counted).collect() == []
    send(1, "101", "104", "999")
    count()
    send(2, "101", None, "101")
    count()
    once = totals()
    assert [t[2:] for t in once if t[1] == "101"] == [(1, 1), (2, 3), (3, 4)]
    assert len(once) == 6
    for name in ("1", ".1.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    count()
    assert totals() == once
    send(3, "104")
    count()
    assert {tuple(r) for r in ledger_counts(spark, counted).collect()} == {("101", 3), ("104", 2)}
    assert max(t[3] for t in totals()) == 5


def test_open_windows_between_batches(spark, topic, tmp_path):
    checkpoint, closed = str(tmp_path / "c"), FileEndpoint(str(tmp_path / "w"), schema=WINDOW_SCHEMA)

    def go_on():
        windows = sliding_averages(decode_readings(topic.messages(spark)))
        write_stream(windows, closed, checkpoint=checkpoint, trigger=AVAILABLE_NOW).awaitTermination()
        return {
            (r.at, r.t_avg)
            for r in open_windows(spark, checkpoint)
            .select(F.date_format("window_start", "HH:mm:ss").alias("at"), "t_avg")
            .collect()
        }

    topic.send((0, 10), (5, 20))
    assert go_on() == {("11:59:40", 15.0), ("11:59:50", 15.0), ("12:00:00", 15.0)}
    topic.send((35, 50), (36, 1e300), (37, -1e300))
    assert go_on() == {("12:00:10", 50 / 3), ("12:00:20", 50 / 3), ("12:00:30", 50 / 3)}
    with pytest.raises(Exception):
        open_windows(spark, str(tmp_path / "nothing"))
