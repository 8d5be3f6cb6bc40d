"""Measurements by micro-batch and the supervision of running queries."""

import time

import pytest
from pyspark.sql import functions as F

from dewpoint import __main__ as command_line
from dewpoint.operators import decode_alerts
from dewpoint.plans import windows_of
from dewpoint.schemas import WINDOW_SCHEMA
from dewpoint.sources import AVAILABLE_NOW, FileEndpoint, read_batch, write_stream
from dewpoint.streaming import (
    BatchMeasurements,
    read_measurements,
    run,
    start_fan_out,
    start_separate,
    supervise,
)
from test_streaming import EXPECTED, Topic, fired, readings  # noqa: F401


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "readings")


def measure(spark, topic, folder):
    """Runs the stream over what the topic holds, gives the measurements so far."""
    checkpoint, measured = str(folder / "checkpoint"), str(folder / "measured")
    measurements = BatchMeasurements(spark, checkpoint, measured)
    query = measurements.start(
        lambda: write_stream(
            windows_of(topic.messages(spark), measured=True),
            FileEndpoint(str(folder / "windows"), schema=WINDOW_SCHEMA),
            checkpoint=checkpoint,
            trigger=AVAILABLE_NOW,
        )
    )
    query.awaitTermination()
    assert measurements.wait(60)
    rows = read_measurements(spark, measured).orderBy("batch_id").collect()
    return [tuple(r)[1:] for r in rows if r.messages]


def test_measurements_by_batch(spark, topic, tmp_path):
    topic.send((0, 10), (5, 20))
    topic.send_text("garbage", "", "[1]", '{"timestamp":"never","temperature":1}', '{"other":1}')
    topic.send((35, 50))
    topic.send((4, 90), (36, 60))  # 4 is judged by the watermark of the batch before
    topic.send((15, 70), (15, 71))  # late for two of their windows
    topic.send((120, 45))
    found = measure(spark, topic, tmp_path)
    assert [row[:4] for row in found] == [
        (2, 0, 0, 6), (5, 4, 1, 0), (1, 0, 0, 3), (2, 0, 0, 6), (2, 0, 0, 6), (1, 0, 0, 3),
    ]
    assert [row[5] for row in found] == [0, 0, 0, 0, 4, 0]

    topic.send((0, 1), (100, 1), (100, 2), (111, 1))  # after a restart
    assert [row[5] for row in measure(spark, topic, tmp_path)] == [0] * 4 + [4, 0, 5]


def test_a_repeated_batch_is_measured_once(spark, topic, tmp_path):
    for second in (0, 100, 100, 0):
        topic.send((second, 10))
    once = measure(spark, topic, tmp_path)
    commits = tmp_path / "checkpoint" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    assert measure(spark, topic, tmp_path) == once
    assert [row[5] for row in once] == [0, 0, 0, 3]


def test_supervised_queries_start_again(spark, readings, rule_file, tmp_path):  # noqa: F811
    found = FileEndpoint(str(tmp_path / "alerts"))
    shown = FileEndpoint(str(tmp_path / "shown"))
    broken = FileEndpoint(str(tmp_path / "shown"), format="no such format")
    started = []

    def start():
        started.append(
            start_separate(
                spark,
                readings,
                rule_file,
                checkpoint=str(tmp_path / "checkpoint"),
                alerts_to=found,
                alerts_shown=broken if len(started) < 2 else shown,
                windows_shown=FileEndpoint(str(tmp_path / "windows"), schema=WINDOW_SCHEMA),
                trigger="1 second",
            )
        )
        return started[-1]

    assert supervise(spark, start, restarts=2, until_idle=True, timeout=120) is True
    assert len(started) == 3
    assert not any(query.isActive for queries in started for query in queries)
    assert fired(spark, found) == fired(spark, shown) == EXPECTED


def test_supervision_gives_up(spark, tmp_path):
    rate = spark.readStream.format("rate").load()
    started = []

    def fail(batch, batch_id):
        raise RuntimeError("no")

    def start():
        healthy = rate.writeStream.format("noop").option(
            "checkpointLocation", str(tmp_path / f"a{len(started)}")
        )
        failing = rate.writeStream.foreachBatch(fail).option(
            "checkpointLocation", str(tmp_path / "b")
        )
        started.append([healthy.start(), failing.start()])
        return started[-1]

    with pytest.raises(Exception, match="no"):
        supervise(spark, start, restarts=1, timeout=120)
    assert len(started) == 2
    assert not any(query.isActive for queries in started for query in queries)
    # Nothing is left over for the next queries.
    query = rate.writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "c")
    ).start()
    assert run(spark, [query], timeout=1) is False


def test_supervision_ends_with_the_time_or_the_queries(spark, readings, rule_file, tmp_path):  # noqa: F811
    def start(trigger):
        return [
            start_fan_out(
                spark,
                readings,
                rule_file,
                checkpoint=str(tmp_path / "checkpoint"),
                alerts_to=[FileEndpoint(str(tmp_path / "alerts"))],
                trigger=trigger,
            )
        ]

    assert supervise(spark, lambda: start(AVAILABLE_NOW)) is True
    began = time.monotonic()
    assert supervise(spark, lambda: start("1 second"), timeout=3) is False
    assert time.monotonic() - began < 60
    stamps = decode_alerts(read_batch(spark, FileEndpoint(str(tmp_path / "alerts"))))
    assert stamps.select(F.count_distinct("timestamp")).first()[0] == 1


def test_command_line_restarts(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "one:9092")
    seen = {}

    class Session:
        def stop(self):
            pass

    monkeypatch.setattr(command_line.session, "build", lambda name: Session())
    monkeypatch.setattr(
        command_line, "start_monitor", lambda spark, source, **options: ["query"]
    )
    monkeypatch.setattr(
        command_line, "supervise", lambda spark, start, **how: seen.update(how, queries=start())
    )
    command_line.main("monitor --alerts out --checkpoint c --restarts 5 --pause 2".split())
    assert seen == {"restarts": 5, "pause": 2.0, "queries": ["query"]}
