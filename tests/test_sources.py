from dataclasses import replace

import pytest

from dewpoint import __main__ as command_line
from dewpoint import session
from dewpoint.sources import (
    AVAILABLE_NOW,
    ConsoleEndpoint,
    FileEndpoint,
    KafkaEndpoint,
    KafkaSettings,
    first_start,
    read_batch,
    read_stream,
    write_batch,
    write_stream,
)

SETTINGS = KafkaSettings(("one:9092", "two:9092"), "user", 'pass"word\\')


def test_kafka_source_options():
    assert KafkaEndpoint(SETTINGS, "readings").source_options() == {
        "kafka.bootstrap.servers": "one:9092,two:9092",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": "org.apache.kafka.common.security.plain.PlainLoginModule "
        'required username="user" password="pass\\"word\\\\";',
        "subscribe": "readings",
        "startingOffsets": "earliest",
    }


def test_kafka_tuning_options():
    options = KafkaEndpoint(
        SETTINGS, "t", "latest", group_prefix="g", max_offsets=5, min_partitions=64
    ).source_options()
    assert options["startingOffsets"] == "latest"
    assert options["groupIdPrefix"] == "g"
    assert options["maxOffsetsPerTrigger"] == "5"
    assert options["minPartitions"] == "64"


def test_kafka_sink_options():
    options = KafkaEndpoint(SETTINGS, "alerts").sink_options()
    assert options["topic"] == "alerts"
    assert "subscribe" not in options and "startingOffsets" not in options


def test_kafka_without_credentials():
    settings = KafkaSettings(("one:9092",), security_protocol="PLAINTEXT")
    assert KafkaEndpoint(settings, "t").sink_options() == {
        "kafka.bootstrap.servers": "one:9092",
        "kafka.security.protocol": "PLAINTEXT",
        "topic": "t",
    }


def test_kafka_settings_from_env():
    settings = KafkaSettings.from_env(
        {"KAFKA_BOOTSTRAP_SERVERS": "a:1, b:2", "KAFKA_USERNAME": "u", "KAFKA_PASSWORD": "p"}
    )
    assert settings == KafkaSettings(("a:1", "b:2"), "u", "p")
    assert "'p'" not in repr(settings)
    with pytest.raises(KeyError):
        KafkaSettings.from_env({})


def test_messages_in_files(spark, tmp_path):
    folder = FileEndpoint(str(tmp_path / "topic"))
    write_batch(spark.createDataFrame([("k", "v")], "key string, value string"), folder)
    write_batch(spark.createDataFrame([("w",)], "value string"), folder)
    rows = {bytes(r.value): r for r in read_batch(spark, folder).collect()}
    assert bytes(rows[b"v"].key) == b"k" and rows[b"w"].key is None
    assert all(r.timestamp is not None for r in rows.values())


def test_repeated_batch_replaces_itself(spark, tmp_path):
    folder = FileEndpoint(str(tmp_path / "topic"))
    for batch_id, value in ((0, "a"), (1, "b"), (1, "b")):
        write_batch(spark.createDataFrame([(value,)], "value string"), folder, batch_id)
    assert sorted(bytes(r.value) for r in read_batch(spark, folder).collect()) == [b"a", b"b"]


def test_json_files(spark, tmp_path):
    folder = FileEndpoint(str(tmp_path / "out"), "json", "n int")
    write_batch(spark.range(3).selectExpr("cast(id as int) n"), folder)
    assert sorted(r.n for r in read_batch(spark, folder).collect()) == [0, 1, 2]


def test_console_batch(spark, capfd):
    write_batch(spark.createDataFrame([("x" * 50,)], "text string"), ConsoleEndpoint())
    assert "x" * 50 in capfd.readouterr().out


def test_persistent_sink_needs_a_checkpoint(spark, tmp_path):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="checkpoint"):
        write_stream(stream, FileEndpoint(str(tmp_path)))


class FakeSession:
    """As much of a session as the choice of a work folder looks at."""

    def __init__(self, named=None, master="local[1]"):
        self.conf = {"spark.checkpoint.dir": named}
        self.sparkContext = self
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_work_folder_is_below_the_named_one():
    cluster = FakeSession("/shared/place/", master="yarn")
    one, two = session.work_folder(cluster, "x"), session.work_folder(cluster, "x")
    assert one.startswith("/shared/place/dewpoint/x-") and one != two


def test_work_folder_without_a_named_one():
    local = FakeSession()
    assert session.work_folder(local, "x").startswith(local.folder + "/dewpoint/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_folder(FakeSession(master="yarn"), "x")


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_command_line():
    args = command_line.parser().parse_args(
        "watch --readings in --alerts out --rules r.csv --checkpoint c".split()
    )
    assert (args.size, args.slide, args.watermark) == ("30 seconds", "10 seconds", "5 seconds")
    assert command_line.parser().parse_args("monitor --alerts a --checkpoint c".split()).group is None


def test_command_line_starts_the_jobs(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "one:9092")
    started, stopped = {}, []

    class Session:
        def stop(self):
            stopped.append(True)

    monkeypatch.setattr(command_line.session, "build", lambda name: Session())
    monkeypatch.setattr(command_line, "run", lambda spark, queries: None)
    monkeypatch.setattr(
        command_line,
        "start_fan_out",
        lambda spark, source, rules, **options: started.update(
            source=source, rules=rules, **options
        ),
    )
    monkeypatch.setattr(
        command_line,
        "start_monitor",
        lambda spark, source, **options: started.update(monitored=source) or [],
    )
    command_line.main(
        "watch --readings in --alerts out --rules r.csv --checkpoint c "
        "--max-offsets 7 --min-partitions 99 --quiet".split()
    )
    assert started["source"].topic == "in" and started["source"].max_offsets == 7
    assert started["source"].min_partitions == 99
    assert [sink.topic for sink in started["alerts_to"]] == ["out"]
    assert started["rules"] == "r.csv" and started["windows_to"] == []
    command_line.main("monitor --alerts out --checkpoint c --group g".split())
    assert started["monitored"].starting_offsets == "latest"
    assert started["monitored"].group_prefix == "g"
    assert stopped == [True, True]


def test_command_line_takes_folders_for_topics():
    assert command_line.endpoint("/data/readings") == FileEndpoint("/data/readings")
    assert command_line.endpoint("s3a://bucket/x").path == "s3a://bucket/x"


def test_options_that_do_not_apply_are_errors(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "one:9092")
    assert command_line.endpoint("/data/in", max_files=3).max_files == 3
    assert command_line.endpoint("in", start="latest").starting_offsets == "latest"
    for command in (
        "watch --readings /in --alerts out --rules r.csv --checkpoint c --max-offsets 7",
        "watch --readings /in --alerts out --rules r.csv --checkpoint c --min-partitions 7",
        "watch --readings in --alerts out --rules r.csv --checkpoint c --max-files 7",
        "monitor --alerts /out --checkpoint c --group g",
        "monitor --alerts out --checkpoint c --max-files 7",
    ):
        with pytest.raises(ValueError, match="only"):
            command_line.main(command.split())


def test_start_at_the_latest_message_of_a_folder(spark, tmp_path):
    folder, checkpoint = FileEndpoint(str(tmp_path / "in")), str(tmp_path / "job")

    def send(text):
        write_batch(spark.createDataFrame([(text,)], "value string"), folder)

    def start():
        since = first_start(spark, checkpoint)
        write_stream(
            read_stream(spark, replace(folder, since=since, max_files=1)),
            FileEndpoint(str(tmp_path / "out")),
            checkpoint=f"{checkpoint}/stream",
            trigger=AVAILABLE_NOW,
        ).awaitTermination()
        seen = read_batch(spark, FileEndpoint(str(tmp_path / "out")))
        return since, sorted(bytes(r.value).decode() for r in seen.collect())

    send("before the first start")
    first, seen = start()
    assert seen == []
    send("while stopped")
    assert start() == (first, ["while stopped"])
    send("later")
    assert start() == (first, ["later", "while stopped"])


def test_files_per_batch(spark, tmp_path):
    folder = FileEndpoint(str(tmp_path / "in"), max_files=2)
    for i in range(5):
        write_batch(spark.createDataFrame([(str(i),)], "value string").coalesce(1), folder)
    batches = []
    read_stream(spark, folder).writeStream.foreachBatch(
        lambda batch, _: batches.append(batch.count())
    ).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert batches == [2, 2, 1]
