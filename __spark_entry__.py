"""

Readings are the ``events`` table (see ``dewpoint.plans.events``), rules are the
four shipped ones unless a query derives its own from ``part``. Averages are
compared at six places, since engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dewpoint.operators import (
    clean_rules,
    count_by_code,
    counts_row,
    decode_alerts,
    decode_readings,
    default_rules,
    each_once,
    encode_alerts,
    encode_readings,
    format_alerts,
    format_counts,
    load_rules,
    match_rules,
    running_counts,
)
from dewpoint.operators import sliding_averages as averages_of
from dewpoint.plans import alerts_of, event_messages, event_readings, windows_of
from dewpoint.plans.events import EVENTS_SCHEMA
from dewpoint.schemas import DEFAULT_RULES, KNOWN_CODES, RULE_SCHEMA, WINDOW_SCHEMA
from dewpoint.session import work_folder
from dewpoint.sources import (
    AVAILABLE_NOW,
    FileEndpoint,
    read_batch,
    read_stream,
    write_batch,
    write_stream,
)
from dewpoint.streaming import (
    BatchMeasurements,
    ledger_counts,
    open_windows as windows_in_state,
    read_measurements,
    start_fan_out,
    start_monitor,
    start_running_counts,
    start_separate,
    supervise,
)

# The queries for training data come with a subpackage that may be absent.
try:
    import corpus_pipeline
    import dewpoint.llm.queries as llm
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "dewpoint.llm", "dewpoint.llm.queries"):
        raise
    corpus_pipeline = llm = None

# Alert time used where the text of an alert is compared.
ALERT_TIME = datetime(2024, 2, 1, tzinfo=timezone.utc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_readings(_table(spark, sf_dir, "events"))


def _messages(spark: SparkSession, sf_dir: str, key: str | None = "id") -> DataFrame:
    return event_messages(_table(spark, sf_dir, "events"), key)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return averages_of(_readings(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_of(_windows(spark, sf_dir), default_rules(spark), ALERT_TIME)


def _six(name: str) -> Column:
    return F.round(name, 6).alias(name)


def _window_rows(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        _six("t_avg"),
        _six("h_avg"),
    )


def _alert_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        _six("t_avg"),
        _six("h_avg"),
        "code",
        "message",
    )


def entry(spark: SparkSession) -> DataFrame:
    """Alerts of the smallest ``events`` table."""
    return alerts(spark, "/root/testdata/sf0.001")


# -- messages ---------------------------------------------------------------


def reading_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_readings(_messages(spark, sf_dir)).select(
        "sensor_id",
        "temperature",
        "humidity",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
    )


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).groupBy("key").agg(F.count("value").alias("messages"))


def unkeyed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir, key=None).agg(
        F.count("value").alias("messages"), F.count("key").alias("keyed_messages")
    )


def _badly_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_readings(
        _readings(spark, sf_dir).select(
            F.col("sensor_id").alias("id"),
            "temperature",
            "humidity",
            F.concat(F.lit("day "), F.col("event_time").cast("string")).alias("timestamp"),
        )
    )


def malformed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What survives of good readings, readings with unreadable times, JSON of
    another kind, prose and HTML."""
    no_time = F.lit(None).cast("timestamp")

    def payload(table: str, column: str) -> DataFrame:
        text = F.col(column).alias("value")
        return _table(spark, sf_dir, table).select(text, no_time.alias("timestamp"))

    badly_timed = _badly_timed(spark, sf_dir)
    messages = {
        "readings": _messages(spark, sf_dir),
        "badly timed": badly_timed.withColumn("timestamp", no_time),
        "other json": payload("events", "props"),
        "prose": payload("documents", "text"),
        "html": payload("pages", "html"),
    }
    outcomes = [
        decode_readings(m).agg(
            F.lit(source).alias("source"),
            F.count(F.lit(1)).alias("messages"),
            F.count("sensor_id").alias("with_sensor"),
            F.count("temperature").alias("with_temperature"),
            F.count("event_time").alias("with_event_time"),
        )
        for source, m in messages.items()
    ]
    return reduce(DataFrame.union, outcomes)


# -- windows ----------------------------------------------------------------


def sliding_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_rows(_windows(spark, sf_dir))


def sliding_averages_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    return _window_rows(averages_of(readings, "1 minute", "30 seconds", "10 seconds"))


def sliding_averages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows a stream closes; the last ones stay open in its state."""
    folder = work_folder(spark, "windows")
    # A stream reads a folder or a pattern; the braces make a pattern of one name.
    events = FileEndpoint(f"{sf_dir}/{{events}}.parquet", schema=EVENTS_SCHEMA)
    closed = FileEndpoint(f"{folder}/closed", schema=WINDOW_SCHEMA)
    windows = averages_of(event_readings(read_stream(spark, events)))
    write_stream(
        windows, closed, checkpoint=f"{folder}/checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    return _window_rows(read_batch(spark, closed))


def late_readings_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of a stream that gets the clicks last.

    Three batches: the other events of the first half of their time, those of the second
    half, then all clicks. Clicks no longer count in windows that the second batch closed.
    """
    folder = work_folder(spark, "late")
    topic = FileEndpoint(f"{folder}/readings")
    closed = FileEndpoint(f"{folder}/closed", schema=WINDOW_SCHEMA)
    clicks = F.col("event_type").eqNullSafe("click")
    others = _parts_in_time(_table(spark, sf_dir, "events").filter(~clicks))
    for part in (*others, _table(spark, sf_dir, "events").filter(clicks)):
        write_batch(event_messages(part).select("key", "value"), topic)
        windows = windows_of(read_stream(spark, topic))
        write_stream(
            windows, closed, checkpoint=f"{folder}/checkpoint", trigger=AVAILABLE_NOW
        ).awaitTermination()
    return _window_rows(read_batch(spark, closed))


def _parts_in_time(events: DataFrame) -> list[DataFrame]:
    """Events up to the middle of their time, and later ones."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.agg(((F.min(micros) + F.max(micros)) / 2).alias("_middle"))
    dealt = events.join(F.broadcast(middle), how="left")  # one row
    later = F.coalesce(micros > F.col("_middle"), F.lit(False))
    return [dealt.filter(part).drop("_middle") for part in (~later, later)]


def stream_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job measures by micro-batch, added up: its input is that of
    ``late_readings_stream``, and after the first half come page texts and readings with an
    unreadable time."""
    folder = work_folder(spark, "measured")
    topic = FileEndpoint(f"{folder}/readings")
    events = _table(spark, sf_dir, "events")
    clicks = F.col("event_type").eqNullSafe("click")
    first, second = (event_messages(p) for p in _parts_in_time(events.filter(~clicks)))
    html = _table(spark, sf_dir, "pages").select(F.lit(None).alias("key"), F.col("html").alias("value"))
    for part in (first.select("key", "value").union(html).union(_badly_timed(spark, sf_dir)),
                 second, event_messages(events.filter(clicks))):
        write_batch(part.select("key", "value"), topic)
        measurements = BatchMeasurements(spark, f"{folder}/checkpoint", f"{folder}/measured")
        measurements.start(
            lambda: write_stream(
                windows_of(read_stream(spark, topic), measured=True),
                FileEndpoint(f"{folder}/closed", schema=WINDOW_SCHEMA),
                checkpoint=f"{folder}/checkpoint",
                trigger=AVAILABLE_NOW,
            )
        ).awaitTermination()
        if not measurements.wait(600):
            raise RuntimeError("no report of the last batch")
    counts = ("messages", "unreadable", "untimed", "window_readings", "closed_readings", "late_readings")
    found = read_measurements(spark, f"{folder}/measured")
    return found.agg(*[F.sum(c).alias(c) for c in counts])


def open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the stream of ``sliding_averages_stream`` has still open at its
    end, from its state."""
    folder = work_folder(spark, "open")
    events = FileEndpoint(f"{sf_dir}/{{events}}.parquet", schema=EVENTS_SCHEMA)
    closed = FileEndpoint(f"{folder}/closed", schema=WINDOW_SCHEMA)
    windows = averages_of(event_readings(read_stream(spark, events)))
    write_stream(
        windows, closed, checkpoint=f"{folder}/checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    return _window_rows(windows_in_state(spark, f"{folder}/checkpoint"))


def averages_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows, and whether their averages are the same to the last bit from the
    table as it is, from its readings in another order and other partitions, and from a
    stream of them."""
    bits = {c: F.col(c).cast("string") for c in ("t_avg", "h_avg")}
    folder = work_folder(spark, "any-order")
    readings = _readings(spark, sf_dir)
    turned = readings.repartition(13, "temperature").sortWithinPartitions("humidity")
    turned.write.parquet(f"{folder}/readings")
    streamed = FileEndpoint(f"{folder}/readings", schema=readings.schema, max_files=5)
    closed = FileEndpoint(f"{folder}/closed", schema=WINDOW_SCHEMA)
    # No reading is late within ten thousand days.
    windows = averages_of(read_stream(spark, streamed), watermark="10000 days")
    end = turned.agg(F.max("event_time")).select(
        F.lit("last").alias("sensor_id"),
        F.lit(None).cast("double").alias("temperature"),
        F.lit(None).cast("double").alias("humidity"),
        (F.col("max(event_time)") + F.expr("interval 10001 days")).alias("event_time"),
    )
    end.write.mode("append").parquet(f"{folder}/readings")
    write_stream(
        windows, closed, checkpoint=f"{folder}/checkpoint", trigger=AVAILABLE_NOW
    ).awaitTermination()
    found = averages_of(readings).select("*", F.struct(*bits.values()).alias("same"))
    for other in (averages_of(turned), read_batch(spark, closed)):
        again = other.select("window_start", F.struct(*bits.values()).alias("_bits"))
        found = found.join(again, "window_start").withColumn(
            "same", F.when(F.col("same") == F.col("_bits"), F.col("same"))
        ).drop("_bits")
    same = F.col("same").isNotNull().alias("same")
    return _window_rows(found).join(
        found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), same),
        "window_start",
    )


# -- rules ------------------------------------------------------------------


def rules_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule file with one rule per part: written, read back and cleaned."""
    return load_rules(spark, _rule_file(spark, _part_rules(spark, sf_dir)))


def _rule_file(spark: SparkSession, rules: DataFrame) -> str:
    path = work_folder(spark, "rules")
    rules.write.option("header", True).csv(path)
    return path


def _part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small parts bound only the humidity, large ones only the temperature, promoted
    ones leave a side of both open, all others bound both sides of both."""
    low = F.col("p_retailprice") - 900
    size = F.col("p_size").cast("double")
    kind = F.col("p_type")
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.when(kind.isin("LARGE", "PROMO"), -999.0).otherwise(size).alias("humidity_min"),
        F.when(kind == "LARGE", -999.0)
        .when(kind == "PROMO", size / 5)
        .when(kind == "SMALL", size + 1)
        .otherwise(size + 10)
        .alias("humidity_max"),
        F.when(kind == "SMALL", -999.0)
        .when(kind == "PROMO", low + 200)
        .otherwise(low)
        .alias("temperature_min"),
        F.when(kind.isin("SMALL", "PROMO"), -999.0)
        .when(kind == "LARGE", low + 0.5)
        .otherwise(low + 5)
        .alias("temperature_max"),
        F.col("p_partkey").cast("string").alias("code"),
        F.col("p_name").alias("message"),
    )


# -- alerts -----------------------------------------------------------------


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(_alerts(spark, sf_dir))


def alerts_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = windows_of(_messages(spark, sf_dir))
    return _alert_rows(alerts_of(windows, default_rules(spark), ALERT_TIME))


def alerts_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(decode_alerts(encode_alerts(_alerts(spark, sf_dir))))


def alerts_many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches per rule for a rule table that grows with the data."""
    matches = match_rules(_windows(spark, sf_dir), clean_rules(_part_rules(spark, sf_dir)))
    return matches.groupBy("code").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min("window_start").cast("timestamp_ntz").alias("first_window"),
        F.max("window_start").cast("timestamp_ntz").alias("last_window"),
    )


def alerts_rules_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``alerts_many_rules``, with one more rule whose bounds lie far from all others."""
    far = default_rules(spark).limit(1).select(
        F.lit(0).alias("id"),
        F.lit(None).cast("double").alias("humidity_min"),
        F.lit(None).cast("double").alias("humidity_max"),
        F.lit(-1e9).alias("temperature_min"),
        F.lit(1e9).alias("temperature_max"),
        F.lit("far").alias("code"),
        F.lit("far").alias("message"),
    )
    rules = clean_rules(_part_rules(spark, sf_dir)).unionByName(far)
    return match_rules(_windows(spark, sf_dir), rules).groupBy("code").agg(
        F.count(F.lit(1)).alias("alerts")
    )


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages on disk to alert messages on disk through the streaming job."""
    folder = work_folder(spark, "alerts")
    topic, found = FileEndpoint(f"{folder}/readings"), FileEndpoint(f"{folder}/alerts")
    write_batch(_messages(spark, sf_dir).select("key", "value"), topic)
    rules = _rule_file(spark, spark.createDataFrame(list(DEFAULT_RULES), RULE_SCHEMA))
    start_fan_out(
        spark,
        topic,
        rules,
        checkpoint=f"{folder}/checkpoint",
        alerts_to=[found],
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    return _alert_rows(decode_alerts(read_batch(spark, found)))


def alerts_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of a job that is stopped after half of the time and started again."""
    folder = work_folder(spark, "restart")
    topic, found = FileEndpoint(f"{folder}/readings"), FileEndpoint(f"{folder}/alerts")
    rules = _rule_file(spark, spark.createDataFrame(list(DEFAULT_RULES), RULE_SCHEMA))
    for part in _parts_in_time(_table(spark, sf_dir, "events")):
        write_batch(event_messages(part).select("key", "value"), topic)
        start_fan_out(
            spark,
            topic,
            rules,
            checkpoint=f"{folder}/checkpoint",
            alerts_to=[found],
            trigger=AVAILABLE_NOW,
        ).awaitTermination()
    return _alert_rows(decode_alerts(read_batch(spark, found)))


def alerts_stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and alerts of one job, each from its own sink: the alerts of every window."""
    folder = work_folder(spark, "two-sinks")
    topic, found = FileEndpoint(f"{folder}/readings"), FileEndpoint(f"{folder}/alerts")
    closed = FileEndpoint(f"{folder}/windows", schema=WINDOW_SCHEMA)
    write_batch(_messages(spark, sf_dir).select("key", "value"), topic)
    rules = _rule_file(spark, spark.createDataFrame(list(DEFAULT_RULES), RULE_SCHEMA))
    start_fan_out(
        spark,
        topic,
        rules,
        checkpoint=f"{folder}/checkpoint",
        alerts_to=[found],
        windows_to=[closed],
        trigger=AVAILABLE_NOW,
    ).awaitTermination()
    fired = _alert_rows(decode_alerts(read_batch(spark, found)))
    codes = fired.groupBy("window_start").agg(F.array_sort(F.collect_list("code")).alias("codes"))
    windows = _window_rows(read_batch(spark, closed)).withColumn(
        "window_start", F.col("window_start").cast("string")
    )
    return windows.join(codes, "window_start", "left").select(
        "window_start", "t_avg", "h_avg", F.concat_ws(",", "codes").alias("codes")
    )


def alerts_stream_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of three running queries; the rule of code 104 is added to the rule file
    after the first half of the time."""
    folder = work_folder(spark, "separate")
    topic, found = FileEndpoint(f"{folder}/readings"), FileEndpoint(f"{folder}/alerts")
    halves = _parts_in_time(_table(spark, sf_dir, "events"))
    first = spark.createDataFrame(list(DEFAULT_RULES[:-1]), RULE_SCHEMA)
    last = spark.createDataFrame(list(DEFAULT_RULES[-1:]), RULE_SCHEMA)
    rules = _rule_file(spark, first)
    write_batch(event_messages(halves[0]).select("key", "value"), topic)
    queries = start_separate(
        spark,
        topic,
        rules,
        checkpoint=f"{folder}/checkpoint",
        alerts_to=found,
        alerts_shown=FileEndpoint(f"{folder}/shown"),
        windows_shown=FileEndpoint(f"{folder}/windows", schema=WINDOW_SCHEMA),
    )
    try:
        for query in queries:
            query.processAllAvailable()
        last.write.mode("append").option("header", True).csv(rules)
        write_batch(event_messages(halves[1]).select("key", "value"), topic)
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return _alert_rows(decode_alerts(read_batch(spark, found)))


def alerts_stream_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of three queries with an interval, and whether each was also shown.

    The sink of the shown ones fails at the first start, which stops all three; they are
    started again and run until none has more to read."""
    folder = work_folder(spark, "supervised")
    topic, found = FileEndpoint(f"{folder}/readings"), FileEndpoint(f"{folder}/alerts")
    shown = FileEndpoint(f"{folder}/shown")
    broken = FileEndpoint(f"{folder}/shown", format="no such format")
    rules = _rule_file(spark, spark.createDataFrame(list(DEFAULT_RULES), RULE_SCHEMA))
    write_batch(_messages(spark, sf_dir).select("key", "value"), topic)
    sinks = iter([broken])

    supervise(
        spark,
        lambda: start_separate(
            spark,
            topic,
            rules,
            checkpoint=f"{folder}/checkpoint",
            alerts_to=found,
            alerts_shown=next(sinks, shown),
            windows_shown=FileEndpoint(f"{folder}/windows", schema=WINDOW_SCHEMA),
            trigger="1 second",
        ),
        until_idle=True,
    )
    written, again = (_alert_rows(decode_alerts(read_batch(spark, s))) for s in (found, shown))
    times = again.groupBy("window_start", "code").agg(F.count(F.lit(1)).alias("times_shown"))
    return written.join(times, ["window_start", "code"], "full").select(
        *written.columns, "times_shown"
    )


# -- counts and reports -----------------------------------------------------


def _counted_in_batches(spark: SparkSession, sf_dir: str) -> str:
    """Where a job that is started three times, with more alerts each time, counts them."""
    folder = work_folder(spark, "ledger")
    topic = FileEndpoint(f"{folder}/alerts", max_files=1)
    alerts = _alerts(spark, sf_dir)
    start = F.col("window.start").cast("timestamp").cast("long")
    span = alerts.agg(F.min(start), F.max(start)).first()
    for third in range(3):
        low, high = (span[0] + (span[1] - span[0]) * part // 3 for part in (third, third + 1))
        part = alerts.filter((start > low) | F.lit(third == 0)).filter(start <= high)
        write_batch(encode_alerts(part.coalesce(1)), topic)
        start_running_counts(
            spark,
            topic,
            checkpoint=f"{folder}/checkpoint",
            counted_to=f"{folder}/counted",
            trigger=AVAILABLE_NOW,
        ).awaitTermination()
    return f"{folder}/counted"


def alert_running_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alert of a stream with the counts up to it, over batches and restarts."""
    counted = spark.read.parquet(f"{_counted_in_batches(spark, sf_dir)}/alerts")
    return counted.select(
        F.col("window.start").alias("window_start"), "code", *KNOWN_CODES.values(), "total"
    )


def alert_counts_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts so far of such a job: its totals by batch, added up."""
    return ledger_counts(spark, _counted_in_batches(spark, sf_dir))


def alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_code(_alerts(spark, sf_dir))


def alert_counts_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_row(_alerts(spark, sf_dir))


def alert_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts kept by a query over the alert messages, as last written by it."""
    folder = work_folder(spark, "counts")
    topic, latest = FileEndpoint(f"{folder}/alerts"), f"{folder}/latest"
    write_batch(encode_alerts(_alerts(spark, sf_dir)), topic)
    counts = count_by_code(decode_alerts(read_stream(spark, topic)))
    (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(latest))
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(latest)


def alert_counts_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of alert messages of which every batch was delivered twice."""
    folder = work_folder(spark, "replayed")
    topic, latest = FileEndpoint(f"{folder}/alerts"), f"{folder}/latest"
    for hour in (0, 1):  # the repeat carries another alert time
        time = ALERT_TIME.replace(hour=hour)
        found = alerts_of(_windows(spark, sf_dir), default_rules(spark), time)
        write_batch(encode_alerts(found), topic)
    counts = count_by_code(each_once(decode_alerts(read_stream(spark, topic))))
    (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(latest))
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(latest)


def alert_reports_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as the monitor writes them to a folder."""
    folder = work_folder(spark, "reports")
    topic, reports = FileEndpoint(f"{folder}/alerts"), FileEndpoint(f"{folder}/reports")
    found = _alerts(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("t_avg", "h_avg")})
    write_batch(encode_alerts(found), topic)
    for query in start_monitor(
        spark,
        topic,
        checkpoint=f"{folder}/checkpoint",
        reports_to=reports,
        statistics_to=FileEndpoint(f"{folder}/statistics"),
        trigger=AVAILABLE_NOW,
    ):
        query.awaitTermination()
    report = F.col("value").cast("string")
    return read_batch(spark, reports).select(
        F.regexp_extract(report, "Window: +(.{19}) to", 1).alias("window_start"),
        F.regexp_extract(report, "Code: +([^\n]*)", 1).alias("code"),
        report.alias("report"),
    )


def alert_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_counts(_alerts(spark, sf_dir)).select(
        F.col("window.start").alias("window_start"), "code", *KNOWN_CODES.values(), "total"
    )


def alert_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _alerts(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ("t_avg", "h_avg")})
    return format_alerts(found).select(
        F.col("window.start").alias("window_start"), "code", "report"
    )


def alert_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_counts(counts_row(_alerts(spark, sf_dir))).select("statistics")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        reading_roundtrip,
        message_keys,
        unkeyed_readings,
        malformed_messages,
        sliding_averages,
        sliding_averages_minute,
        sliding_averages_stream,
        late_readings_stream,
        rules_clean,
        alerts,
        alerts_from_messages,
        alerts_json_roundtrip,
        alerts_many_rules,
        alerts_rules_outlier,
        alerts_stream,
        alerts_stream_restart,
        alerts_stream_two_sinks,
        alerts_stream_separate,
        alerts_stream_supervised,
        averages_any_order,
        stream_measurements,
        open_windows,
        alert_running_counts_stream,
        alert_counts_ledger,
        alert_counts,
        alert_counts_row,
        alert_counts_stream,
        alert_counts_replayed,
        alert_reports_stream,
        alert_running_counts,
        alert_report,
        alert_statistics,
    )
    found = {query.__name__: query for query in named}
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


# -- SQL --------------------------------------------------------------------

READINGS_SQL = """
readings AS (
  SELECT CAST(user_id AS VARCHAR) AS sensor_id, value AS temperature,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS humidity,
         ts AS event_time
  FROM events)"""


def _windows_sql(size: int = 30, slide: int = 10) -> str:
    offsets = ", ".join(str(s) for s in range(0, size, slide))
    micros = slide * 1_000_000
    return f"""{READINGS_SQL},
windows AS (
  SELECT window_start, window_start + INTERVAL {size} SECOND AS window_end,
         avg(temperature) AS t_avg, avg(humidity) AS h_avg
  FROM (
    SELECT make_timestamp((epoch_us(event_time) // {micros}) * {micros}
                          - back * 1000000) AS window_start,
           temperature, humidity
    FROM (SELECT *, unnest([{offsets}]) AS back FROM readings))
  GROUP BY window_start)"""


CLOSED_SQL = "<= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND"

# Clicks come last and miss the windows that the events before them have closed.
LATE_SQL = f"""
WITH spread AS (
  SELECT make_timestamp((epoch_us(ts) // 10000000) * 10000000 - back * 1000000) AS window_start,
         event_type IS NOT DISTINCT FROM 'click' AS late, value AS temperature,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS humidity
  FROM (SELECT *, unnest([0, 10, 20]) AS back FROM events)),
closing AS (
  SELECT max(ts) FILTER (WHERE event_type IS DISTINCT FROM 'click') - INTERVAL 5 SECOND
    AS late_from
  FROM events)
SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end,
       round(avg(temperature), 6) AS t_avg, round(avg(humidity), 6) AS h_avg
FROM spread, closing
WHERE NOT late OR late_from IS NULL OR window_start + INTERVAL 30 SECOND > late_from
GROUP BY window_start
HAVING window_start + INTERVAL 30 SECOND {CLOSED_SQL}"""

# The same, with a page's text for each page and an unreadable time for each event beside.
MEASURED_SQL = f"""
WITH spread AS (
  SELECT make_timestamp((epoch_us(ts) // 10000000) * 10000000 - back * 1000000)
           + INTERVAL 30 SECOND AS window_end,
         event_type IS NOT DISTINCT FROM 'click' AS late
  FROM (SELECT *, unnest([0, 10, 20]) AS back FROM events WHERE ts IS NOT NULL)),
closing AS (
  SELECT max(ts) FILTER (WHERE event_type IS DISTINCT FROM 'click') - INTERVAL 5 SECOND
    AS late_from
  FROM events),
judged AS (
  SELECT window_end, coalesce(late AND window_end <= late_from, false) AS dropped
  FROM spread, closing)
SELECT CAST((SELECT count(*) FROM events) * 2 + (SELECT count(*) FROM pages) AS BIGINT) AS messages,
       (SELECT count(*) FROM pages) AS unreadable, (SELECT count(*) FROM events) AS untimed,
       count(*) AS window_readings,
       count(*) FILTER (WHERE NOT dropped AND window_end {CLOSED_SQL}) AS closed_readings,
       count(*) FILTER (WHERE dropped) AS late_readings
FROM judged"""

RULES_SQL = """
rules AS (
  SELECT * FROM (VALUES
    (0.0, 40.0, NULL, NULL, '101', 'It''s too dry'),
    (60.0, 100.0, NULL, NULL, '102', 'It''s too wet'),
    (NULL, NULL, -300.0, 30.0, '103', 'It''s too cold'),
    (NULL, NULL, 40.0, 300.0, '104', 'It''s too hot'))
  AS r(humidity_min, humidity_max, temperature_min, temperature_max, code, message))"""

PART_RULES_SQL = """
SELECT CAST(p_partkey AS INTEGER) AS id,
       CASE WHEN p_type NOT IN ('LARGE', 'PROMO') THEN CAST(p_size AS DOUBLE) END
         AS humidity_min,
       CASE p_type WHEN 'LARGE' THEN NULL WHEN 'PROMO' THEN CAST(p_size AS DOUBLE) / 5
         WHEN 'SMALL' THEN CAST(p_size AS DOUBLE) + 1 ELSE CAST(p_size AS DOUBLE) + 10 END
         AS humidity_max,
       CASE p_type WHEN 'SMALL' THEN NULL WHEN 'PROMO' THEN p_retailprice - 900 + 200
         ELSE p_retailprice - 900 END AS temperature_min,
       CASE WHEN p_type IN ('SMALL', 'PROMO') THEN NULL
         WHEN p_type = 'LARGE' THEN p_retailprice - 900 + 0.5::DOUBLE
         ELSE p_retailprice - 900 + 5 END AS temperature_max,
       CAST(p_partkey AS VARCHAR) AS code, p_name AS message
FROM part"""

MATCH_SQL = """
  FROM windows JOIN rules
    ON (temperature_min IS NULL OR t_avg >= temperature_min)
   AND (temperature_max IS NULL OR t_avg <= temperature_max)
   AND (humidity_min IS NULL OR h_avg >= humidity_min)
   AND (humidity_max IS NULL OR h_avg <= humidity_max)"""

ALERTS_SQL = f"""{_windows_sql()},{RULES_SQL},
alerts AS (
  SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
         round(t_avg, 6) AS t_avg, round(h_avg, 6) AS h_avg, code, message
  {MATCH_SQL})"""

WINDOW_ROWS_SQL = (
    "SELECT window_start, window_end, round(t_avg, 6) AS t_avg, round(h_avg, 6) AS h_avg "
    "FROM windows"
)

COUNTS_SQL = ", ".join(
    [f"count(*) FILTER (WHERE code = '{c}') AS {name}" for c, name in KNOWN_CODES.items()]
    + ["count(*) AS total"]
)

RUNNING_SQL = ", ".join(
    [
        f"count(*) FILTER (WHERE code = '{c}') OVER so_far AS {name}"
        for c, name in KNOWN_CODES.items()
    ]
    + ["count(*) OVER so_far AS total"]
)


def oracle_sql() -> dict[str, str]:
    found = f"WITH {ALERTS_SQL} SELECT * FROM alerts"
    counts = f"WITH {ALERTS_SQL} SELECT code, count(*) AS alerts FROM alerts GROUP BY code"
    reports = f"""
WITH {ALERTS_SQL}
SELECT window_start, code, concat_ws(chr(10),
  repeat('=', 80),
  '🚨 ALERT: ' || message,
  repeat('-', 80),
  '📊 Code:        ' || code,
  '🌡️  Temperature: ' || printf('%.2f', t_avg) || '°C',
  '💧 Humidity:    ' || printf('%.2f', h_avg) || '%',
  '⏰ Window:      ' || window_start || ' to ' || window_end,
  '🕐 Alert Time:  2024-02-01 00:00:00',
  repeat('=', 80)) AS report
FROM alerts"""
    running = f"""
WITH {ALERTS_SQL}
SELECT window_start, code, {RUNNING_SQL}
FROM alerts
WINDOW so_far AS (ORDER BY window_start, code
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    more = {}
    if llm is not None:
        more = llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return more | {
        "reading_roundtrip": f"WITH {READINGS_SQL} SELECT * FROM readings",
        "message_keys": "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages "
        "FROM events GROUP BY user_id",
        "unkeyed_readings": "SELECT count(*) AS messages, CAST(0 AS BIGINT) AS keyed_messages "
        "FROM events",
        "malformed_messages": """
SELECT 'readings' AS source, count(*) AS messages, count(user_id) AS with_sensor,
       count(value) AS with_temperature, count(ts) AS with_event_time FROM events
UNION ALL SELECT 'badly timed', count(*), count(user_id), count(value), 0 FROM events
UNION ALL SELECT 'other json', count(*), 0, 0, 0 FROM events
UNION ALL SELECT 'prose', count(*), 0, 0, 0 FROM documents
UNION ALL SELECT 'html', count(*), 0, 0, 0 FROM pages""",
        "sliding_averages": f"WITH {_windows_sql()} {WINDOW_ROWS_SQL}",
        "sliding_averages_minute": f"WITH {_windows_sql(60, 30)} {WINDOW_ROWS_SQL}",
        "sliding_averages_stream": f"WITH {_windows_sql()} {WINDOW_ROWS_SQL} "
        f"WHERE window_end {CLOSED_SQL}",
        "late_readings_stream": LATE_SQL,
        "stream_measurements": MEASURED_SQL,
        "open_windows": f"WITH {_windows_sql()} {WINDOW_ROWS_SQL} "
        f"WHERE window_end {CLOSED_SQL.replace('<=', '>')}",
        "rules_clean": PART_RULES_SQL,
        "alerts": found,
        "alerts_from_messages": found,
        "alerts_json_roundtrip": found,
        "alerts_many_rules": f"""
WITH {_windows_sql()}, rules AS ({PART_RULES_SQL})
SELECT code, count(*) AS alerts, min(window_start) AS first_window,
       max(window_start) AS last_window
{MATCH_SQL}
GROUP BY code""",
        "alerts_stream": f"{found} WHERE CAST(window_end AS TIMESTAMP) {CLOSED_SQL}",
        "alerts_stream_restart": f"{found} WHERE CAST(window_end AS TIMESTAMP) {CLOSED_SQL}",
        "alerts_stream_supervised": f"""
WITH {ALERTS_SQL}
SELECT *, CAST(1 AS BIGINT) AS times_shown FROM alerts
WHERE CAST(window_end AS TIMESTAMP) {CLOSED_SQL}""",
        "alerts_stream_two_sinks": f"""
WITH {ALERTS_SQL},
codes AS (SELECT window_start, string_agg(code, ',' ORDER BY code) AS codes
          FROM alerts GROUP BY window_start)
SELECT strftime(w.window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       round(w.t_avg, 6) AS t_avg, round(w.h_avg, 6) AS h_avg, coalesce(c.codes, '') AS codes
FROM windows w LEFT JOIN codes c
  ON c.window_start = strftime(w.window_start, '%Y-%m-%d %H:%M:%S')
WHERE w.window_end {CLOSED_SQL}""",
        "alert_counts": counts,
        "alert_counts_row": f"WITH {ALERTS_SQL} SELECT {COUNTS_SQL} FROM alerts",
        "alert_counts_stream": counts,
        "alert_running_counts": running,
        "alert_running_counts_stream": running,
        "alert_counts_ledger": counts,
        "averages_any_order": f"WITH {_windows_sql()} {WINDOW_ROWS_SQL}".replace(
            " FROM windows", ", true AS same FROM windows"
        ),
        # Windows closed by the first half's readings know three rules, later ones four.
        "alerts_stream_separate": f"""
{found} WHERE CAST(window_end AS TIMESTAMP) {CLOSED_SQL}
AND (code <> '104' OR CAST(window_end AS TIMESTAMP) > (
  SELECT max(ts) - INTERVAL 5 SECOND FROM events
  WHERE 2 * epoch_us(ts) <= (SELECT min(epoch_us(ts)) + max(epoch_us(ts)) FROM events)))""",
        "alert_report": reports,
        "alert_reports_stream": reports,
        "alert_counts_replayed": counts,
        "alerts_rules_outlier": f"""
WITH {_windows_sql()}, rules AS ({PART_RULES_SQL}
UNION ALL SELECT 0, NULL, NULL, -1e9, 1e9, 'far', 'far')
SELECT code, count(*) AS alerts
{MATCH_SQL}
GROUP BY code""",
        "alert_statistics": f"""
WITH {ALERTS_SQL}, counts AS (SELECT {COUNTS_SQL} FROM alerts)
SELECT concat_ws(chr(10), '📈 Statistics:', '   Too dry:  ' || too_dry,
  '   Too wet:  ' || too_wet, '   Too cold: ' || too_cold,
  '   Too hot:  ' || too_hot, '   Total:    ' || total) AS statistics
FROM counts""",
    }
