"""Sliding event-time averages."""

from __future__ import annotations

from functools import cache
from math import gcd

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dewpoint.functions import exact_average, exponent_group, in_units, parts_of
from dewpoint.schemas import WATERMARK, WINDOW_SIZE, WINDOW_SLIDE

# The measures and their columns in a reading.
MEASURES = {"t": "temperature", "h": "humidity"}
# The fields that are read from a message.
READ = ("sensor_id", *MEASURES.values(), "event_time")
# Of a window and two exponent groups: per measure three parts of the sum, and its values.
GROUPS = tuple(f"{m}_group" for m in MEASURES)
SUMS = tuple(f"{m}_{i}" for m in MEASURES for i in (0, 1, 2, "n"))
# What a measured stream observes: its messages, and the windows it closes; and what it
# counts beside the sums: the readings, with or without values.
ARRIVED, CLOSED, READINGS = "arrived", "closed", "readings"


def sliding_averages(
    readings: DataFrame,
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    watermark: str = WATERMARK,
    measured: bool = False,
) -> DataFrame:
    """Average temperature and humidity over all sensors per sliding window.

    Needs ``event_time, temperature, humidity``; gives ``window_start, window_end,
    t_avg, h_avg``. Windows are aligned to the epoch, start inclusive. Readings
    without an event time belong to no window, null measurements do not count.

    Sums are exact (see ``functions.exact``), so an average depends on nothing but the
    readings: not on their order, on how they are cut into partitions or batches, nor on
    whether they come from a table or a stream.

    On a stream, ``watermark`` bounds the lateness and a window is emitted once,
    when it closes. Lateness is judged per window, so each reading goes straight
    to its windows. On a table nothing is late, and the readings are first summed
    per pane (the greatest length dividing size and slide): each reading is then
    aggregated and shuffled once instead of size/slide times, and only panes are
    spread over their windows.

    The readings of a window are summed by the groups of their exponents, of which
    measurements of one kind have few. A second aggregate puts these together; on a stream
    it has a state of its own, which is empty between batches.

    A ``measured`` stream also observes what it reads and closes, for the reports of
    ``streaming.BatchMeasurements``. Its state holds a count more, so a job is measured
    from its first start or not at all.
    """
    if not readings.isStreaming:
        return averages_of_sums(_summed_from_panes(_in_units(readings), size, slide))
    counts = _sums_of_units()
    if measured:
        readings = _observed(readings, size, slide)
        counts.append(F.count(F.lit(1)).alias(READINGS))
    timed = _in_units(readings).withWatermark("event_time", watermark)
    summed = timed.groupBy(F.window("event_time", size, slide), *GROUPS).agg(*counts)
    if measured:
        summed = summed.observe(CLOSED, F.sum(READINGS).alias("window_readings"))
    return averages_of_sums(summed)


def _observed(readings: DataFrame, size: str, slide: str) -> DataFrame:
    """Counts messages, those without any readable field, readings without a time, and
    readings once for every window they belong to."""
    length, step = _micros(readings.sparkSession, size, slide)
    micros = F.unix_micros("event_time")
    # Windows start at multiples of the slide, later than a length before the reading.
    first, last = (t - F.pmod(t, F.lit(step)) for t in (micros - length, micros))
    fields = [c for c in readings.columns if c in READ]
    unreadable = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull()
    return readings.observe(
        ARRIVED,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(unreadable).alias("unreadable"),
        F.count_if(~unreadable & F.col("event_time").isNull()).alias("untimed"),
        F.sum(((last - first) / step).cast("long")).alias("window_readings"),
    )


def averages_of_sums(summed: DataFrame) -> DataFrame:
    """Windows from sums by exponent group: ``window`` and the columns of ``GROUPS`` and
    ``SUMS``."""
    sums = [
        F.struct(
            F.collect_list(
                F.when(  # nulls are not collected
                    F.col(f"{m}_group").isNotNull(),
                    F.struct(
                        F.col(f"{m}_group").alias("group"),
                        *[F.col(f"{m}_{i}").alias(f"part{i}") for i in range(3)],
                    ),
                )
            ).alias("sums"),
            F.sum(f"{m}_n").alias("n"),
        )
        for m in MEASURES
    ]
    averages = _averages(summed.sparkSession.sparkContext)
    return (
        summed.groupBy("window")
        .agg(F.array(*sums).alias("sums"))
        .select("window", averages.alias("averages"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *[F.get("averages", F.lit(i)).alias(f"{m}_avg") for i, m in enumerate(MEASURES)],
        )
    )


@cache
def _averages(context: SparkContext) -> Column:
    """The averages of all measures in one expression: it is long, and takes longer to put
    together than to run on a small table."""
    return F.transform("sums", lambda s: exact_average(s["sums"], s["n"]))


def _in_units(readings: DataFrame) -> DataFrame:
    """Readings as event time, and per measure its exponent group and units.

    Generators keep the groups and units from being computed again at every use.
    """
    groups = F.struct(
        *[exponent_group(F.col(c)).alias(f"{m}_group") for m, c in MEASURES.items()]
    )
    units = F.struct(
        *[
            in_units(F.col(c), F.col(f"{m}_group")).alias(f"{m}_units")
            for m, c in MEASURES.items()
        ]
    )
    grouped = readings.select("event_time", *MEASURES.values(), F.inline(F.array(groups)))
    return grouped.select("*", F.inline(F.array(units)))


def _sums_of_units() -> list[Column]:
    """Per measure the sums of its units' parts and the number of its values."""
    sums = []
    for m, c in MEASURES.items():
        parts = parts_of(F.col(f"{m}_units"))
        sums += [F.sum(part).alias(f"{m}_{i}") for i, part in enumerate(parts)]
        sums.append(F.count(c).alias(f"{m}_n"))
    return sums


def _summed_from_panes(measured: DataFrame, size: str, slide: str) -> DataFrame:
    pane = f"{gcd(*_micros(measured.sparkSession, size, slide))} microseconds"
    panes = (
        measured.groupBy(F.window("event_time", pane).alias("pane"), *GROUPS)
        .agg(*_sums_of_units())
        .select(F.col("pane.start").alias("pane_start"), *GROUPS, *SUMS)
    )
    # Dealt by window once, for this aggregate and the next.
    spread = panes.select(F.window("pane_start", size, slide).alias("window"), *GROUPS, *SUMS)
    return (
        spread.repartition("window")
        .groupBy("window", *GROUPS)
        .agg(*[F.sum(c).alias(c) for c in SUMS])
    )


def _micros(spark: SparkSession, *durations: str) -> list[int]:
    """Durations in microseconds, read by Spark itself; a constant, for which no job runs."""
    lengths = [
        f"unix_micros(timestamp_seconds(0) + CAST(:d{i} AS INTERVAL))"
        for i in range(len(durations))
    ]
    args = {f"d{i}": duration for i, duration in enumerate(durations)}
    micros = list(spark.sql(f"SELECT {', '.join(lengths)}", args=args).first())
    if None in micros:
        raise ValueError(f"not a duration among {durations}")
    return micros
