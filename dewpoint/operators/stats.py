"""Counts over alerts, and alerts as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dewpoint.functions import two_places
from dewpoint.schemas import CODE_LABELS, KNOWN_CODES
from dewpoint.session import checkpointed

# Fixed texts of the printed report.
HEAVY_LINE = "=" * 80
LIGHT_LINE = "-" * 80
ALERT_LABEL = "🚨 ALERT: "
CODE_LABEL = "📊 Code:        "
TEMPERATURE_LABEL = "🌡️  Temperature: "
HUMIDITY_LABEL = "💧 Humidity:    "
WINDOW_LABEL = "⏰ Window:      "
TIME_LABEL = "🕐 Alert Time:  "
STATISTICS_LABEL = "📈 Statistics:"
UNKNOWN_MESSAGE = "Unknown"
NOT_AVAILABLE = "N/A"

# How many equal alerts one row of the running counts stands for at most.
_COPIES_PER_ROW = 1_000


def count_by_code(alerts: DataFrame) -> DataFrame:
    """Alerts per counted code. On a stream, run it in complete or update mode."""
    return (
        alerts.filter(F.col("code").isin(*KNOWN_CODES))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("alerts"))
    )


def each_once(alerts: DataFrame, delay: str | None = None) -> DataFrame:
    """Alerts without repeats: of equal window, code and message one stays.

    A batch that is delivered again carries a new time, which is no part of the key. On a
    stream the state holds one key per alert, for good. ``delay`` (for example "1 day")
    bounds it: repeats are then recognised within that time after the alert, and alerts
    that come later than that behind the newest are dropped.
    """
    keys = ["window", "code", "message"]
    if delay is None or not alerts.isStreaming:
        return alerts.dropDuplicates(keys)
    timed = alerts.withColumn("_at", F.try_to_timestamp("timestamp"))
    return timed.withWatermark("_at", delay).dropDuplicatesWithinWatermark(keys).drop("_at")


def counts_row(alerts: DataFrame) -> DataFrame:
    """One row with a column per counted code, zero when unseen, and their total."""
    return alerts.agg(
        *[F.count_if(F.col("code") == c).alias(name) for c, name in KNOWN_CODES.items()],
        F.count_if(F.col("code").isin(*KNOWN_CODES)).alias("total"),
    )


def running_counts(alerts: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each alert with the counts per code and the total up to and including it.

    Alerts are taken in order of window start and counted code; alerts of equal
    window and code are numbered in some fixed order. Codes that are not counted
    keep their row, come first in their window and change no counter.

    A running count over one global order would put all alerts into one task.
    Instead, the alerts are dealt to ranges of that order, of about equal numbers of rows
    (``ranges`` of them, else as many as Spark makes shuffle partitions). The counts before
    an alert are those of the ranges before its own, one row of totals each, plus those
    before it in its range. Equal alerts travel as rows with a number of copies.
    """
    codes = KNOWN_CODES.items()
    order = ["_start", "_code", *alerts.columns, "_first"]
    dealt = checkpointed(_in_ranges(alerts, order, ranges))

    def copies_of(code: str) -> Column:
        return F.when(F.col("_code") == code, F.col("_n")).otherwise(F.lit(0))

    totals = dealt.groupBy("_range").agg(*[F.sum(copies_of(c)).alias(n) for c, n in codes])
    before_range = Window.orderBy("_range")
    earlier = totals.select(
        F.col("_range").alias("_range_of"),
        *[_sum_before(F.col(n), before_range).alias(f"_{n}") for _, n in codes],
    )
    before_alert = Window.partitionBy("_range").orderBy(*order)
    numbered = (
        dealt.withColumns({n: _sum_before(copies_of(c), before_alert) for c, n in codes})
        .join(earlier, F.col("_range") == F.col("_range_of"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    )
    return numbered.select(
        *alerts.columns,
        *[
            (
                F.col(n)
                + F.col(f"_{n}")
                + F.when(F.col("_code") == c, F.col("_copy")).otherwise(F.lit(0))
            ).alias(n)
            for c, n in codes
        ],
    ).withColumn("total", reduce(Column.__add__, map(F.col, KNOWN_CODES.values())))


def _in_ranges(alerts: DataFrame, order: list[str], ranges: int | None) -> DataFrame:
    """Distinct alerts with their copies ``_n``, dealt to ranges of ``order``.

    ``_range`` rises with the order. An alert with many copies is cut into several rows, so
    that it can lie in several ranges.
    """
    distinct = alerts.groupBy(*alerts.columns).agg(F.count(F.lit(1)).alias("_copies"))
    first = F.sequence(F.lit(1).cast("long"), F.col("_copies"), F.lit(_COPIES_PER_ROW))
    code = F.when(F.col("code").isin(*KNOWN_CODES), F.col("code")).otherwise(F.lit(""))
    rows = distinct.withColumn("_first", F.explode(first)).select(
        *alerts.columns,
        "_first",
        F.least(F.col("_copies") - F.col("_first") + 1, F.lit(_COPIES_PER_ROW)).alias("_n"),
        F.coalesce(F.col("window.start"), F.lit("")).alias("_start"),
        code.alias("_code"),
    )
    dealt = (
        rows.repartitionByRange(*order) if ranges is None
        else rows.repartitionByRange(ranges, *order)
    )
    return dealt.withColumn("_range", F.spark_partition_id())


def _sum_before(column: Column, order: WindowSpec) -> Column:
    frame = order.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(frame), F.lit(0))


def format_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts with a ``report`` column: the printed block, defaults for missing fields."""

    def or_else(value: Column, default: str) -> Column:
        return F.coalesce(value, F.lit(default))

    def number(value: Column) -> Column:
        return two_places(F.coalesce(value, F.lit(0.0)))

    report = F.concat_ws(
        "\n",
        F.lit(HEAVY_LINE),
        F.concat(F.lit(ALERT_LABEL), or_else(F.col("message"), UNKNOWN_MESSAGE)),
        F.lit(LIGHT_LINE),
        F.concat(F.lit(CODE_LABEL), or_else(F.col("code"), NOT_AVAILABLE)),
        F.concat(F.lit(TEMPERATURE_LABEL), number(F.col("t_avg")), F.lit("°C")),
        F.concat(F.lit(HUMIDITY_LABEL), number(F.col("h_avg")), F.lit("%")),
        F.concat(
            F.lit(WINDOW_LABEL),
            or_else(F.col("window.start"), NOT_AVAILABLE),
            F.lit(" to "),
            or_else(F.col("window.end"), NOT_AVAILABLE),
        ),
        F.concat(F.lit(TIME_LABEL), or_else(F.col("timestamp"), NOT_AVAILABLE)),
        F.lit(HEAVY_LINE),
    )
    return alerts.withColumn("report", report)


def format_counts(counts: DataFrame) -> DataFrame:
    """Counter columns with a ``statistics`` column: the printed block of counts."""
    labels = {KNOWN_CODES[c]: label for c, label in CODE_LABELS.items()} | {"total": "Total"}
    width = max(len(label) for label in labels.values()) + 3
    lines = [
        F.concat(F.lit("   " + f"{label}:".ljust(width - 1)), F.col(name).cast("string"))
        for name, label in labels.items()
    ]
    return counts.withColumn(
        "statistics", F.concat_ws("\n", F.lit(STATISTICS_LABEL), *lines)
    )
