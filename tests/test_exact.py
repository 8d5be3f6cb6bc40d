import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from dewpoint.operators import sliding_averages

SCHEMA = "event_time timestamp, temperature double, humidity double"
NAN, INF = float("nan"), float("inf")


def expected(values):
    """The exact sum, rounded once, over the number of values."""
    there = [v for v in values if v is not None]
    if not there:
        return None
    if any(map(math.isnan, there)) or {INF, -INF} <= set(there):
        return NAN
    for end in (INF, -INF):
        if end in there:
            return end
    try:
        return float(sum(map(Fraction, there), Fraction(0))) / len(there)
    except OverflowError:
        return INF


def windows_of_values(spark, cases, cuts, seed):
    """A window per case, its readings in random order and partitions."""
    rows = [(3600 * i, v) for i, case in enumerate(cases) for v in case]
    random.Random(seed).shuffle(rows)
    frame = spark.createDataFrame(rows, "at long, temperature double").select(
        F.timestamp_seconds("at").alias("event_time"), "temperature", (-F.col("temperature")).alias("humidity")
    )
    found = sliding_averages(frame.repartition(cuts), "30 seconds", "30 seconds")
    return {
        int(r.at) // 3600: (r.t_avg, r.h_avg)
        for r in found.select(F.col("window_start").cast("long").alias("at"), "t_avg", "h_avg").collect()
    }


def cases():
    draw = random.Random(11)
    found = [
        [0.1] * 10, [1e300, 1.0, -1e300], [1e16, 1.0, -1e16], [0.0, -0.0], [None], [5e-324] * 3,
        [2.0**k for k in range(-1074, 1024, 61)], [-(2.0**k) for k in range(-1074, 1020, 7)],
        [1.7976931348623157e308, -1.7976931348623157e308, 1e-300], [NAN, 1.0], [INF, 1.0], [-INF, INF],
        [-INF, 2.0, None], [30.0] * 7 + [None], [2.0**-30, 2.0**40, -(2.0**40)], [4.0, 2.0, 1.0, 0.5],
    ]
    for _ in range(60):
        width = draw.choice((1, 6, 40, 300))
        found.append([draw.uniform(-1, 1) * 2.0 ** draw.randint(-width, width) for _ in range(draw.choice((1, 2, 9, 50)))])
    found += [[round(draw.uniform(15, 50), 2) for _ in range(draw.randint(1, 400))] for _ in range(20)]
    for case in list(found[16:30]):
        found.append([*case, *[-v for v in case[1:]]])  # nearly all cancels
    return found


def test_averages_are_those_of_exact_sums(spark):
    all_ = cases()
    for cuts, seed in ((1, 1), (7, 2)):
        found = windows_of_values(spark, all_, cuts, seed)
        for i, case in enumerate(all_):
            want = expected(case)
            for got, sign in zip(found[i], (1, -1)):
                if want is None:
                    assert got is None
                elif math.isnan(want):
                    assert math.isnan(got)
                else:
                    assert got == sign * want, (case, got, want)


def test_window_exactly_on_a_bound(spark):
    """Ten readings of 30.1 and 29.9 average to 30 in any order, so the rule fires always."""
    from dewpoint.operators import default_rules, match_rules

    for order in ([30.1, 29.9] * 5, [30.1] * 5 + [29.9] * 5):
        rows = [(i, v) for i, v in enumerate(order)]
        frame = spark.createDataFrame(rows, "at long, temperature double").select(
            F.timestamp_seconds("at").alias("event_time"), "temperature", F.lit(50.0).alias("humidity")
        )
        windows = sliding_averages(frame.coalesce(1), "30 seconds", "30 seconds")
        assert [r.t_avg for r in windows.collect()] == [30.0]
        assert [r.code for r in match_rules(windows, default_rules(spark)).collect()] == ["103"]
