import math
import random

import pytest
from pyspark.sql import functions as F

from dewpoint.operators import default_rules, match_rules
from dewpoint.schemas import RULE_SCHEMA

WINDOWS = "window_start timestamp, window_end timestamp, t_avg double, h_avg double"
WAYS = [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "levels": 2, "crowded": 3}]


def windows(spark, averages):
    rows = [(float(t) if t is not None else None, h, i) for i, (t, h) in enumerate(averages)]
    frame = spark.createDataFrame(rows, "t_avg double, h_avg double, i int")
    start = F.timestamp_seconds(F.col("i") * 10)
    end = F.timestamp_seconds(F.col("i") * 10 + 30)
    return frame.select(start.alias("window_start"), end.alias("window_end"), "t_avg", "h_avg")


def rules(spark, bounds):
    """Rules of (humidity_min, humidity_max, temperature_min, temperature_max)."""
    rows = [(i, *b, str(i), f"rule {i}") for i, b in enumerate(bounds)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


# Temperature, humidity and the codes of the shipped rules they fire.
CASES = [
    (45.0, 10.0, "101 104"),
    (25.0, 85.0, "102 103"),
    (50.0, 95.0, "102 104"),
    (15.0, 5.0, "101 103"),
    (33.75, 48.75, ""),
    (30.0, 50.0, "103"),
    (40.0, 50.0, "104"),
    (300.0, 50.0, "104"),
    (300.01, 50.0, ""),
    (35.0, 40.0, "101"),
    (35.0, 60.0, "102"),
    (35.0, 0.0, "101"),
    (35.0, -0.01, ""),
    (39.95, 54.96, ""),
    (None, 50.0, ""),
    (None, 85.0, "102"),
    (math.nan, 50.0, ""),
]


@pytest.mark.parametrize("way", WAYS)
def test_shipped_rules(spark, way):
    table = windows(spark, [(t, h) for t, h, _ in CASES])
    codes = [[] for _ in CASES]
    for row in match_rules(table, default_rules(spark), **way).collect():
        codes[int(row.window_start.timestamp()) // 10].append(row.code)
    assert [" ".join(sorted(c)) for c in codes] == [c for _, _, c in CASES]


def test_other_bounds_than_the_shipped_ones(spark):
    table = rules(spark, [(None, None, 38.0, 300.0), (None, None, None, 35.0)])
    found = match_rules(windows(spark, [(39.95, 54.96)]), table).collect()
    assert [r.code for r in found] == ["0"]


@pytest.mark.parametrize("way", WAYS)
def test_open_and_crossed_rules(spark, way):
    averages = [(1.0, 1.0), (None, None), (math.nan, 2.0), (math.inf, -math.inf)]
    table = rules(
        spark,
        [(None,) * 4, (50.0, 10.0, None, None), (None, None, 60.0, 20.0), (None, None, 0.0, None)],
    )
    found = match_rules(windows(spark, averages), table, **way).collect()
    per_rule = [sum(r.code == c for r in found) for c in "0123"]
    assert per_rule == [4, 0, 0, 3]


def test_both_ways_equal_brute_force(spark):
    draw = random.Random(5)

    def value(low, high):
        some = draw.uniform(low, high)
        return draw.choice([None, float(round(some)), round(some, 1)])

    averages = [(value(-20, 60), value(0, 100)) for _ in range(200)]
    averages += [(math.nan, 5.0), (math.inf, 50.0), (-math.inf, None), (20.0, math.nan)]
    averages += [(25.0, 50.0)] * 100  # a crowded bin
    bounds = []
    for _ in range(150):
        h, t = value(0, 100), value(-20, 60)
        bounds.append(
            (h, None if h is None else draw.choice([None, h + draw.randint(-2, 30)]),
             t, draw.choice([None, value(-20, 60)]))
        )
    bounds += [(None, None, None, math.inf), (math.nan, None, None, None)]
    bounds += [(-math.inf, 3.0, None, None), (None, None, -1e308, 1e308)]
    bounds += [(0.0, 5e-324, None, None), (-1e308, 1e308, -1e308, 1e308)]
    averages += [(1e308, 0.0), (-1e308, 5e-324), (5e-324, -0.0)]

    def at_least(v, low):  # NaN sorts above everything
        if low is None:
            return True
        if v is None:
            return False
        return math.isnan(v) or (not math.isnan(low) and v >= low)

    def at_most(v, high):
        return high is None or (v is not None and at_least(high, v))

    def matches(a, b):
        (t, h), (h_lo, h_hi, t_lo, t_hi) = a, b
        return (
            at_least(t, t_lo) and at_most(t, t_hi) and at_least(h, h_lo) and at_most(h, h_hi)
        )

    expected = sorted(
        (i, str(j)) for i, a in enumerate(averages) for j, b in enumerate(bounds) if matches(a, b)
    )
    assert len(expected) > 1000
    for way in WAYS:
        found = match_rules(windows(spark, averages), rules(spark, bounds), **way)
        pairs = found.select((F.unix_seconds("window_start") / 10).cast("int"), "code").collect()
        assert sorted((i, c) for i, c in pairs) == expected


def test_same_columns_both_ways(spark):
    w, r = windows(spark, [(45.0, 10.0)]), default_rules(spark)
    assert match_rules(w, r).dtypes == match_rules(w, r, broadcast_bytes=0).dtypes


def test_plans(spark):
    w, r = windows(spark, [(45.0, 10.0)]), default_rules(spark)

    def plan(frame):
        return frame._jdf.queryExecution().sparkPlan().toString()

    small = plan(match_rules(w, r))
    assert "BroadcastHashJoin" in small
    assert not any(word in small for word in ("NestedLoop", "Cartesian", "ExistingRDD[id"))
    binned = plan(match_rules(w, r, broadcast_bytes=0))
    assert "SortMergeJoin" in binned
    assert not any(word in binned for word in ("NestedLoop", "Cartesian", "Broadcast"))


def test_large_texts_are_not_broadcast(spark):
    long = default_rules(spark).withColumn("message", F.repeat(F.lit("x"), 2_000_000))
    w = windows(spark, [(45.0, 10.0)])
    plan = match_rules(w, long)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in plan
    assert match_rules(w, long).count() == 2


def test_a_rule_is_filed_in_few_cells(spark):
    from dewpoint.operators import alerts as module

    bounds = [(None, None, float(a), float(b)) for a in range(64) for b in range(a, 64)]
    table = rules(spark, bounds)
    filed = module._filed(table, module._edges(table, 8)[0], 8).groupBy("code").count()
    assert filed.agg(F.max("count")).first()[0] <= 2 * 8
    assert filed.count() == len(bounds)


def test_no_rules(spark):
    assert match_rules(windows(spark, [(1.0, 2.0)]), rules(spark, [(1.0, 2.0, 3.0, 4.0)]).limit(0)).count() == 0
