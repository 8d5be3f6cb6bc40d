"""Matching windows against rules, and the alerts this gives."""

from __future__ import annotations

from datetime import datetime
from math import isnan

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from dewpoint.functions import in_range
from dewpoint.schemas import BOUND_COLUMNS

# What the filed rules may take when they are broadcast; beyond it they are merge-joined.
BROADCAST_BYTES = 32 * 1024 * 1024
# So many crowded cells are broadcast; beyond it they are joined by a shuffle.
BROADCAST_CELLS = 100_000
MEASURES = {"temperature": "t_avg", "humidity": "h_avg"}
LEVELS = [f"_{m}_level" for m in MEASURES]
CELLS = [f"_{m}_cell" for m in MEASURES]


def match_rules(
    windows: DataFrame,
    rules: DataFrame,
    *,
    levels: int = 8,
    crowded: int = 4_096,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per window and rule whose ranges contain both averages.

    One equi-join for every rule table. Each measure is cut into ``2 ** levels`` bins at
    quantiles of the rules' bounds; a value's bin is the number of edges that are not above
    it, so bins keep the order of all doubles, infinities and NaN included. Bins nest into
    cells of twice the length per level. A rule is filed by both measures at once: at the
    level of each whose cells have a quarter to half the length of its range, in every
    rectangle of two cells that meets its ranges, 25 at most. A measure without bounds is
    one cell at the level above all. A window looks in its rectangle for every pair of
    levels that is used, so it meets a rule once, and about half of the rules it meets fit;
    the exact test follows. The rules of a rectangle that holds more than ``crowded`` of
    them are dealt to several parts, and the windows of that rectangle look in each.

    The rules are measured first: one aggregate for the edges and the longest rule, one for
    the pairs of levels, of which there are ``(levels + 1) ** 2`` at most. If the filed
    rules take at most ``broadcast_bytes`` they are broadcast, else merge-joined: the same
    join with the same rows.
    """
    edges, longest = _edges(rules, levels)
    filed = _filed(rules, edges, levels)
    cells = filed.groupBy(*LEVELS, *CELLS).agg(F.count(F.lit(1)).alias("_n"))
    measured = (
        cells.groupBy(*LEVELS)
        .agg(F.sum("_n").alias("n"), F.count_if(F.col("_n") > crowded).alias("crowded"))
        .collect()
    )
    if not measured:
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rules.schema.fields]
        return windows.filter(F.lit(False)).select(*windows.columns, *none)
    bins = F.struct(*[_bin(F.col(c), edges[m]).alias(f"_{m}") for m, c in MEASURES.items()])
    looking = (
        windows.select(*windows.columns, F.inline(F.array(bins)))
        .select(*windows.columns, F.inline(_places(measured, levels)))
        .filter(" AND ".join(f"{c} IS NOT NULL" for c in CELLS))
    )
    keys = [*LEVELS, *CELLS]
    many = sum(row["crowded"] for row in measured)
    if many:
        parts = cells.filter(F.col("_n") > crowded).select(
            *keys, F.ceil(F.col("_n") / crowded).cast("int").alias("_parts")
        )
        parts = F.broadcast(parts) if many <= BROADCAST_CELLS else parts.hint("merge")
        number = F.coalesce("_parts", F.lit(1))
        filed = filed.join(parts, keys, "left").withColumn(
            "_part", F.pmod(F.xxhash64(*rules.columns), number).cast("int")
        ).drop("_parts")
        looking = looking.join(parts, keys, "left").withColumn(
            "_part", F.explode(F.sequence(F.lit(0), number - 1))
        ).drop("_parts")
        keys = [*keys, "_part"]
    size = longest * sum(row["n"] for row in measured)
    hinted = F.broadcast(filed) if size <= broadcast_bytes else filed.hint("merge")
    return looking.join(hinted, keys, "inner").filter(_contains()).drop(*keys)


def _contains() -> Column:
    return in_range(
        F.col("t_avg"), F.col("temperature_min"), F.col("temperature_max")
    ) & in_range(F.col("h_avg"), F.col("humidity_min"), F.col("humidity_max"))


def _edges(rules: DataFrame, levels: int) -> tuple[dict[str, list[float]], int]:
    """Per measure the at most 2**levels - 1 inner edges of its bins, rising; and the bytes
    of the longest rule, rounded up."""
    shares = _numbers([i / 2**levels for i in range(1, 2**levels)])
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rules.columns]
    sides = [
        F.struct(*[F.col(f"{m}_{side}").cast("double").alias(m) for m in MEASURES])
        for side in ("min", "max")
    ]
    found = (
        rules.select(sum(texts, F.lit(0)).alias("bytes"), F.inline(F.array(*sides)))
        .agg(
            F.max("bytes").alias("longest"),
            *[F.percentile_approx(m, shares, 100_000).alias(m) for m in MEASURES],
        )
        .first()
    )
    edges = {m: sorted(set(found[m] or []), key=lambda e: (isnan(e), e)) for m in MEASURES}
    return edges, (found["longest"] or 0) + 64


def _numbers(values: list[float]) -> Column:
    """An array of constants: one text, which the optimizer folds, is a smaller plan than a
    literal per number."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _bin(value: Column, edges: list[float]) -> Column:
    """How many edges are not above the value; null for null.

    The first edges of blocks of 16 tell the block, so a value meets 32 edges at most.
    """
    block = 16

    def not_above(array: Column) -> Column:
        return F.size(F.filter(array, lambda e: e <= value))

    if not edges:
        return F.when(value.isNotNull(), F.lit(0))
    blocks = not_above(_numbers(edges[::block]))
    before = F.greatest(blocks - 1, F.lit(0)) * block
    rest = F.slice(_numbers(edges), before + 1, F.lit(block))
    return F.when(value.isNotNull(), before + not_above(rest))


def _filed(rules: DataFrame, edges: dict[str, list[float]], levels: int) -> DataFrame:
    """Rules with their levels and cells, a row for each rectangle that meets their ranges.

    A rule with crossed bounds never matches and is left out.
    """
    # Generators keep the bins and levels from being computed again at every use.
    ends = F.struct(
        *[
            F.coalesce(_bin(F.col(f"{m}_{side}"), edges[m]), F.lit(open_end)).alias(f"_{m}_{side}")
            for m in MEASURES
            for side, open_end in (("min", 0), ("max", len(edges[m])))
        ]
    )

    def level(m: str) -> Column:
        length = F.col(f"_{m}_max") - F.col(f"_{m}_min") + 1
        # The last level whose cells have half the length at most.
        halves = F.array(*[F.lit(2 * 2**k) for k in range(1, levels)])
        fits = F.size(F.filter(halves, lambda h: h <= length))
        unbounded = F.col(f"{m}_min").isNull() & F.col(f"{m}_max").isNull()
        return F.when(unbounded, F.lit(levels)).otherwise(fits).alias(f"_{m}_level")

    placed = (
        rules.select(*rules.columns, F.inline(F.array(ends)))
        .filter(" AND ".join(f"_{m}_min <= _{m}_max" for m in MEASURES))
        .select("*", F.inline(F.array(F.struct(*map(level, MEASURES)))))
    )
    for m in MEASURES:
        first, to = (
            F.call_function("shiftright", F.col(f"_{m}_{side}"), F.col(f"_{m}_level"))
            for side in ("min", "max")
        )
        placed = placed.withColumn(f"_{m}_cell", F.explode(F.sequence(first, to)))
    return placed.select(*rules.columns, *LEVELS, *CELLS)


def _places(measured: list[Row], levels: int) -> Column:
    """The rectangles a window looks in: one for each pair of levels that holds rules.

    A null value is in no cell but that of rules without bounds.
    """

    def cell(m: str, level: int) -> Column:
        return F.lit(0) if level == levels else F.shiftright(F.col(f"_{m}"), level)

    places = []
    for row in sorted(measured, key=lambda r: [r[c] for c in LEVELS]):
        pair = {m: row[f"_{m}_level"] for m in MEASURES}
        places.append(
            F.struct(
                *[F.lit(level).alias(f"_{m}_level") for m, level in pair.items()],
                *[cell(m, level).cast("int").alias(f"_{m}_cell") for m, level in pair.items()],
            )
        )
    return F.array(*places)


def shape_alerts(matches: DataFrame, now: Column | datetime | None = None) -> DataFrame:
    """Matches to alerts: window as text, averages, code, message and alert time.

    ``now`` replaces the current time, which on a stream is fixed per micro-batch.
    """
    if now is None:
        now = F.current_timestamp()
    elif isinstance(now, datetime):
        now = F.lit(now)
    return matches.select(
        F.struct(
            F.col("window_start").cast("string").alias("start"),
            F.col("window_end").cast("string").alias("end"),
        ).alias("window"),
        "t_avg",
        "h_avg",
        F.col("code").cast("string").alias("code"),
        "message",
        now.cast("string").alias("timestamp"),
    )
