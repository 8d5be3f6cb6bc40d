"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dewpoint.llm.common import beside, kept, text_hash, words_in

HASH_BITS = 60
LEVEL_BITS = 12


def mix_sources(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
) -> DataFrame:
    """Every document with the words a weighted mix of the sources takes of it.

    Returns ``doc_id, source, size, source_size, target, copies, taken``. Sources in order
    of code points, null last, get ``weights`` in turn and share ``share`` (a fraction) of
    all words by them. No target exceeds ``most`` times its source; what is over is shared
    again by weight until no target is above (see ``targets``).

    A target is met by whole copies of its source and one more copy of the documents whose
    hash is below a threshold. The threshold is found without sorting: words are summed by
    source and leading hash bits, and only the bucket in which the budget ends is split by
    the next bits. The document at the very boundary is taken if that comes nearer. The
    hash is of id and text, so reruns agree and a null or repeated id is no special case;
    rows equal in both are taken alike. Null texts have no words, and a source without
    words has target 0. No documents give no rows. Other columns are not read.
    """
    rows = _sized(docs, id_column, text, source)
    limits, n = _limits(rows, weights, share, most)
    copies = _copies(F.col("_hash"))
    return beside(rows, limits, ["source"], n).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def apply_mix(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
) -> DataFrame:
    """``docs`` as the mix of ``mix_sources`` takes them: each row as often as it is taken."""
    limits, n = _limits(_sized(docs, id_column, text, source), weights, share, most)
    keyed = docs.withColumn("_source_", F.col(source).cast("string"))
    placed = beside(
        keyed,
        limits.select(
            F.col("source").alias("_source_"),
            F.struct("copies", "rest", "threshold", "at_threshold").alias("_limit_"),
        ),
        ["_source_"],
        n,
    )
    copies = _copies(text_hash(F.col(id_column), F.col(text)), "_limit_.")
    return placed.withColumn("_copy_", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select(
        *[F.col(c) for c in docs.columns]
    )


def _sized(docs: DataFrame, id_column: str, text: str, source: str) -> DataFrame:
    return kept(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            words_in(F.col(text)).alias("size"),
            text_hash(F.col(id_column), F.col(text)).alias("_hash"),
        )
    )


def _limits(
    rows: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int
) -> tuple[DataFrame, int]:
    """Target, whole copies and threshold per source, and the number of sources."""
    plan = kept(targets(rows, weights=weights, share=share, most=most))
    n = plan.count()
    return kept(beside(plan, thresholds(rows, plan, n), ["source"], n)), n


def _copies(hash_: Column, prefix: str = "") -> Column:
    threshold, at = F.col(f"{prefix}threshold"), F.col(f"{prefix}at_threshold")
    # Without a rest nothing is taken once more, texts without words neither.
    once_more = (F.col(f"{prefix}rest") > 0) & ((hash_ < threshold) | ((hash_ == threshold) & at))
    return (F.col(f"{prefix}copies") + F.when(once_more, 1).otherwise(0)).cast("long")


def targets(
    rows: DataFrame, *, weights: tuple[int, ...], share: tuple[int, int], most: int
) -> DataFrame:
    """Per source ``source, source_size, target, copies, rest`` from ``source, size``.

    Sharing the excess again until no target is above its limit ends at targets
    ``min(limit, level * weight)`` that add up to the budget. A source reaches its limit
    if the budget suffices for all to get as much per weight as its limit gives, so one
    pass in order of limit per weight finds them; whole numbers keep the test exact. The
    table has one row per source, so its windows may run in one task.
    """
    up, down = share
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordinal = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(w).cast("long") for w in weights]),
        (F.pmod(ordinal, F.lit(len(weights))) + 1).cast("int"),
    )
    everything = Window.partitionBy()
    common = 1
    for w in weights:
        common *= w
    weighed = by_source.withColumn("weight", weight).select(
        "*",
        (F.col("source_size") * (F.lit(common) / F.col("weight")).cast("long")).alias("_rank"),
        (F.sum("source_size").over(everything) * up).alias("_budget"),  # times down
        F.sum("weight").over(everything).alias("_weights"),
    )
    so_far = Window.orderBy("_rank", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = weighed.select(
        "*",
        F.sum(F.col("source_size") * most).over(so_far).alias("_limits"),
        (F.col("_weights") - F.sum("weight").over(so_far)).alias("_open"),
    )
    reached = (F.col("_limits") * F.col("weight") + F.col("source_size") * most * F.col("_open")) * (
        F.lit(down)
    ) <= F.col("_budget") * F.col("weight")
    full = ranked.withColumn("_full", reached).select(
        "*",
        F.sum(F.when(F.col("_full"), F.col("source_size") * most).otherwise(0))
        .over(everything)
        .alias("_given"),
        F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight")))
        .over(everything)
        .alias("_sharing"),
    )
    level = F.try_divide(
        F.col("_budget").cast("double") / down - F.col("_given").cast("double"),
        F.col("_sharing").cast("double"),
    )
    target = F.when(F.col("_full"), (F.col("source_size") * most).cast("double")).otherwise(
        level * F.col("weight").cast("double")
    )
    copies = F.coalesce(
        F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)
    )
    return (
        full.withColumn("target", target)
        .withColumn("copies", copies.cast("long"))
        .select(
            "source",
            "source_size",
            "target",
            "copies",
            (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"),
        )
    )


def thresholds(rows: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    """Per source ``threshold, at_threshold``: hashes below it, or at it, add up to ``rest``.

    Each level sums the words of the current boundary bucket by the next hash bits and
    descends into the part in which the budget ends; the last level tells single hashes.
    """
    state = plan.select(
        "source",
        F.lit(0).cast("long").alias("prefix"),
        F.col("rest").alias("budget"),
        F.lit(0).cast("long").alias("at"),
    )
    for used in range(0, HASH_BITS, LEVEL_BITS):
        inside = beside(rows, state.drop("at"), ["source"], sources).filter(
            F.shiftright("_hash", HASH_BITS - used) == F.col("prefix")
        )
        # The budget rides along, so that each level reads the one before once.
        sums = inside.groupBy(
            "source", F.shiftright("_hash", HASH_BITS - used - LEVEL_BITS).alias("bucket")
        ).agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
        before = (
            Window.partitionBy("source")
            .orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        summed = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        ends = (
            summed.filter(F.col("before") <= F.col("budget"))
            .groupBy("source")
            .agg(
                F.max(F.struct("bucket", "before", "words")).alias("end"),
                F.first("budget").alias("budget"),
            )
        )
        state = ends.select(
            "source",
            F.col("end.bucket").alias("prefix"),
            (F.col("budget") - F.col("end.before")).alias("budget"),
            F.col("end.words").alias("at"),
        )
    return state.select(
        "source",
        F.col("prefix").alias("threshold"),
        (F.col("at") <= F.col("budget") * 2).alias("at_threshold"),
    )
