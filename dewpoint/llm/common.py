"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and
# carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Tables of up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """The frame as a reliable checkpoint: computed once, readable after an executor is lost.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only a local session
    without it gets a temporary folder; a cluster session without it is refused.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local") or context.master.startswith("local-"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            root = tempfile.mkdtemp(prefix="dewpoint-")
        context.setCheckpointDir(root)
    return df.checkpoint()


def text_hash(*columns: Column) -> Column:
    """60 bits of the MD5 of the columns' texts, as a long that other engines can repeat.

    Nulls are told from empty texts by the mark before each column.
    """
    parts = [
        F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in columns
    ]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def words_in(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def beside(df: DataFrame, small: DataFrame, on: list[str], rows: int) -> DataFrame:
    """``df`` with the columns of a table of ``rows`` rows, broadcast if they are few.

    Null keys meet null keys. ``rows`` has been counted by the caller.
    """
    renamed = small.withColumnsRenamed({c: f"_on_{c}" for c in on})
    if rows <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    match = [df[c].eqNullSafe(renamed[f"_on_{c}"]) for c in on]
    condition = match[0]
    for other in match[1:]:
        condition = condition & other
    return df.join(renamed, condition).drop(*[f"_on_{c}" for c in on])


def numbered(
    df: DataFrame,
    group: str,
    order: list[str],
    *,
    name: str = "slot",
    rows_per_bin: int = 20_000,
) -> DataFrame:
    """``df`` with a gapless number from 0 within each ``group``, by no global sort.

    Rows are spread over hash bins of about ``rows_per_bin`` rows; each bin is numbered
    alone and starts where the bins before it end. The bins of a group form a table of
    rows / rows_per_bin rows, so a group holding a third of all rows is no hot spot.
    Order within a bin is by ``order``; the bin depends on the same columns, so the
    numbers depend on nothing but the rows. Rows equal in all of ``order`` are numbered
    in some order. ``df`` must be cheap to read twice (see ``kept``).
    """
    total = df.count()
    bins = max(1, -(-total // rows_per_bin))
    binned = df.withColumn("_bin", F.pmod(F.xxhash64(*order), F.lit(bins)).cast("int"))
    before = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        binned.groupBy(group, "_bin")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col(group).alias("_group"),
            F.col("_bin").alias("_bin_of"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        )
    )
    own = Window.partitionBy(group, "_bin").orderBy(*order)
    rows = binned.withColumn("_place", F.row_number().over(own))
    return (
        rows.join(
            starts,
            rows[group].eqNullSafe(starts["_group"]) & (rows["_bin"] == starts["_bin_of"]),
        )
        .withColumn(name, (F.col("_start") + F.col("_place") - 1).cast("long"))
        .drop("_bin", "_place", "_group", "_bin_of", "_start")
    )
