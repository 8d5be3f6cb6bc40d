"""Shards by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import kept, numbered

# Fixed value of the published algorithm: the multiplier of its generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. Going from n to n + 1 shards, keys move only into n.

    Each key draws the numbers of shards at which it jumps to the newest one; its shard is
    the last jump below ``shards``. There are about ln(shards) rounds.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    while moving.size:
        shard[moving] = jump[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        draw = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[moving] = ((shard[moving] + 1) * (2.0**31 / draw)).astype(np.int64)
        moving = moving[jump[moving] < shards]
    return shard.astype(np.int32)


def shard_of(shards: int, grown: int):
    """Spark function from a long key to its shard among ``shards`` and among ``grown``."""

    @F.pandas_udf("shard int, grown_shard int")
    def assign(keys: pd.Series) -> pd.DataFrame:
        values = keys.to_numpy(dtype=np.int64).view(np.uint64)
        return pd.DataFrame(
            {"shard": jump_hash(values, shards), "grown_shard": jump_hash(values, grown)}
        )

    return assign


def shard_documents(
    docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", shards: int = 16
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``key``: the shard depends on the id (hashed to 64 bits) and the number of
    shards alone, and one more shard takes rows only into itself (``grown_shard``). Rows of
    one id share a shard, so an id that repeats makes its shard larger; a null id is a key
    like any other. ``slot`` numbers the rows of a shard from 0 without gaps, in an order
    that depends on the rows alone; equal rows are numbered in some order. ``size`` is the
    UTF-8 length plus 1 (null text: 1), the checksum of a null text that of an empty one.
    An empty table gives no rows; further columns of ``docs`` are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id_column).cast("string")).alias("key"),
    )
    placed = kept(
        slim.withColumn("at", shard_of(shards, shards + 1)("key")).select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            F.col("at.shard").alias("shard"),
            F.col("at.grown_shard").alias("grown_shard"),
        )
    )
    return numbered(placed, "shard", ["doc_id", "text_crc32", "size"])
