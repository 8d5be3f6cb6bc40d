"""Packing documents into batches by optimal length buckets."""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import kept, numbered, words_in


def optimal_boundaries(
    longest: np.ndarray, rows: np.ndarray, total: np.ndarray, buckets: int
) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    Cells, one per length, are in rising order, each with its (longest) length, its rows and
    their summed length. A bucket of cells i+1..j pads its rows to ``longest[j]``. Dynamic programming
    over the last cell; for a fixed number of buckets the choices of i are lines in
    ``longest[j]`` whose slopes fall with i, so a queue of the lower envelope gives each
    best i in constant time.
    """
    ends = [int(x) for x in longest]
    n = np.concatenate([[0], np.cumsum(rows, dtype=object)])
    s = np.concatenate([[0], np.cumsum(total, dtype=object)])
    cells = len(ends)
    best: list[int | None] = [0] + [None] * cells
    choices = []
    for _ in range(min(buckets, cells)):
        lines: deque = deque()  # (slope, intercept, i)
        now: list[int | None] = [None] * (cells + 1)
        choice = np.zeros(cells + 1, dtype=np.int32)
        for j in range(1, cells + 1):
            if best[j - 1] is not None:
                line = (-n[j - 1], best[j - 1] + s[j - 1], j - 1)
                while len(lines) >= 2 and _hidden(lines[-2], lines[-1], line):
                    lines.pop()
                lines.append(line)
            x = ends[j - 1]
            while len(lines) >= 2 and _at(lines[1], x) <= _at(lines[0], x):
                lines.popleft()
            if lines:
                now[j] = _at(lines[0], x) + x * n[j] - s[j]
                choice[j] = lines[0][2]
        choices.append((now[cells], choice))
        best = now
    # Fewer buckets may do as well where cells are few.
    used = min(range(len(choices)), key=lambda k: (choices[k][0], k))
    bounds, j = [], cells
    for k in range(used, -1, -1):
        bounds.append(ends[j - 1])
        j = int(choices[k][1][j])
    return bounds[::-1]


def _at(line: tuple, x: int) -> int:
    return line[0] * x + line[1]


def _hidden(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether the middle of three lines of falling slope is nowhere the lowest."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    buckets: int = 16,
    token_budget: int = 65_536,
) -> DataFrame:
    """Every document with its batch.

    Returns ``doc_id, length, bucket, bucket_length, batch, place, oversize``: documents
    (length in words, 0 for null or empty text) fall into ``buckets`` length buckets, the
    boundaries of which minimise the padding over all documents. A batch holds
    documents of one bucket padded to ``bucket_length``, as many as fit into
    ``token_budget`` padded words, numbered by ``place`` from 0; batches are numbered from
    0 within their bucket. A document longer than the budget is a batch of its own, marked
    ``oversize``. Texts stay whole. Repeated rows are documents like others; no documents
    give no rows; other columns are not read.

    Only the histogram reaches the driver: a row for each length that occurs. Texts of d
    different lengths hold at least d * (d - 1) / 2 words, so there are at most about the
    square root of twice the words of all texts, 6 million for 100 TB and far fewer in
    practice; the programme is linear in them. Buckets of any size are cut into batches by
    ``numbered``, without sorting them whole.
    """
    rows = kept(
        docs.select(
            F.col(id_column).alias("doc_id"),
            words_in(F.col(text)).alias("length"),
            text_hash_of(docs, id_column, text).alias("_hash"),
        )
    )
    histogram = (
        rows.groupBy("length").agg(F.count(F.lit(1)).alias("rows")).toPandas().sort_values("length")
    )
    lengths, counts = histogram["length"].to_numpy(), histogram["rows"].to_numpy()
    bounds = optimal_boundaries(lengths, counts, lengths * counts, buckets) if len(lengths) else [0]
    length_of = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = sum((F.when(F.col("length") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    bucketed = rows.withColumn("bucket", bucket.cast("int")).withColumn(
        "bucket_length", F.element_at(length_of, F.col("bucket") + 1)
    )
    per_batch = F.greatest(
        F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_length"), F.lit(1))), F.lit(1)
    ).cast("long")
    return (
        numbered(bucketed, "bucket", ["_hash", "doc_id", "length"])
        .withColumn("_rows", per_batch)
        .select(
            "doc_id",
            "length",
            "bucket",
            "bucket_length",
            F.floor(F.col("slot") / F.col("_rows")).cast("long").alias("batch"),
            F.pmod("slot", "_rows").cast("int").alias("place"),
            (F.col("length") > token_budget).alias("oversize"),
        )
    )


def text_hash_of(docs: DataFrame, id_column: str, text: str) -> Column:
    """Orders documents so that batches mix them; null ids differ by their texts."""
    return F.xxhash64(F.col(id_column).cast("string"), F.col(text))
