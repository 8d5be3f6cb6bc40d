"""Exact top-k search by the three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dewpoint.llm.common import BROADCAST_ROWS, kept

PACKED = "block int, ids binary, given binary, parts binary, width int, n int"


def quantised(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component, x as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(embedding: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    infinite = float("inf")
    return F.coalesce(
        embedding.isNotNull()
        & F.forall(
            embedding,
            lambda x: x.isNotNull()
            & ~F.isnan(x.cast("double"))
            & (F.abs(x.cast("double")) < F.lit(infinite)),
        ),
        F.lit(False),
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    parts: int = 2,
    block_rows: int = 8_192,
    query_rows: int = 1_024,
) -> DataFrame:
    """The ``k`` highest integer inner products of each query: ``query_id, rank, vec_id, score``.

    Both inputs have ``vec_id`` and ``vector`` (array of long). Ties go to the smaller
    vec_id, null ids last; rows with the query's own vec_id are no candidates, and a
    repeated (vec_id, vector) is one candidate. Vectors of different lengths are compared
    over the components both have. Queries with a null id take no part. Fewer than ``k``
    candidates are all returned; an empty table gives no rows. Scores are exact; those
    beyond the range of a long stop the search.

    The dimensions are split into ``parts``, each of which scores on its own; a score is
    the sum of the local ones. Per block of queries and block of rows:

    1. every part lists its local k best, and these alone are completed: their exact scores
       over all blocks give each query a cutoff that at least k rows reach;
    2. the cutoff goes to all blocks, and each part collects every row with a local score
       of at least cutoff / parts, since a row below that in all parts cannot reach it;
    3. only the scores of the collected rows are completed, and the best k are kept.

    Blocks are matrices of bounded size, so a task holds one pair of them. Local scores
    are recomputed in the second phase rather than stored: they are as many as pairs.
    """
    rows = _packed(vectors.select("vec_id", "vector").distinct(), block_rows)
    asked = _packed(
        queries.select("vec_id", "vector").filter(F.col("vec_id").isNotNull()).distinct(),
        query_rows,
    )
    blocks = rows.count()
    if not blocks or not asked.count():
        return _ranked(_empty(vectors), k)
    pairs = (
        asked.withColumnsRenamed({c: f"q_{c}" for c in asked.columns})
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .join(rows, "block")
    )
    found = "query_id long, query_no int, q_block int, vec_id long, score decimal(38,0)"

    def first_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                yield _gather(row, k, parts, None)

    gathered = pairs.mapInPandas(first_lists, found)
    best = Window.partitionBy("query_id", "query_no", "q_block").orderBy(F.desc("score"))
    # The k-th best of the rows seen so far; with fewer rows there is nothing to cut.
    cutoffs = (
        gathered.distinct()
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") == k)
        .groupBy("q_block")
        .agg(F.collect_list(F.struct("query_no", "score")).alias("cutoffs"))
    )

    def sufficient(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                yield _gather(row, k, parts, () if row.cutoffs is None else row.cutoffs)

    resolved = (
        pairs.join(cutoffs, "q_block", "left").mapInPandas(sufficient, found).distinct()
    )
    return _ranked(resolved, k)


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_no", "q_block").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last()
    )
    return (
        scores.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
    )


def _empty(vectors: DataFrame) -> DataFrame:
    return vectors.limit(0).select(
        F.lit(0).cast("long").alias("query_id"),
        F.lit(0).alias("query_no"),
        F.lit(0).alias("q_block"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.lit(0).cast("decimal(38,0)").alias("score"),
    )


def _packed(vectors: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of at most about ``block_rows`` vectors as matrices, numbered from 0.

    Blocks go by a hash of the row, so their sizes differ little; rows of a block are
    ordered by (vec_id, vector), so a block is the same after a restart.
    """
    n = vectors.count()
    blocks = max(1, -(-n // block_rows))
    key = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        given = frame["vec_id"].notna().to_numpy()
        ids = frame["vec_id"].fillna(0).astype("int64").to_numpy()
        lengths = frame["vector"].map(len)
        width = int(lengths.max())
        matrix = np.zeros((len(frame), width), dtype=np.int64)
        for at, vector in enumerate(frame["vector"]):
            matrix[at, : len(vector)] = vector
        order = np.lexsort((*matrix.T[::-1], ids, ~given))
        return pd.DataFrame(
            {
                "block": [int(frame["block"].iloc[0])],
                "ids": [ids[order].tobytes()],
                "given": [given[order].tobytes()],
                "parts": [matrix[order].tobytes()],
                "width": [width],
                "n": [len(frame)],
            }
        )

    blocked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector", key.alias("block"))
    packed = kept(blocked.groupBy("block").applyInPandas(pack, PACKED))
    # Hash bins may be empty; numbers without gaps keep the pairing complete. Only the
    # numbers meet in one task, the matrices are joined to them.
    order = Window.orderBy("block")
    numbers = packed.select("block").withColumn("_number", F.row_number().over(order) - 1)
    numbered = packed.join(F.broadcast(numbers) if blocks <= BROADCAST_ROWS else numbers, "block")
    return kept(numbered.withColumn("block", F.col("_number")).drop("_number"))


def _matrix(data: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int64).reshape(n, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` with all rows of ``b``.

    Doubles are exact while no partial sum can pass 2**53; beyond, whole Python numbers
    are used, which is slow but right.
    """
    largest = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(
        np.abs(b.astype(np.float64)).max(initial=0)
    )
    if largest * max(1, a.shape[1]) < 2.0**53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a.astype(object) @ b.astype(object).T


def _completed(q: np.ndarray, x: np.ndarray, at: np.ndarray, hit: np.ndarray) -> list[int]:
    """Exact inner products of the rows ``at`` of ``q`` with the rows ``hit`` of ``x``."""
    largest = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(
        np.abs(x.astype(np.float64)).max(initial=0)
    )
    kind = np.int64 if largest * max(1, q.shape[1]) < 2.0**62 else object
    scores: list[int] = []
    for a in range(0, len(at), 65_536):
        one, other = q[at[a : a + 65_536]].astype(kind), x[hit[a : a + 65_536]].astype(kind)
        scores += (one * other).sum(axis=1).tolist()
    return scores


def _gather(row, k: int, parts: int, cutoffs) -> pd.DataFrame:
    """Candidates of one pair of blocks with their exact scores.

    Without ``cutoffs`` the k best of every part; with them every row that reaches its
    query's cutoff / parts in some part (all rows for a query without a cutoff). Scores
    over all parts are computed for these rows only.
    """
    q, x = _matrix(row.q_parts, row.q_n, row.q_width), _matrix(row.parts, row.n, row.width)
    width = min(q.shape[1], x.shape[1])
    q, x = q[:, :width], x[:, :width]
    q_ids = np.frombuffer(row.q_ids, dtype=np.int64)
    ids = np.frombuffer(row.ids, dtype=np.int64)
    given = np.frombuffer(row.given, dtype=bool)
    edges = [width * p // parts for p in range(parts + 1)]
    spans = [slice(a, b) for a, b in zip(edges, edges[1:])]
    own = (q_ids[:, None] == ids[None, :]) & given[None, :]
    chosen = np.zeros(own.shape, dtype=bool)
    if cutoffs is None and row.n <= k + 1:
        chosen[:] = True
    elif cutoffs is None:
        line = np.arange(row.q_n)[:, None]
        for span in spans:
            part = _products(q[:, span], x[:, span])
            if part.dtype == object:
                best = np.argsort(-part, axis=1, kind="stable")[:, : k + 1]
            else:
                best = np.argpartition(-part, k, axis=1)[:, : k + 1]
            chosen[line, best] = True
    else:
        # Scores are whole numbers, so comparing parts * local with the cutoff is exact.
        cut = np.full(row.q_n, None, dtype=object)
        for item in cutoffs:
            cut[item["query_no"]] = int(item["score"])
        open_ = np.array([c is None for c in cut])
        limit = np.array([0 if c is None else c for c in cut], dtype=object)
        for span in spans:
            part = _products(q[:, span], x[:, span])
            chosen |= part * parts >= limit.astype(part.dtype)[:, None]
        chosen[open_] = True
    chosen &= ~own
    at, hit = np.nonzero(chosen)
    scores = np.array(_completed(q, x, at, hit), dtype=object)
    if cutoffs is not None and len(at):
        reached = (scores >= limit[at]) | open_[at]
        at, hit, scores = at[reached], hit[reached], scores[reached]
    return pd.DataFrame(
        {
            "query_id": q_ids[at],
            "query_no": at.astype(np.int32),
            "q_block": np.full(len(at), row.q_block, dtype=np.int32),
            "vec_id": pd.Series(ids[hit], dtype="Int64").mask(~given[hit]),
            "score": pd.Series(scores, dtype=object).map(_decimal),
        }
    )


def _decimal(value: int):
    from decimal import Decimal

    return Decimal(value)
