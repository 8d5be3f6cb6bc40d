"""Near-duplicate embeddings through graphs per shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import kept
from dewpoint.llm.graph import components
from dewpoint.llm.hnsw import Shard
from dewpoint.llm.topk import usable

LEAF = 1 / 16  # share of vectors that a layer hands to the one above
FOUND = "kind int, a binary, b binary, n long"
ALL, ONE, LINK = 0, 1, 2  # links of every vector of a ball, of one vector; linked balls


def near_embeddings(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    shard_rows: int = 65_536,
    least_shards: int = 8,
    beam: int = 32,
    audit: int = 64,
    recall: float = 0.98,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link if their cosine, in double precision, is ``threshold`` or more. ``n_links``
    counts the other vectors linked directly, ``component_id`` is the least id reachable
    by links, ``kept`` marks the vectors whose id that is. Vectors that are null, zero,
    empty or hold null or non-finite components link with nothing. Equal vectors link and
    are handled as one; so do repeated rows. A vector with a null id links like any other,
    its own id is never the least. Shorter vectors count as padded with zeros. An empty
    table gives no rows; other columns are not read.

    Vectors go to shards by hash, about ``shard_rows`` each and ``least_shards`` at least.
    A shard groups its vectors into balls narrow enough that all of a ball link, and builds
    a graph over their pivots (see ``Shard``). Every shard's pivots then query every
    shard's graph, each pair of shards once, with a beam widened until an audit against all
    pivots passes. An audit draws queries until ``audit`` of them have a partner other than
    themselves; where links are too sparse for that, it has compared all. Two balls so near that all their vectors must link are counted as a
    whole; others are verified vector by vector. Components are those of the balls.
    """
    reach = float(np.arccos(threshold))
    rows = vectors.select(
        F.col(id_column).alias("vec_id"),
        F.when(usable(F.col(vector)), F.transform(vector, lambda x: x.cast("double"))).alias("v"),
    )
    valid = F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = kept(
        rows.withColumn("v", F.when(valid, F.col("v"))).withColumn(
            "key", F.unhex(F.md5(F.col("v").cast("string")))
        )
    )
    points = rows.filter("key IS NOT NULL").groupBy("key", "v").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least_id")
    )
    shards = max(least_shards, -(-rows.count() // shard_rows))
    built = _built(points, shards, reach / 2 - 1e-6)
    found = kept(_compared(built, reach, threshold, beam, audit, recall))
    members = _members(built)
    balls = components(
        found.filter(F.col("kind") == LINK).select("a", "b")
    ).withColumnsRenamed({"vertex": "ball", "component": "group"})

    def counted(kind: int, key: str, name: str) -> DataFrame:
        return (
            found.filter(F.col("kind") == kind)
            .groupBy(F.col("a").alias(key))
            .agg(F.sum("n").alias(name))
        )

    at = kept(
        members.join(counted(ALL, "ball", "whole"), "ball", "left")
        .join(counted(ONE, "key", "single"), "key", "left")
        .join(balls, "ball", "left")
        .join(points.select("key", "least_id"), "key")
        .select(
            "key",
            F.coalesce("group", "ball").alias("group"),
            "least_id",
            (F.col("inside") + F.coalesce("whole", F.lit(0)) + F.coalesce("single", F.lit(0)))
            .alias("n_links"),
        )
    )
    least = at.groupBy("group").agg(F.min("least_id").alias("component_id"))
    per_point = at.join(least, "group").select("key", "n_links", "component_id")
    linked = rows.select("vec_id", "key").join(per_point, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _unit(vectors: list) -> np.ndarray:
    """Rows of length 1; scaled by their largest part first, so that none overflows."""
    width = max(len(v) for v in vectors)
    out = np.zeros((len(vectors), width))
    for at, v in enumerate(vectors):
        out[at, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _built(points: DataFrame, shards: int, radius: float) -> DataFrame:
    """``shard, data``: one row per shard with its balls and graph."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        keys = np.frombuffer(b"".join(frame["key"]), dtype=np.uint8).reshape(-1, 16)
        # Levels come from the key, so that a rebuilt shard is the same.
        draw = (keys[:, 8:].copy().view(np.uint64)[:, 0] >> np.uint64(11)) * 2.0**-53
        levels = np.floor(np.log(np.maximum(draw, 1e-18)) / np.log(LEAF)).astype(np.int64)
        built = Shard.build(
            keys,
            _unit(frame["v"].to_list()),
            frame["weight"].to_numpy(dtype=np.int64),
            np.minimum(levels, 4),
            radius,
        )
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "data": [built.to_bytes()]})

    sharded = points.select("key", "v", "weight", _shard_of(F.col("key"), shards).alias("shard"))
    return kept(sharded.groupBy("shard").applyInPandas(build, "shard int, data binary"))


def _compared(
    built: DataFrame, reach: float, threshold: float, beam: int, audit: int, recall: float
) -> DataFrame:
    """What every pair of shards, and each shard with itself, links."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        row = frame.iloc[0]
        same = row["shard"] == row["other"]
        a = Shard.from_bytes(row["data"])
        b = a if same else Shard.from_bytes(row["other_data"])
        return _linked(a, b, same, reach, threshold, beam, audit, recall)

    others = built.withColumnsRenamed({"shard": "other", "data": "other_data"})
    numbers = built.select("shard")
    # One row per shard: the pairs are as many as the method has, not as the vectors.
    last = numbers.agg(F.max("shard")).first()[0]
    pairs = numbers.withColumn(
        "other", F.explode(F.sequence(F.col("shard"), F.lit(-1 if last is None else last)))
    )
    return (
        pairs.join(built, "shard")
        .join(others, "other")
        .groupBy("shard", "other")
        .applyInPandas(compare, FOUND)
    )


def _linked(
    a: Shard,
    b: Shard,
    same: bool,
    reach: float,
    threshold: float,
    beam: int,
    audit: int,
    recall: float,
) -> pd.DataFrame:
    width = max(a.vectors.shape[1], b.vectors.shape[1])
    for shard in (a, b):
        missing = width - shard.vectors.shape[1]
        if missing:
            shard.vectors = np.pad(shard.vectors, ((0, 0), (0, missing)))
            shard.graph.vectors = shard.pivots().astype(np.float32)
    pivots = a.pivots()
    query, ball = b.within(pivots, reach, a.reach, same, beam, audit, recall)
    cosine = np.einsum("ij,ij->i", pivots[query], b.pivots()[ball])
    angle = np.arccos(np.clip(cosine, -1, 1))
    spread = a.reach[query] + b.reach[ball]
    near = angle <= reach + spread + 1e-6
    query, ball, angle, spread = query[near], ball[near], angle[near], spread[near]
    whole = angle + spread <= reach - 1e-6
    a_size, b_size = (np.add.reduceat(s.weights, s.start[:-1]) for s in (a, b))
    a_all, b_all = np.zeros(len(a_size), np.int64), np.zeros(len(b_size), np.int64)
    np.add.at(a_all, query[whole], b_size[ball[whole]])
    np.add.at(b_all, ball[whole], a_size[query[whole]])
    a_one, b_one = np.zeros(len(a.keys), np.int64), np.zeros(len(b.keys), np.int64)
    links = [(query[whole], ball[whole])]
    for q, p in zip(query[~whole], ball[~whole], strict=True):
        x, y = slice(a.start[q], a.start[q + 1]), slice(b.start[p], b.start[p + 1])
        if _verify(a, b, x, y, threshold, a_one, b_one):
            links.append((np.array([q]), np.array([p])))
    out = []
    for shard, all_, one in ((a, a_all, a_one), (b, b_all, b_one)):
        pivot_keys = shard.keys[shard.start[:-1]]
        out.append(_counts(ALL, pivot_keys[all_ > 0], all_[all_ > 0]))
        out.append(_counts(ONE, shard.keys[one > 0], one[one > 0]))
    q, p = (np.concatenate(part) for part in zip(*links, strict=True))
    edges = _counts(LINK, a.keys[a.start[q]], np.zeros(len(q), np.int64))
    edges["b"] = [k.tobytes() for k in b.keys[b.start[p]]]
    return pd.concat([*out, edges], ignore_index=True)


def _verify(a, b, x: slice, y: slice, threshold: float, a_one, b_one, block: int = 2_048) -> bool:
    """Counts the links between two balls exactly, in blocks; whether there is any."""
    any_ = False
    for begin in range(x.start, x.stop, block):
        rows = slice(begin, min(begin + block, x.stop))
        for start in range(y.start, y.stop, block):
            columns = slice(start, min(start + block, y.stop))
            linked = a.vectors[rows] @ b.vectors[columns].T >= threshold
            a_one[rows] += linked @ b.weights[columns]
            b_one[columns] += linked.T @ a.weights[rows]
            any_ = any_ or bool(linked.any())
    return any_


def _counts(kind: int, keys: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "kind": np.full(len(keys), kind, dtype=np.int32),
            "a": [k.tobytes() for k in keys],
            "b": [None] * len(keys),
            "n": n,
        }
    )


def _members(built: DataFrame) -> DataFrame:
    """``key, ball, inside``: each vector's ball and its links within it."""

    def unfold(frame: pd.DataFrame) -> pd.DataFrame:
        shard = Shard.from_bytes(frame["data"].iloc[0])
        sizes = np.add.reduceat(shard.weights, shard.start[:-1])
        owner = np.repeat(np.arange(len(sizes)), np.diff(shard.start))
        pivots = shard.keys[shard.start[:-1]]
        return pd.DataFrame(
            {
                "key": [k.tobytes() for k in shard.keys],
                "ball": [pivots[o].tobytes() for o in owner],
                "inside": sizes[owner] - 1,
            }
        )

    return built.groupBy("shard").applyInPandas(unfold, "key binary, ball binary, inside long")
