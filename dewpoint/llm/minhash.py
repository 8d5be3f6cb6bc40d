"""Near-duplicates by improved consistent weighted sampling of TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dewpoint.llm.common import BROADCAST_ROWS, kept
from dewpoint.llm.graph import components
from dewpoint.llm.shingles import (
    PRIME,
    Shingler,
    Weights,
    document_frequencies,
    weighted_jaccard,
)


class Sampler:
    """Consistent weighted samples: two sets share one with their weighted Jaccard similarity.

    Per sample every element draws r and c from Gamma(2, 1) and beta from [0, 1), all fixed
    by its hash; with t = floor(log(weight) / r + beta), the element with the least
    c / exp(r (t - beta) + r) is drawn, and (element, t) is the sample. The draws come from
    a table of ``rows`` rows, chosen by the hash.
    """

    def __init__(self, samples: int, seed: int, rows: int = 16_384):
        random = np.random.default_rng(seed)
        r = random.gamma(2.0, 1.0, (rows, samples))
        beta = random.random((rows, samples))
        log_c = np.log(random.gamma(2.0, 1.0, (rows, samples)))
        self.rows = rows
        self.per_r = (1 / r).astype(np.float32)
        self.beta = beta.astype(np.float32)
        self.r = r.astype(np.float32)
        self.rest = (log_c + r * beta - r).astype(np.float32)

    def draw(self, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The elements and levels t drawn, for each sample."""
        row = ((hashes >> np.uint64(20)) % np.uint64(self.rows)).astype(np.int64)
        t = np.floor(
            np.log(weights).astype(np.float32)[:, None] * self.per_r[row] + self.beta[row]
        )
        best = np.argmin(self.rest[row] - self.r[row] * t, axis=0)
        return hashes[best], t[best, np.arange(t.shape[1])].astype(np.int64)


def band_hashes(elements: np.ndarray, levels: np.ndarray, bands: int) -> np.ndarray:
    """One hash per band of consecutive samples."""
    mixed = (elements ^ (levels.astype(np.uint64) * PRIME)).reshape(bands, -1)
    out = np.arange(1, bands + 1, dtype=np.uint64) * PRIME
    for column in mixed.T:
        out = (out ^ column) * PRIME
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def text_key(text: str = "text"):
    """Equal texts have equal keys; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    words: int = 5,
    bands: int = 12,
    samples_per_band: int = 5,
    idf_buckets: int = 2**18,
    idf_share: float = 0.2,
    seed: int = 20,
) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept, text_key``.

    Documents are near-duplicates if the weighted Jaccard similarity of their TF-IDF
    weighted word shingles is ``threshold`` or more, or their texts are equal; classes
    are the connected components. ``class_id`` is the least id of the class (null only if
    all its ids are), ``kept`` marks the documents with that id and text, so one
    document of each class unless rows repeat. Null texts count as empty ones; texts
    without words have no shingles and equal each other only as texts. An empty table gives
    no rows; other columns are not read.

    Work is on distinct texts. Candidates share a band of samples. Within a bucket all
    texts are first compared with one leader, so that a large family is joined by one
    comparison a text and bucket. What is still in different components is then compared
    pair by pair in blocks (see ``_across``), so no link between candidates is lost.
    """
    content = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        text_key(text).alias("key"),
    )
    frequencies, n = document_frequencies(content, idf_buckets, words)
    weights = Weights(frequencies, n, idf_share)
    buckets = _buckets(content, weights, words, bands, samples_per_band, seed)
    links = _links(content, buckets, weights, words, threshold)
    slim = kept(content.select("doc_id", "key"))
    found = components(links, "key", "leader")
    firsts = (
        slim.groupBy("key")
        .agg(F.min("doc_id").alias("first"))
        .join(found.withColumnRenamed("vertex", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    classes = kept(
        firsts.groupBy("component").agg(
            F.min(F.struct(F.col("first").isNull().alias("none"), "first", "key")).alias("head")
        )
    )
    by_key = firsts.join(classes, "component").select(
        "key", F.col("head.first").alias("class_id"), F.col("head.key").alias("head_key")
    )
    return slim.join(by_key, "key").select(
        "doc_id",
        "class_id",
        (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("head_key"))).alias(
            "kept"
        ),
        F.col("key").alias("text_key"),
    )


def _buckets(
    content: DataFrame,
    weights: Weights,
    words: int,
    bands: int,
    samples_per_band: int,
    seed: int,
) -> DataFrame:
    """``bucket, key`` of the buckets that hold at least two distinct texts."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, sampler = Shingler(words), Sampler(bands * samples_per_band, seed)
        for frame in batches:
            keys, hashes = [], []
            for key, text in zip(frame["key"], frame["text"], strict=True):
                elements, counts = shingler.counted(text)
                if len(elements):
                    drawn = sampler.draw(elements, weights.of(elements, counts))
                    keys.append(key)
                    hashes.append(band_hashes(*drawn, bands))
            if keys:
                yield pd.DataFrame({"key": keys, "buckets": hashes})

    rows = kept(
        content.select("key", "text")
        .mapInPandas(sketch, "key binary, buckets array<long>")
        .select(F.explode("buckets").alias("bucket"), "key")
        .distinct()
    )
    shared = (
        rows.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("texts"))
        .filter("texts > 1")
        .select("bucket")
    )
    return kept(rows.join(shared, "bucket"))


def _links(
    content: DataFrame, members: DataFrame, weights: Weights, words: int, threshold: float
) -> DataFrame:
    """Verified links ``key, leader`` that join all texts the candidates can join."""
    wanted = members.select("key").distinct()
    if wanted.count() <= 10 * BROADCAST_ROWS:  # 16 bytes each
        wanted = F.broadcast(wanted)
    texts = kept(
        content.select("key", "text").join(wanted, "key", "left_semi").dropDuplicates(["key"])
    )
    # First everyone against one leader: this joins large families at one row a text.
    led = members.join(members.groupBy("bucket").agg(F.min("key").alias("leader")), "bucket")
    pairs = led.select("key", "leader").filter("key <> leader").distinct()
    judged = kept(_similarities(pairs, texts, weights, words))
    links = judged.filter(F.col("similarity") >= threshold).select("key", "leader")
    found = components(links, "key", "leader").withColumnRenamed("vertex", "key")
    labelled = kept(
        led.join(judged, ["key", "leader"], "left")
        .join(found, "key", "left")
        .select(
            "bucket",
            "key",
            F.coalesce("component", "key").alias("component"),
            F.coalesce("similarity", F.lit(1.0)).alias("near"),
        )
    )
    # Then the members of different components, where a bucket has several.
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("bucket")
    )
    late = _across(labelled.join(mixed, "bucket"), texts, weights, words, threshold)
    return links.union(kept(late))


def _across(
    members: DataFrame,
    texts: DataFrame,
    weights: Weights,
    words: int,
    threshold: float,
    block: int = 128,
) -> DataFrame:
    """Links ``key, leader`` that join members of one bucket in different components.

    A bucket's members, ordered by component, form blocks of ``block`` texts; pairs of
    blocks go to tasks unless both are of one component, and a task emits only links.
    Pairs joined meanwhile are skipped, and so are those that their similarities to the
    bucket's leader tell apart: 1 - similarity is a metric.
    """
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("component", "key"))
    placed = members.withColumn("block", F.floor((place - 1) / block).cast("int"))
    blocks = kept(
        placed.join(texts, "key")
        .groupBy("bucket", "block")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sort_array(F.collect_list(F.struct("key", "component", "near", "text"))).alias("m"),
        )
    )
    others = blocks.withColumnsRenamed({c: f"o_{c}" for c in ("block", "low", "high", "m")})
    one = "low = high AND o_low = o_high AND low = o_low"
    reach = 1 - threshold

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        shingler, row, out = Shingler(words), frame.iloc[0], []
        same = row["block"] == row["o_block"]
        parent: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        def sets(items) -> list:
            return [
                (i["key"], i["component"], i["near"], (h, weights.of(h, c)))
                for i in items
                for h, c in [shingler.counted(i["text"])]
            ]

        left = sets(row["m"])
        right = left if same else sets(row["o_m"])
        for i, (key, component, near, own) in enumerate(left):
            for other, other_component, other_near, theirs in right[i + 1 if same else 0 :]:
                a, b = top(component), top(other_component)
                if a == b or abs(near - other_near) > reach + 1e-9:
                    continue
                if weighted_jaccard(own, theirs) >= threshold:
                    parent[max(a, b)] = min(a, b)
                    out.append((key, other))
        return pd.DataFrame(out, columns=["key", "leader"])

    return (
        blocks.join(others, "bucket")
        .filter(f"block <= o_block AND NOT ({one})")
        .groupBy("bucket", "block", "o_block")
        .applyInPandas(compare, "key binary, leader binary")
        .distinct()
    )


def _similarities(
    pairs: DataFrame, texts: DataFrame, weights: Weights, words: int
) -> DataFrame:
    """Weighted Jaccard similarities ``key, leader, similarity``.

    A leader of many pairs is a skewed join key, which adaptive execution splits.
    """

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        last, of_last = None, None
        for frame in batches:
            out = []
            for own, leader, leader_text in zip(
                frame["text"], frame["leader"], frame["leader_text"], strict=True
            ):
                if leader != last:
                    hashes, counts = shingler.counted(leader_text)
                    last, of_last = leader, (hashes, weights.of(hashes, counts))
                hashes, counts = shingler.counted(own)
                out.append(weighted_jaccard((hashes, weights.of(hashes, counts)), of_last))
            yield pd.DataFrame({"key": frame["key"], "leader": frame["leader"], "similarity": out})

    led = texts.withColumnsRenamed({"key": "leader", "text": "leader_text"})
    return (
        pairs.join(texts, "key")
        .join(led, "leader")
        .select("key", "text", "leader", "leader_text")
        .mapInPandas(verify, "key binary, leader binary, similarity double")
    )


def deduplicate(docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``, all columns kept.

    The row of the least id stays; of rows equal in id and text any one. The rows to drop
    are fewer than those to keep, so it is they that meet the documents: broadcast if
    counted to be few, else by a shuffle.
    """
    classes = kept(near_duplicates(docs, id_column=id_column, text=text, **options))
    named = ["_id", "_key"]
    per_row = classes.groupBy(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
    ).agg(F.count(F.lit(1)).alias("n"), F.min("kept").alias("kept"))
    odd = kept(per_row.filter("NOT kept OR n > 1"))
    small = odd.count() <= BROADCAST_ROWS

    def side(rows: DataFrame) -> DataFrame:
        rows = rows.select(*named)
        return F.broadcast(rows) if small else rows

    keyed = docs.withColumn("_key_", text_key(text))

    def join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(
            right,
            left[id_column].eqNullSafe(right["_id"]) & (left["_key_"] == right["_key"]),
            how,
        )

    single = join(keyed, side(odd), "left_anti")
    repeated = join(keyed, side(odd.filter("kept")), "left_semi").dropDuplicates(
        [id_column, "_key_"]
    )
    return single.unionByName(repeated).drop("_key_")
