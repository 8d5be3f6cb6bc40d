"""Word shingles of documents and their TF-IDF weights."""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

PRIME = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 4_096  # counters per row of the gathered counts


class Shingler:
    """Hashes of runs of ``length`` words; a shorter text is one run of all its words.

    ``remembered`` bounds how many word hashes a task holds, not the words.
    """

    def __init__(self, length: int = 5, remembered: int = 400_000):
        self.length = length
        self.remembered = remembered
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        known, out = self.known, []
        for word in text.split():
            number = known.get(word)
            if number is None:
                if len(known) >= self.remembered:
                    known.clear()
                number = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
                if len(word) <= 64:
                    known[word] = number
            out.append(number)
        return np.array(out, dtype=np.uint64)

    def counted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes in rising order and how often each occurs."""
        words = self.words(text or "")
        if not len(words):
            return words, np.zeros(0, dtype=np.int64)
        runs = max(1, len(words) - self.length + 1)
        mixed = np.zeros(runs, dtype=np.uint64)
        for k in range(min(self.length, len(words))):
            mixed = (mixed ^ words[k : k + runs]) * PRIME
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed, return_counts=True)


def document_frequencies(texts: DataFrame, buckets: int, length: int) -> tuple[np.ndarray, int]:
    """In how many documents a shingle of each hash bucket occurs, and the documents.

    Counts all of ``texts`` (a column ``text``). A task emits its counters in rows of
    ``CHUNK``; a shuffle adds the rows of a chunk. Its size follows the tasks and buckets.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(length)
        counts, n = np.zeros(buckets, dtype=np.int64), 0
        for frame in batches:
            n += len(frame)
            for text in frame["text"]:
                hashes, _ = shingler.counted(text)
                counts[np.unique(bucket_of(hashes, buckets))] += 1
        rows = counts.reshape(-1, CHUNK)
        yield pd.DataFrame(
            {
                "chunk": np.arange(len(rows), dtype=np.int32),
                "counts": [row.tobytes() for row in rows],
                "n": [n] + [0] * (len(rows) - 1),
            }
        )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, dtype=np.int64) for b in frame["counts"]], axis=0)
        return pd.DataFrame(
            {
                "chunk": [frame["chunk"].iloc[0]],
                "counts": [total.tobytes()],
                "n": [int(frame["n"].sum())],
            }
        )

    schema = "chunk int, counts binary, n long"
    gathered = (
        texts.select("text")
        .mapInPandas(count, schema)
        .groupBy("chunk")
        .applyInPandas(merge, schema)
        .toPandas()
        .sort_values("chunk")
    )
    if not len(gathered):
        return np.zeros(buckets, dtype=np.int64), 0
    counts = np.concatenate([np.frombuffer(b, dtype=np.int64) for b in gathered["counts"]])
    return counts, int(gathered["n"].sum())


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


class Weights:
    """TF-IDF weights: occurrences times 1 - share + share * idf / largest idf.

    ``share`` damps the idf: at full strength the few changed shingles of a document would
    outweigh the many that a large family of copies has in common.
    """

    def __init__(self, frequencies: np.ndarray, documents: int, share: float):
        largest = log(1 + max(documents, 1))
        idf = np.log((1 + max(documents, 1)) / (1 + frequencies)) / largest
        self.factor = (1 - share + share * np.maximum(idf, 0)).astype(np.float32)

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts * self.factor[bucket_of(hashes, len(self.factor))].astype(np.float64)


def weighted_jaccard(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> float:
    """Sum of least over sum of greatest weights of two (hashes, weights)."""
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][at], b[1][bt]).sum())
    greatest = float(a[1].sum() + b[1].sum()) - least
    return least / greatest if greatest else 0.0
