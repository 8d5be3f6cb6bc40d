"""Quality scores from random-indexing word vectors and a small calibrated network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tokens are runs of letters and digits and runs of one sign.
TOKEN = re.compile(r"[^\W_]+|([^\w\s]|_)\1*")
CHUNK = 512  # word buckets per row of the gathered vectors


class Vocabulary:
    """Tokens to hash buckets, remembered within a task.

    Marks for form stand beside the word itself: a word in capitals, a repeated word, a run
    of signs with its length. ``remembered`` bounds the memory of a task, not the words.
    """

    def __init__(self, buckets: int, remembered: int = 200_000):
        self.buckets = buckets
        self.remembered = remembered
        self.known: dict[str, tuple[tuple[int, ...], int]] = {}
        self.again = self.bucket("<again>")

    def bucket(self, token: str) -> int:
        return zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.buckets

    def _parts(self, chunk: str) -> tuple[tuple[int, ...], int]:
        """Buckets of the tokens of a piece without spaces, and that of its last word."""
        # Most pieces are a word, or a word and a sign: no need for the pattern.
        core, sign = chunk, ()
        if chunk[-1] in ".,":
            core, sign = chunk[:-1], (self.bucket(chunk[-1]),)
        if core.isalpha() and (len(core) == 1 or not core.isupper()):
            word = self.bucket(core.lower())
            return (word, *sign), word
        out, word = [], -1
        for match in TOKEN.finditer(chunk):
            token = match.group()
            if match.group(1) is not None:
                out.append(self.bucket(token[:4]))
                continue
            word = self.bucket(token.lower())
            out.append(word)
            if len(token) > 1 and token.isupper():
                out.append(self.bucket("<capitals>"))
        return tuple(out), word

    def tokens(self, text: str) -> np.ndarray:
        """Buckets of the tokens of a whole text, in order."""
        out: list[int] = []
        known, last = self.known, -1
        for chunk in text.split():
            parts = known.get(chunk)
            if parts is None:
                parts = self._parts(chunk)
                if len(chunk) <= 64:
                    if len(known) >= self.remembered:
                        known.clear()
                    known[chunk] = parts
            out += parts[0]
            if parts[1] >= 0:
                if parts[1] == last:
                    out.append(self.again)
                last = parts[1]
        return np.array(out, dtype=np.int64)


def index_vectors(buckets: int, width: int, ones: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few non-zero components of each bucket's index vector."""
    random = np.random.default_rng(seed)
    places = random.integers(0, width, size=(buckets, ones))
    signs = random.choice([-1, 1], size=(buckets, ones))
    return places, signs


def context_sums(
    docs: DataFrame, text: str, *, buckets: int, width: int, ones: int, window: int, seed: int
) -> np.ndarray:
    """For each word bucket the sum of the index vectors of its neighbours in all documents.

    A task adds up its documents and emits the sums in rows of ``CHUNK`` buckets; the rows
    of a chunk are added by a shuffle. What is shuffled and gathered depends on the number
    of tasks and buckets, not on the words.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(buckets)
        places, signs = index_vectors(buckets, width, ones, seed)
        sums = np.zeros(buckets * width, dtype=np.int64)

        def add(gathered: list[np.ndarray]) -> None:
            tokens = np.concatenate(gathered)
            document = np.repeat(np.arange(len(gathered)), [len(t) for t in gathered])
            for step in range(1, window + 1):
                near = document[:-step] == document[step:]
                a, b = tokens[:-step][near], tokens[step:][near]
                for word, other in ((a, b), (b, a)):
                    at = word * width
                    for one in range(ones):
                        sums[:] += np.bincount(
                            at + places[other, one],
                            weights=signs[other, one],
                            minlength=len(sums),
                        ).astype(np.int64)

        gathered, held = [], 0
        for frame in batches:
            for content in frame["text"]:
                gathered.append(vocabulary.tokens(content or ""))
                held += len(gathered[-1])
                if held >= 1_000_000:
                    add(gathered)
                    gathered, held = [], 0
        if gathered:
            add(gathered)
        table = sums.reshape(-1, CHUNK * width)
        yield pd.DataFrame(
            {"chunk": np.arange(len(table), dtype=np.int32), "sums": [row.tobytes() for row in table]}
        )

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, dtype=np.int64) for b in frame["sums"]], axis=0)
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "sums": [total.tobytes()]})

    schema = "chunk int, sums binary"
    gathered = (
        docs.select(F.col(text).alias("text"))
        .mapInPandas(add_up, schema)
        .groupBy("chunk")
        .applyInPandas(merge, schema)
        .toPandas()
        .sort_values("chunk")
    )
    if not len(gathered):
        return np.zeros((buckets, width), dtype=np.int64)
    return np.concatenate(
        [np.frombuffer(b, dtype=np.int64).reshape(-1, width) for b in gathered["sums"]]
    )


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context sums damped (signed roots) and of length 1, so that no frequent word rules."""
    damped = np.sign(sums) * np.sqrt(np.abs(sums))
    norms = np.linalg.norm(damped, axis=1, keepdims=True)
    return (damped / np.maximum(norms, 1e-12)).astype(np.float32)


def pooled(tokens: np.ndarray, vectors: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """A document's features: mean and spread of its word vectors, shares of the marks."""
    width = vectors.shape[1]
    if not len(tokens):
        return np.zeros(2 * width + len(marks) + 2)
    counts = np.bincount(tokens, minlength=len(vectors))
    seen = np.flatnonzero(counts)
    shares = counts[seen] / len(tokens)
    mean = shares @ vectors[seen]
    spread = np.sqrt(np.maximum(shares @ np.square(vectors[seen]) - mean**2, 0))
    forms = counts[marks] / len(tokens)
    variety = [len(seen) / len(tokens), shares.max()]
    return np.concatenate([mean, spread, forms, variety])


# Tokens whose shares are features of their own.
MARKS = ("<capitals>", "<again>", "!!", "|", ".", ",")


class Network:
    """Two dense layers, trained by Adam on the driver, with a temperature for its logits."""

    def __init__(self, hidden: int = 32, seed: int = 7):
        self.hidden, self.seed = hidden, seed
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 256) -> Network:
        random = np.random.default_rng(self.seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        # Every fifth row calibrates; it is not trained on.
        held = np.arange(len(x)) % 5 == 4
        z = (x - self.mean) / self.scale
        train_x, train_y = z[~held], y[~held]
        self.w1 = random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], self.hidden))
        self.b1, self.b2 = np.zeros(self.hidden), np.zeros(1)
        self.w2 = random.normal(0, np.sqrt(2 / self.hidden), (self.hidden, 1))
        weights = [self.w1, self.b1, self.w2, self.b2]
        first = [np.zeros_like(w) for w in weights]
        second = [np.zeros_like(w) for w in weights]
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(train_x))
            for start in range(0, len(order), batch):
                rows = order[start : start + batch]
                a, b = train_x[rows], train_y[rows]
                hidden = np.maximum(a @ self.w1 + self.b1, 0)
                error = (_sigmoid((hidden @ self.w2 + self.b2)[:, 0]) - b)[:, None] / len(rows)
                back = (error @ self.w2.T) * (hidden > 0)
                slopes = [
                    a.T @ back + 1e-4 * self.w1,
                    back.sum(axis=0),
                    hidden.T @ error + 1e-4 * self.w2,
                    error.sum(axis=0),
                ]
                step += 1
                for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self._calibrate(z[held], y[held])
        return self

    def _calibrate(self, z: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least loss on the held rows, by a search over a grid."""
        if not len(z):
            return
        logits = self._logits(z)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
        losses = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])

    def _logits(self, z: np.ndarray) -> np.ndarray:
        return (np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._logits((x - self.mean) / self.scale) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text is 0 modulo 5; such rows are never learnt from."""
    number = F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(number, F.lit(5)) == 0


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 12_000,
    threshold: float = 0.3,
    buckets: int = 8_192,
    width: int = 32,
    ones: int = 4,
    window: int = 2,
    seed: int = 11,
) -> DataFrame:
    """``docs`` with ``held_out, score, predicted``: how likely label 1 is.

    Word vectors are learnt from all documents by random indexing: a word's vector is the
    sum of the sparse random index vectors of its neighbours within ``window`` tokens.
    Words share ``buckets`` by hash. A document pools the vectors of all its tokens; a
    two-layer network turns the pool into a probability, its logits divided by a
    temperature chosen on training rows that were not fitted. Only the text is an input.

    The network is fitted on a bounded sample of the labelled rows that are not held out,
    about ``sample`` of them, chosen by the hash of their id; equal texts may occur. Labels
    that are null are ignored; with no labelled rows, or of one kind only, the score is the
    share of label 1 (0.5 without any). Null and empty texts are scored like any other, as
    a document without tokens. Repeated rows get equal scores; an empty table gives no
    rows. Columns of ``docs`` with the names of results are replaced.
    """
    shape = {"buckets": buckets, "width": width, "ones": ones, "window": window, "seed": seed}
    vectors = word_vectors(context_sums(docs, text, **shape))
    marks = np.array([Vocabulary(buckets).bucket(m) for m in MARKS])

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(buckets)
        for frame in batches:
            rows = [pooled(vocabulary.tokens(t or ""), vectors, marks) for t in frame["text"]]
            yield pd.DataFrame({"y": frame["y"], "key": frame["key"], "x": rows})

    known = (
        labels.select(F.col(id_column).alias("_id"), F.col(label).cast("double").alias("y"))
        .filter("y IS NOT NULL AND _id IS NOT NULL")
        .groupBy("_id")
        .agg(F.max("y").alias("y"))
        .filter(~held_out(F.col("_id")))
    )
    total = known.count()
    share = min(1.0, sample / total) if total else 1.0
    chosen = known.filter(
        F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    )
    examples = (
        docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "_id")
        .select("text", "y", F.xxhash64("_id", "text").alias("key"))
        .mapInPandas(featurise, "y double, key long, x array<double>")
        .toPandas()
        .sort_values("key")
    )
    network = None
    y = examples["y"].to_numpy()
    constant = float(y.mean()) if len(y) else 0.5
    if len(set(y)) == 2:
        network = Network(seed=seed).fit(np.stack(examples["x"].to_list()), y)

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(buckets)
        for batch in texts:
            if network is None:
                yield pd.Series(np.full(len(batch), constant))
                continue
            x = [pooled(vocabulary.tokens(t or ""), vectors, marks) for t in batch]
            yield pd.Series(network.probability(np.stack(x)))

    return (
        docs.withColumn("held_out", held_out(F.col(id_column)))
        .withColumn("score", probability(F.col(text)))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
