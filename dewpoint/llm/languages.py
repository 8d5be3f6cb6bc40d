"""Language of a text by string kernels: Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dewpoint.llm.common import kept, text_hash

LONGEST = 3  # characters of the longest n-grams
_BITS = 21  # of a code point
_CHUNK = 1 << 20  # characters of a text whose n-grams are sorted at once
NO_LANGUAGE = "und"
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1)


def spectrum(text: str) -> np.ndarray:
    """The distinct n-grams of 1 to ``LONGEST`` characters of the lower-cased text, rising.

    An n-gram is the number its code points form; no two share one.
    """
    letters = text.lower()
    found = np.zeros(0, dtype=np.int64)
    for a in range(0, len(letters), _CHUNK):
        part = letters[a : a + _CHUNK + LONGEST - 1]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32) + np.int64(1)
        grams, ngrams = points, [points]
        for n in range(1, LONGEST):
            grams = (grams[:-1] << _BITS) + points[n:]
            ngrams.append(grams)
        here = np.sort(np.concatenate(ngrams))
        here = here[np.concatenate((here[:1] >= 0, here[1:] != here[:-1]))]
        found = np.union1d(found, here) if len(found) else here
    return found


@dataclass
class Kernel:
    """Blended-spectrum presence kernel against landmarks.

    The kernel of two texts is the number of n-grams that both have, over the root of the
    product of how many each has.
    """

    grams: np.ndarray  # those of all landmarks, rising
    landmarks: np.ndarray  # a row per n-gram, a column per landmark, scaled

    @staticmethod
    def of(spectra: list[np.ndarray]) -> Kernel:
        grams = np.unique(np.concatenate(spectra))
        landmarks = np.zeros((len(grams), len(spectra)), dtype=np.float32)
        for at, own in enumerate(spectra):
            landmarks[np.searchsorted(grams, own), at] = 1 / np.sqrt(len(own))
        return Kernel(grams, landmarks)

    def presence(self, texts: list[str]) -> np.ndarray:
        """A row per text over ``grams``, scaled; a text without n-grams has zeros."""
        rows = np.zeros((len(texts), len(self.grams)), dtype=np.float32)
        for at, text in enumerate(texts):
            own = spectrum(text)
            if len(own):
                place = np.searchsorted(self.grams, own)
                place[place == len(self.grams)] = 0
                rows[at, place[self.grams[place] == own]] = 1 / np.sqrt(len(own))
        return rows


@dataclass
class Model:
    """Languages with a column of weights over n-grams each."""

    languages: list[str]
    grams: np.ndarray
    weights: np.ndarray
    share: float  # the prediction for a text that shares nothing with any landmark

    def predicted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The index of the best language of each text, and its share of all scores."""
        rows = Kernel(self.grams, self.weights).presence(texts)
        scores = np.clip(rows.astype(np.float64) @ self.weights + self.share, 1e-9, None)
        best = scores.argmax(axis=1)
        return best, scores[np.arange(len(texts)), best] / scores.sum(axis=1)


def _blocks(texts: pd.Series, rows: int = 128) -> Iterator[list[str]]:
    for a in range(0, len(texts), rows):
        yield ["" if t is None else t for t in texts.iloc[a : a + rows]]


def train(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    rows: int = 12_000,
    landmarks: int = 256,
    landmark_chars: int = 20_000,
) -> Model | None:
    """A model learnt from about ``rows`` of the texts that have a language.

    Languages are taken evenly as far as they reach, by a hash of the text, a repeated text
    once. Of each the same number are landmarks, ``landmarks`` in all and one at least, texts
    up to ``landmark_chars`` first. Tasks compute the kernel of the sampled texts with the
    landmarks; the driver gets that matrix (``rows`` x ``landmarks``), the landmarks'
    n-grams and a number per language. One ridge regression per language is solved on them;
    the ridge is the one of ``RIDGES`` that has the least squared error on a fifth kept
    apart. None if no text has a language and an n-gram.
    """
    learnt = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    sizes = {r.lang: r.n for r in learnt.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    quota = rows / len(languages)
    share = F.create_map(
        *[F.lit(v) for name in languages for v in (name, min(1.0, quota / sizes[name]))]
    )
    key = text_hash(F.col("text"))
    sample = kept(
        learnt.withColumn("key", key)
        .filter(F.col("key") < share[F.col("lang")] * F.lit(2.0**60))
        .groupBy("lang", "key")
        .agg(F.first("text").alias("text"))
    )
    order = Window.partitionBy("lang").orderBy(F.length("text") > landmark_chars, "key")
    chosen = (
        sample.select("lang", "key", F.row_number().over(order).alias("place"))
        .filter(F.col("place") <= max(1, landmarks // len(languages)))
        .drop("place")
    )
    marks = sample.join(chosen, ["lang", "key"]).orderBy("lang", "key")
    spectra = [
        np.frombuffer(row.grams, dtype=np.int64)
        for row in marks.mapInPandas(_spectra, "lang string, key long, grams binary")
        .sort("lang", "key")
        .collect()
    ]
    if not spectra:
        return None
    kernel = Kernel.of(spectra)
    shared = docs.sparkSession.sparkContext.broadcast(spectra)

    def against(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here = Kernel.of(shared.value)
        for frame in batches:
            at = 0
            for texts in _blocks(frame["text"]):
                matrix = here.presence(texts) @ here.landmarks
                own = frame.iloc[at : at + len(texts)]
                at += len(texts)
                yield pd.DataFrame(
                    {"lang": own["lang"], "key": own["key"], "row": [r.tobytes() for r in matrix]}
                )

    rows_ = (
        sample.mapInPandas(against, "lang string, key long, row binary").sort("lang", "key").collect()
    )
    matrix = np.stack([np.frombuffer(r.row, dtype=np.float32) for r in rows_]).astype(np.float64)
    target = np.array([[r.lang == name for name in languages] for r in rows_], dtype=np.float64)
    among = kernel.landmarks.T.astype(np.float64) @ kernel.landmarks
    weights = _solved(matrix, target, among, np.array([r.key % 5 == 0 for r in rows_]))
    return Model(
        languages,
        kernel.grams,
        (kernel.landmarks.astype(np.float64) @ weights).astype(np.float32),
        1 / len(languages),
    )


def _spectra(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        grams = [spectrum(t).tobytes() for t in frame["text"]]
        yield pd.DataFrame({"lang": frame["lang"], "key": frame["key"], "grams": grams})


def _solved(
    matrix: np.ndarray, target: np.ndarray, among: np.ndarray, apart: np.ndarray
) -> np.ndarray:
    """Weights of the landmarks for each language: ridge regression in their span."""
    target = target - 1 / target.shape[1]

    def solve(rows: np.ndarray, ridge: float) -> np.ndarray:
        a = matrix[rows]
        square = a.T @ a + ridge * len(a) * among
        square[np.diag_indices_from(square)] += 1e-8 * max(np.trace(square), 1e-12) / len(square)
        return np.linalg.solve(square, a.T @ target[rows])

    best = RIDGES[1]
    if apart.any() and not apart.all():
        errors = {
            ridge: ((matrix[apart] @ solve(~apart, ridge) - target[apart]) ** 2).mean()
            for ridge in RIDGES
        }
        best = min(errors, key=errors.get)
    return solve(np.ones(len(matrix), dtype=bool), best)


def identify(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the language's own score.

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    without a model. Rows are judged alone, so repeated rows get the same; an empty table
    gives none. Scores are rounded to six places. Columns called ``lang_pred`` or ``score``
    are replaced; others are kept.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(NO_LANGUAGE), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        here = shared.value
        for texts in batches:
            best, score = [], []
            for block in _blocks(texts):
                which, share = here.predicted(block)
                best += [here.languages[i] for i in which]
                score += np.round(share, 6).tolist()
            yield pd.DataFrame({"lang_pred": best, "score": score})

    judged = F.pandas_udf(judge, "lang_pred string, score double")  # type: ignore[call-overload]
    letters = F.coalesce(F.regexp_like(F.col(text), F.lit(r"\p{L}")), F.lit(False))
    return (
        docs.withColumn("_judged", judged(F.when(letters, F.col(text))))
        .withColumns(
            {
                "lang_pred": F.when(letters, F.col("_judged.lang_pred")).otherwise(NO_LANGUAGE),
                "score": F.when(letters, F.col("_judged.score")).otherwise(0.0),
            }
        )
        .drop("_judged")
    )


def held_out(key: str) -> Column:
    """Whether crc32 of the column's text is a multiple of 5; not for a null."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))
