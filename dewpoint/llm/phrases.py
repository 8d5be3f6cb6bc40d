"""Phrase collocations by Toivonen's sampling."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import islice
from math import prod

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dewpoint.llm.common import beside, kept

# Bytes that end a piece of text become line feeds, tabs become spaces, A-Z small letters;
# all of them are ASCII, so bytes of longer characters stay as they are.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FOLDED = bytes.maketrans(
    _CAPITALS + _ENDS + b"\t", _CAPITALS.lower() + b"\n" * len(_ENDS) + b" "
)
_LETTER = r"[^\x20\x09-\x0D.,;:!?]"
DRAWN = rf"(?:{_LETTER}+[\x20\x09]+){{0,11}}{_LETTER}+"
_COUNTS = pa.schema(
    [("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())]
)
_SLICE = 100_000  # phrases made into text at once
_MARK_BITS = 2**26  # bits of the marks of one length at most
_BUCKETS = 2**27  # buckets of border phrases at most
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BUCKET_BITS = 32_768  # bits of one value of bitmap_construct_agg


class _Numbers(dict):
    """Words numbered from 0 in order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Marks:
    """Which phrases of each length are taken for frequent, as bits at their hashes.

    Two phrases may share a bit. A phrase that is marked for another's sake is one more
    that the passes extend; no result depends on it.
    """

    def __init__(self, longest: int):
        self.bits = {length: np.zeros(_BUCKET_BITS, dtype=bool) for length in range(1, longest)}

    def with_phrases(self, phrases: DataFrame, grow: bool) -> Marks:
        """These marks and those of ``lang, length, phrase``.

        With ``grow`` the lengths among the phrases start anew, with 16 bits a phrase and
        ``_MARK_BITS`` at most; else every bit that was set stays set. Spark makes the
        bitmaps, so the driver receives 8 MB a length at most whatever their number.
        """
        new = Marks(1)
        new.bits = {length: bits.copy() for length, bits in self.bits.items()}
        if grow:
            for length, n in phrases.groupBy("length").count().collect():
                wanted = 1 << max(15, (16 * n - 1).bit_length())
                new.bits[length] = np.zeros(min(wanted, _MARK_BITS), dtype=bool)
        sizes = {length: len(bits) for length, bits in new.bits.items()}

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths = batch.column("length").to_pylist()
                places = [
                    _places(_hash(lang.encode(), phrase.encode()), sizes[length])[0]
                    for lang, length, phrase in zip(
                        batch.column("lang").to_pylist(),
                        lengths,
                        batch.column("phrase").to_pylist(),
                        strict=True,
                    )
                ]
                # Buckets are numbered from 1, the bits of a bucket from 0.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lengths, pa.int32()), pa.array(places, pa.int64())],
                    names=["length", "place"],
                )

        bucket = F.call_function("bitmap_bucket_number", F.col("place") + 1)
        bit = F.call_function("bitmap_bit_position", F.col("place") + 1)
        found = (
            phrases.select("lang", "length", "phrase")
            .mapInArrow(place, "length int, place long")
            .groupBy("length", bucket.alias("bucket"))
            .agg(F.call_function("bitmap_construct_agg", bit).alias("bitmap"))
        )
        for row in found.collect():
            here = np.unpackbits(np.frombuffer(row.bitmap, np.uint8), bitorder="little")
            at = (row.bucket - 1) * _BUCKET_BITS
            new.bits[row.length][at : at + _BUCKET_BITS] |= here.astype(bool)
        return new

    def packed(self) -> dict[int, bytes]:
        return {length: np.packbits(bits).tobytes() for length, bits in self.bits.items()}

    @staticmethod
    def unpacked(packed: dict[int, bytes]) -> Marks:
        marks = Marks(1)
        marks.bits = {
            length: np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool)
            for length, b in packed.items()
        }
        return marks


def _word_hashes(lang: bytes, words: list[bytes]) -> np.ndarray:
    prefix = lang + b"\t"
    return np.array([xxhash.xxh3_64_intdigest(prefix + w) for w in words], dtype=np.uint64)


def _hash(lang: bytes, phrase: bytes) -> np.ndarray:
    """The hash of one phrase, as ``_Words.levels`` makes it from those of its words."""
    first, *others = _word_hashes(lang, phrase.split(b" "))[:, None]
    for word in others:
        first = first * _MIX + word
    return first


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """A place below ``size``, a power of two, for each hash."""
    mixed = (hashes ^ (hashes >> np.uint64(32))) * _MIX
    return (mixed >> np.uint64(65 - size.bit_length())).astype(np.int64)


class _Words:
    """The words of some texts of one language, with a break after each piece."""

    def __init__(self, remembered: int = 500_000):
        self.numbers, self.ids, self.remembered = _Numbers(), array("i"), remembered
        self.texts: list[bytes] = []  # of the numbers, with their hashes
        self.hashes = np.zeros(0, dtype=np.uint64)

    def restart(self) -> None:
        """Forget the words, not their numbers unless they are many."""
        self.ids = array("i")
        if len(self.numbers) > self.remembered:
            self.__init__(self.remembered)

    def known(self, lang: bytes) -> None:
        """List the texts and hashes of new numbers."""
        new = list(islice(self.numbers, len(self.texts), None))
        self.texts += new
        self.hashes = np.concatenate((self.hashes, _word_hashes(lang, new)))

    def add(self, text: str) -> None:
        ids, number = self.ids, self.numbers.__getitem__
        for piece in text.encode("utf-8", "surrogatepass").translate(_FOLDED).split(b"\n"):
            words = piece.split()
            if words:
                ids.extend(map(number, words))
                ids.append(-1)

    def levels(
        self, lang: bytes, marks: Marks, before: Marks | None, longest: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length the phrases whose parts are all marked.

        Gives ``length, starts, hashes, marked``. With ``before`` those whose parts were all
        marked then are left out, and the others are parts of longer ones, marked or not.
        """
        ids = np.frombuffer(self.ids, dtype=np.int32)
        self.known(lang)
        if not len(ids):
            return
        own = self.hashes[ids]  # breaks get some word's hash, but are no starts
        hashes, fits = own, ids >= 0
        known = fits  # counted with the marks before
        for length in range(1, longest + 1):
            starts = np.flatnonzero(fits)
            here = hashes[starts]
            bits = marks.bits.get(length)
            if bits is None:
                marked = np.ones(len(here), dtype=bool)
            else:
                marked = bits[_places(here, len(bits))]
            if before:
                new = ~known[starts]
                yield length, starts[new], here[new], marked[new]
                marked |= new
            else:
                yield length, starts, here, marked
            if length == longest:
                return
            good = np.zeros(len(fits), dtype=bool)
            good[starts[marked]] = True
            if before:
                old = before.bits[length]
                known = known.copy()
                known[starts] &= old[_places(here, len(old))]
                known = known[:-1] & known[1:]
            fits = good[:-1] & good[1:]
            hashes = hashes[:-1] * _MIX + own[length:]

    def counted(self, length: int, starts: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """The distinct phrases that begin at ``starts``, with their numbers."""
        ids = np.frombuffer(self.ids, dtype=np.int32).astype(np.int64)
        words = self.texts
        code = ids[starts]
        for more in range(1, length):
            code, _ = pd.factorize(code * len(words) + ids[starts + more])
        code, keys = pd.factorize(code)
        occurrences = np.bincount(code, minlength=len(keys))
        where = np.zeros(len(keys), dtype=np.int64)
        where[code[::-1]] = starts[::-1]  # the first of each
        for a in range(0, len(where), _SLICE):
            part = where[a : a + _SLICE]
            columns = [[words[i] for i in ids[part + more].tolist()] for more in range(length)]
            yield list(map(b" ".join, zip(*columns))), occurrences[a : a + _SLICE]


def _held(
    batches: Iterator[pa.RecordBatch], words_at_once: int
) -> Iterator[dict[str, _Words]]:
    """The words of the texts by language, about ``words_at_once`` at a time."""
    held: dict[str, _Words] = {}
    words = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            of_lang = held.setdefault(lang.as_py(), _Words())
            words -= len(of_lang.ids)
            of_lang.add(text.as_py())
            words += len(of_lang.ids)
            if words >= words_at_once:
                yield held
                for of_lang in held.values():
                    of_lang.restart()
                words = 0
    yield held


def count_phrases(
    texts: DataFrame,
    marks: Marks,
    lengths: range,
    *,
    before: Marks | None = None,
    open_: np.ndarray | None = None,
    words_at_once: int = 1_000_000,
) -> DataFrame:
    """``lang, length, phrase, n``: exact counts of phrases whose parts are all marked.

    ``texts`` has ``lang`` and ``text`` without nulls. Length 0 stands for the words
    themselves. With ``open_`` the phrases that are not marked count only if their bucket is
    set in it. A task counts about ``words_at_once`` words at a time (a longer text at
    once) and hands on a row per phrase, so the frequent ones shrink to a row a task
    before the shuffle.
    """
    context = texts.sparkSession.sparkContext
    packed = None if open_ is None else np.packbits(open_).tobytes()
    shared = context.broadcast((marks.packed(), before and before.packed(), packed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then, buckets = shared.value
        now, then = Marks.unpacked(now), then and Marks.unpacked(then)
        if buckets is not None:
            buckets = np.unpackbits(np.frombuffer(buckets, np.uint8)).astype(bool)

        def row(lang: str, length: int, phrases: list[bytes], n: Sequence[int]) -> pa.RecordBatch:
            columns = [
                pa.array([lang] * len(phrases), pa.string()),
                pa.array([length] * len(phrases), pa.int32()),
                pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(n, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

        for held in _held(batches, words_at_once):
            for lang, words in held.items():
                if 0 in lengths and len(words.ids):
                    n = np.count_nonzero(np.frombuffer(words.ids, np.int32) >= 0)
                    yield row(lang, 0, [b""], [n])
                found = words.levels(lang.encode(), now, then, lengths.stop - 1)
                for length, starts, hashes, marked in found:
                    if length not in lengths:
                        continue
                    if buckets is not None:
                        rest = np.flatnonzero(~marked)
                        marked[rest] = buckets[_bucket(hashes[rest], length, len(buckets))]
                        starts = starts[marked]
                    for phrases, occurrences in words.counted(length, starts):
                        yield row(lang, length, phrases, occurrences)

    return (
        texts.select("lang", "text")
        .mapInArrow(count, "lang string, length int, phrase string, n long")
        .groupBy("lang", "length", "phrase")
        .agg(F.sum("n").alias("n"))
    )


def _bucket(hashes: np.ndarray, length: int, buckets: int) -> np.ndarray:
    return _places(hashes + np.uint64(length), buckets)


def open_buckets(
    texts: DataFrame,
    marks: Marks,
    support: int,
    longest: int,
    *,
    buckets: int,
    words_at_once: int = 1_000_000,
) -> np.ndarray:
    """Which buckets of border phrases hold ``support`` occurrences or more.

    The border are the phrases that are not marked while all their parts are. A phrase is
    no more frequent than its bucket, so the others need not be counted one by one. A task
    keeps a number up to ``support`` a bucket and hands on ranges of them, compressed; the
    same range of 256 tasks is added at a time, then the sums. The driver gets a bit a
    bucket.
    """
    shared = texts.sparkSession.sparkContext.broadcast(marks.packed())
    kind = np.min_scalar_type(support)
    size = min(buckets, _BUCKET_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = Marks.unpacked(shared.value)
        counters = np.zeros(buckets, dtype=kind)
        for held in _held(batches, words_at_once):
            for lang, words in held.items():
                for length, _, hashes, marked in words.levels(lang.encode(), now, None, longest):
                    at = np.sort(_bucket(hashes[~marked], length, buckets))
                    first = np.flatnonzero(np.diff(at, prepend=-1))
                    n = np.diff(first, append=len(at)) + counters[at[first]]
                    counters[at[first]] = np.minimum(n, support)
        ranges = counters.reshape(-1, size)
        part = TaskContext.get().partitionId() // 256
        for a in np.flatnonzero(ranges.any(axis=1)).tolist():
            data = zlib.compress(ranges[a].tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a], pa.int32()), pa.array([part], pa.int32()), pa.array([data])],
                names=["range", "part", "data"],
            )

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, dtype=np.int64)
        for data in frame["data"]:
            total += np.frombuffer(zlib.decompress(data), dtype=kind)
        data = zlib.compress(np.minimum(total, support).astype(kind).tobytes(), 1)
        return frame.iloc[:1].assign(data=[data])

    def full(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(zlib.decompress(added(frame)["data"].iloc[0]), dtype=kind)
        return frame.iloc[:1].assign(data=[np.packbits(total >= support).tobytes()])

    schema = "range int, part int, data binary"
    found = (
        texts.select("lang", "text")
        .mapInArrow(count, schema)
        .groupBy("range", "part")
        .applyInPandas(added, schema)
        .groupBy("range")
        .applyInPandas(full, schema)
    )
    open_ = np.zeros(buckets, dtype=bool)
    for row in found.select("range", "data").collect():
        bits = np.unpackbits(np.frombuffer(row.data, np.uint8), count=size)
        open_[row.range * size : (row.range + 1) * size] = bits
    return open_


def frequent_phrases(
    texts: DataFrame,
    *,
    support: int = 100,
    longest: int = 5,
    sample: float = 1 / 8,
    seed: int = 17,
) -> DataFrame:
    """``lang, length, phrase, n`` of all phrases that occur ``support`` times or more.

    Length 0 holds each language's number of words, whatever it is. By Toivonen: a random
    sample of short runs of words proposes the phrases that reach half their share of the
    support in it. All texts are then counted for the proposed phrases and their
    negative border, the phrases whose parts (their words but the last, their words but
    the first) are all proposed: first in buckets for the border, then exactly for the
    proposed phrases and those border phrases whose bucket reaches the support. If phrases
    of the border reach the support themselves, they are added and an expansion pass counts
    all phrases that can be made with them, each taken for frequent until counted: what it
    leaves out has a part that was counted and does not reach the support, so the border is
    closed. The sample decides whether there is that pass, not the result.

    There are about a quarter as many buckets as words, up to ``_BUCKETS``. Beyond some
    100 GB of text they fill up, and more and more of the border is counted by its text.
    """
    # Some words in a row are drawn, not texts: a text may repeat a phrase, or be a copy.
    pieces = texts.select(
        "lang", F.explode(F.regexp_extract_all("text", F.lit(DRAWN), F.lit(0))).alias("text")
    )
    chosen = kept(pieces.sample(sample, seed=seed))
    lowered = max(1, int(support * sample / 2))
    marks, words = Marks(longest), 0
    for length in range(1, longest):
        # The words of the sample are counted beside those of length 1.
        found = kept(
            count_phrases(chosen, marks, range(length if length > 1 else 0, length + 1)).filter(
                (F.col("n") >= lowered) | (F.col("length") == 0)
            )
        )
        if length == 1:
            words = found.filter("length = 0").agg(F.sum("n")).first()[0] or 0
        marks = marks.with_phrases(found.filter("length > 0"), grow=True)
    wanted = 1 << max(15, int(words / sample / 4).bit_length())
    open_ = open_buckets(texts, marks, support, longest, buckets=min(wanted, _BUCKETS))

    def reaching(counts: DataFrame) -> DataFrame:
        return kept(counts.filter((F.col("n") >= support) | (F.col("length") == 0)))

    frequent = reaching(count_phrases(texts, marks, range(longest + 1), open_=open_))
    failed = kept(_unmarked(frequent.filter(F.col("length").between(1, longest - 1)), marks))
    if failed.isEmpty():
        return frequent
    wider = marks.with_phrases(failed, grow=False)
    more = count_phrases(texts, wider, range(2, longest + 1), before=marks)
    return frequent.unionByName(reaching(more))


def _unmarked(phrases: DataFrame, marks: Marks) -> DataFrame:
    """The phrases that are not marked."""
    shared = phrases.sparkSession.sparkContext.broadcast(marks.packed())

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Marks.unpacked(shared.value).bits
        for batch in batches:
            rows = zip(
                *(batch.column(c).to_pylist() for c in ("lang", "length", "phrase")), strict=True
            )
            held = [
                here[length][_places(_hash(lang.encode(), phrase.encode()), len(here[length]))[0]]
                for lang, length, phrase in rows
            ]
            yield batch.filter(pa.array([not h for h in held], pa.bool_()))

    return phrases.mapInArrow(missing, phrases.schema)


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    support: int = 100,
    longest: int = 5,
    best: int = 2_000,
    sample: float = 1 / 8,
    salts: int = 64,
) -> DataFrame:
    """The ``best`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are made small, texts end their pieces at ``. , ; : ! ?`` and line ends, words are
    runs of anything but spaces and tabs. Within a language a phrase of 2 to ``longest``
    words is a candidate if it occurs ``support`` times or more within pieces, overlaps
    included. ``n`` is the number of words, ``a`` the occurrences of the phrase, ``l`` and
    ``r`` those of its two parts at the cut with the least score, floor(1000 a n / (l r)),
    the earliest of equal ones. A candidate is dropped if a longer one around it occurs as
    often; a chain of such leads through one that is a single word longer, so only these
    are looked at. Products are decimals of 38 digits.

    A null text is empty, a null language ``und``. Repeated rows count as often as they
    come; ties of score and occurrences go by the phrase's bytes. An empty table gives no
    rows; other columns are not read. No language is gathered in one task before its
    phrases are cut to the best ones of ``salts`` parts.
    """
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    frequent = frequent_phrases(texts, support=support, longest=longest, sample=sample)
    counted = frequent.filter("length > 0").select("lang", "phrase", F.col("n").alias("of"))
    sizes = frequent.filter("length = 0").select("lang", "n")
    candidates = frequent.filter("length > 1").withColumnRenamed("n", "a")
    whole = _whole(candidates)

    words = F.split("phrase", " ")
    cuts = whole.select(
        "lang",
        "phrase",
        "a",
        F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"),
    ).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("_first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.lit(longest)), " ").alias("_rest"),
    )
    for part, name in (("_first", "l"), ("_rest", "r")):
        parts = counted.withColumnsRenamed({"phrase": part, "of": name})
        cuts = cuts.join(parts, ["lang", part])
    cuts = beside(cuts, sizes, ["lang"], sizes.count())
    scored = (
        cuts.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    few = salted.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))
    ).filter(F.col("rank") <= best)
    ranked = few.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ).filter(F.col("rank") <= best)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _whole(candidates: DataFrame) -> DataFrame:
    """Candidates that no candidate with one more word around them equals in number."""
    words = F.split("phrase", " ")
    shorter = candidates.filter("length > 2").select(
        "lang",
        "a",
        F.explode(
            F.array(
                F.array_join(F.slice(words, F.lit(1), F.col("length") - 1), " "),
                F.array_join(F.slice(words, F.lit(2), F.col("length") - 1), " "),
            )
        ).alias("phrase"),
    )
    return candidates.join(shorter, ["lang", "phrase", "a"], "left_anti")


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 a n / (l r)) as a long, by whole decimals."""
    above, below = ((F.lit(1000), a, n), (l, r))

    def product(factors: tuple[Column, ...]) -> Column:
        first, *others = (f.cast("decimal(18,0)") for f in factors)
        return prod(others, start=first)

    return F.call_function("div", product(above), product(below))
