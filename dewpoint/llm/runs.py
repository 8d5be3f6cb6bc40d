"""Periodic runs of words, found by minimizers at several scales."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import WORD

# Periods below this are found by comparing the words with those a lag before; it is twice
# the words of the shortest block that is hashed.
DIRECT = 32
LEAST = 12  # words of a run, if two periods are fewer
_MIX = np.uint64(0x9E3779B97F4A7C15)
FOUND = "starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def runs_in(words: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """All maximal runs: rows of start, length and period, by start and period.

    ``words`` holds the words' numbers of several documents with a number of its own after
    each document, so that no run reaches over it; ``documents`` the places where documents
    end. A run is a longest stretch with smallest period q of at least two periods and
    ``LEAST`` words.

    Periods below ``DIRECT`` come from direct scans at each lag. For those from B to 2B,
    blocks of k = B/2 words are hashed, and the least hash of every k neighbouring blocks is
    a minimizer: B - 1 words decide which, so that inside a run with period q its minimizers
    come again q words later. Equal ones at a distance from B to 2B are extended to a run.
    A block with a period up to k/2 lies in a shorter run, which is known, and would come
    again too often; there the blocks at the ends of these runs stand for all. They come
    again too, unless a single shorter run covers all but one period; then the next run of
    its kind touches it, and the two tell the lags. Each block left has at most eight equal
    ones in reach.
    """
    found = _Runs(words)
    n = len(words)
    for lag in range(1, min(DIRECT, n // 2 + 1)):
        same = np.flatnonzero(words[:-lag] == words[lag:])
        if len(same) >= max(LEAST - lag, lag):
            cuts = np.flatnonzero(np.diff(same) != 1)
            first = same[np.concatenate(([0], cuts + 1))]
            after = same[np.concatenate((cuts, [len(same) - 1]))] + 1
            long = after - first >= max(LEAST - lag, lag)
            for a, b in zip(first[long].tolist(), after[long].tolist(), strict=True):
                found.add(a, b, lag)
    hashes, block = _mixed(words.astype(np.uint64)), 1
    places = np.arange(n)
    lengths = np.diff(documents, prepend=0)
    while True:
        if 2 * block > max(1, int(lengths.max(initial=0)) // 4):
            break
        hashes, block = _mixed(hashes[:-block] * _MIX + hashes[block:]), 2 * block
        if 2 * block < DIRECT:
            continue
        places = _within(places, documents, lengths, 4 * block, len(hashes))
        if not len(places):
            break
        found.seeds(hashes, places, block)
    return found.table()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _within(
    places: np.ndarray, documents: np.ndarray, lengths: np.ndarray, least: int, blocks: int
) -> np.ndarray:
    """The places in documents that hold ``least`` words, as far as blocks begin there."""
    long = np.repeat(lengths >= least, lengths)
    return places[long[places] & (places < blocks)]


class _Runs:
    """The runs found so far."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.known: dict[int, list[tuple[int, int]]] = {}  # by period: begins and ends

    def add(self, a: int, b: int, lag: int) -> None:
        """The stretch in which words a to b equal those ``lag`` later, if it is a run."""
        if b - a < max(lag, LEAST - lag):
            return
        for part in _primes(lag):
            step = lag // part
            if np.array_equal(self.words[a : a + lag], self.words[a + step : a + lag + step]):
                return  # the period is a part of the lag
        self.known.setdefault(lag, []).append((a, b + lag))

    def seeds(self, hashes: np.ndarray, places: np.ndarray, block: int) -> None:
        """Runs with periods from 2 to 4 blocks."""
        near, far = 2 * block, 4 * block
        chosen = _minimizers(hashes, places, block)
        short = [
            (period, run)
            for period in sorted(self.known)
            if period <= block // 2
            for run in sorted(self.known[period])
            if run[1] - run[0] >= block
        ]
        pairs = []
        if short:
            ends = np.array([run for _, run in short])
            within = np.zeros(len(self.words) + 1, dtype=np.int64)
            np.add.at(within, ends[:, 0], 1)
            np.add.at(within, ends[:, 1] - block + 1, -1)
            chosen = chosen[np.cumsum(within)[chosen] == 0]
            for at in (ends[:, 0], ends[:, 1] - block):
                pairs += _equal_pairs(hashes, np.sort(at), near, far)
            for (period, one), (other, next_) in zip(short, short[1:]):
                if period == other and next_[0] <= one[1]:
                    pairs += self._touching(period, one, next_, near, far)
        pairs += _equal_pairs(hashes, chosen, near, far)
        done = {}
        for lag, at in sorted(pairs):
            if at >= done.get(lag, 0):
                a, b = self._extended(at, lag)
                done[lag] = max(b, at + 1)
                self.add(a, b, lag)

    def _touching(
        self, period: int, one: tuple[int, int], two: tuple[int, int], near: int, far: int
    ) -> list[tuple[int, int]]:
        """Lags at which the second run goes on as the first one did."""
        head = self.words[two[0] : two[0] + period].tobytes()
        cycle = self.words[one[0] : one[0] + 2 * period].tobytes()
        width = self.words.itemsize
        turn = cycle.find(head)
        while turn > 0 and turn % width:
            turn = cycle.find(head, turn + 1)
        if turn < 0:
            return []
        first = (two[0] - one[0] - turn // width) % period
        last = min(far - 1, one[1] - one[0], two[1] - two[0])
        start = first + -(-max(0, near - first) // period) * period
        return [
            (lag, max(one[0], two[0] - lag))
            for lag in range(start, last + 1, period)
            if max(one[0], two[0] - lag) < one[1]
        ]

    def _extended(self, at: int, lag: int) -> tuple[int, int]:
        """The longest stretch around ``at`` whose words equal those ``lag`` later."""
        words, n = self.words, len(self.words) - lag
        a = b = at
        step = 64
        while b < n:
            end = min(n, b + step)
            differ = np.flatnonzero(words[b:end] != words[b + lag : end + lag])
            if len(differ):
                b += int(differ[0])
                break
            b, step = end, 2 * step
        step = 64
        while a > 0:
            begin = max(0, a - step)
            differ = np.flatnonzero(words[begin:a] != words[begin + lag : a + lag])
            if len(differ):
                a = begin + int(differ[-1]) + 1
                break
            a, step = begin, 2 * step
        return a, b

    def table(self) -> np.ndarray:
        rows = {(a, b - a, p) for p, runs in self.known.items() for a, b in runs}
        ordered = sorted(rows, key=lambda r: (r[0], r[2]))
        return np.array(ordered, dtype=np.int64).reshape(-1, 3)


def _primes(number: int) -> list[int]:
    found, part = [], 2
    while part * part <= number:
        if number % part == 0:
            found.append(part)
            while number % part == 0:
                number //= part
        part += 1
    return [*found, number] if number > 1 else found


def _minimizers(hashes: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """Where the least of ``window`` neighbouring hashes stands, the first of equal ones.

    Places that are not neighbours never share more than their order, so a window over a
    gap only adds a place.
    """
    if len(places) < window:
        return places[:0]
    shift = np.uint64(max(1, len(places).bit_length()))
    least = (hashes[places] >> shift << shift) | np.arange(len(places), dtype=np.uint64)
    width = 1
    while width < window:  # windows are powers of two, as blocks are
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    order = (least & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    # The place moves on with the window, so equal ones are neighbours.
    return places[order[np.concatenate(([True], order[1:] != order[:-1]))]]


def _equal_pairs(
    hashes: np.ndarray, at: np.ndarray, near: int, far: int
) -> list[tuple[int, int]]:
    """``lag, place`` of equal hashes at rising places ``at``, ``near`` <= lag < ``far``."""
    code, _ = pd.factorize(hashes[at])
    order = np.argsort(code, kind="stable")
    code, at = code[order], at[order]
    spread = np.int64(len(hashes) + far + 1)
    key = code * spread + at
    first, last = np.searchsorted(key, key + near), np.searchsorted(key, key + far)
    number = last - first
    one = np.repeat(np.arange(len(at)), number)
    other = np.arange(number.sum()) + np.repeat(first - np.cumsum(number) + number, number)
    return list(zip((at[other] - at[one]).tolist(), at[one].tolist(), strict=True))


class _Numbers(dict):
    """Words numbered from 0 in order of their first use."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def periodic_runs(
    docs: DataFrame, *, text: str = "text", words_at_once: int = 1_000_000
) -> DataFrame:
    """``docs`` with ``runs`` and ``collapsed``.

    ``runs`` is the array of ``start, length, period`` of every run of words (see
    ``runs_in``), words numbered from 0, by start and period. ``collapsed`` is the text's
    words joined by one space, without those that some run holds after its first period. A
    null or empty text has no words, no runs and the empty text as collapsed one; rows are
    judged alone, so repeated rows get the same; an empty table gives none. Columns called
    ``runs`` or ``collapsed`` are replaced.

    Texts are cut into words piece by piece, and about ``words_at_once`` words of several
    texts (a longer text alone) are searched at once; nothing is shuffled.
    """
    word = re.compile(WORD)

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows: list[tuple] = []
            held: list[tuple[int, int]] = []
            numbers, ids = _Numbers(), array("q")
            for content in texts:
                begin = len(ids)
                for piece in _pieces(content or ""):
                    ids.extend(map(numbers.__getitem__, word.findall(piece)))
                held.append((begin, len(ids)))
                ids.append(-len(held))
                if len(ids) >= words_at_once:
                    rows += _searched(held, ids, numbers)
                    held, numbers, ids = [], _Numbers(), array("q")
            rows += _searched(held, ids, numbers)
            yield pd.DataFrame(rows, columns=["starts", "lengths", "periods", "collapsed"])

    found = F.pandas_udf(find, FOUND)  # type: ignore[call-overload]
    return (
        docs.withColumn("_found", found(F.col(text)))
        .withColumns(
            {
                "runs": F.transform(
                    F.arrays_zip("_found.starts", "_found.lengths", "_found.periods"),
                    lambda r: F.struct(
                        r["starts"].alias("start"),
                        r["lengths"].alias("length"),
                        r["periods"].alias("period"),
                    ),
                ),
                "collapsed": F.col("_found.collapsed"),
            }
        )
        .drop("_found")
    )


def _pieces(text: str, size: int = 1_000_000) -> Iterator[str]:
    """The text in pieces that end between words."""
    end = re.compile(r"[\x20\x09-\x0D]")
    at = 0
    while at < len(text):
        after = end.search(text, at + size)
        to = after.start() if after else len(text)
        yield text[at:to]
        at = to


def _searched(held: list[tuple[int, int]], ids: array, numbers: dict) -> Iterator[tuple]:
    """A row of runs and collapsed text for each ``begin, end`` among the words."""
    words = np.frombuffer(ids, dtype=np.int64)
    ends = np.array([end + 1 for _, end in held], dtype=np.int64)
    runs = runs_in(words, ends)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(dropped[:-1]) == 0
    texts = np.array([*numbers, ""], dtype=object)[:-1]
    of = np.searchsorted(runs[:, 0], [begin for begin, _ in held] + [len(words)])
    for (begin, end), a, b in zip(held, of, of[1:], strict=False):
        own = runs[a:b]
        collapsed = " ".join(texts[words[begin:end][stays[begin:end]]])
        yield own[:, 0] - begin, own[:, 1], own[:, 2], collapsed


def longest_run(runs: Column, field: str) -> Column:
    """A field of the run with the greatest length, the first of equal ones; else null."""
    best = F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best),
    )
    return best[field]
