"""Secrets found by patterns and by character Markov models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, in their order, with the part whose length counts and
# the least such length.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
)
BASE = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# The base patterns with their least lengths: a run of hex digits alone would take letters
# out of ordinary words.
FOUND = (ASSIGN, r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")
# What the models judge: runs of the characters that keys are made of.
CANDIDATE = r"[A-Za-z0-9+/_=-]{8,}"
# Characters are told apart by their ASCII codes.
CODES = 128

SPAN = "struct<start:int,kind:int,end:int>"


def pattern_spans(
    text: Column,
    pattern: str,
    kind: int,
    group: int,
    least: float,
    measure: Callable[[Column], Column] = F.length,
) -> Column:
    """Spans ``start, kind, end`` of leftmost matches, in code points, end exclusive.

    A match starts where the pieces between matches and the matches before it end.
    Matches whose ``group`` measures less than ``least`` are dropped afterwards.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern), F.length)
    steps = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"),
        F.transform(whole, F.length).alias("taken"),
        F.transform(counted, measure).alias("counted"),
    )
    nothing = F.array().cast(f"array<{SPAN}>")
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), nothing.alias("found")),
        lambda state, step: F.struct(
            (state["at"] + step["gap"] + step["taken"]).alias("at"),
            F.when(
                step["counted"] >= least,
                F.concat(
                    state["found"],
                    F.array(
                        F.struct(
                            (state["at"] + step["gap"]).alias("start"),
                            F.lit(kind).alias("kind"),
                            (state["at"] + step["gap"] + step["taken"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(state["found"])
            .alias("found"),
        ),
        lambda state: state["found"],
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(nothing)


def codes_of(token: Column) -> Column:
    """ASCII codes of a token of candidate characters."""
    return F.transform(F.split(token, ""), F.ascii)


def train_models(docs: DataFrame, *, text: str = "text") -> list[float]:
    """Log-likelihood ratios of character pairs: random strings against ordinary words.

    The labelled samples are the distinct tokens of all documents: strings that the base
    patterns find are random ones, other letter-digit runs of four and more characters
    ordinary ones. Both models give the probability of a character after the one before
    it, each pair counted once more than seen, where a token to be judged counts as unseen. Returns CODES * CODES numbers, that of
    (a, b) at a * CODES + b; the model is of this size whatever the corpus is.
    """
    chosen = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    secret = F.concat(
        *[
            F.filter(
                F.regexp_extract_all("text", F.lit(pattern), F.lit(group)),
                lambda s, n=least: F.length(s) >= n,
            )
            for _, pattern, group, least in BASE
        ]
    )
    rest = F.col("text")
    for pattern in FOUND:
        rest = F.regexp_replace(rest, pattern, " ")
    plain = F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9_-]{4,}"), F.lit(0))
    tokens = chosen.select(
        F.explode(
            F.concat(
                F.transform(secret, lambda s: F.struct(s.alias("token"), F.lit(1).alias("random"))),
                F.transform(plain, lambda s: F.struct(s.alias("token"), F.lit(0).alias("random"))),
            )
        ).alias("t")
    ).select("t.*")
    words = tokens.distinct()
    codes = codes_of(F.col("token"))
    pairs = (
        words.withColumn("codes", codes)
        .select(
            "random",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.size("codes") - 2),
                    lambda i: F.get("codes", i) * CODES + F.get("codes", i + 1),
                )
            ).alias("pair"),
        )
        .filter(F.col("pair").between(0, CODES * CODES - 1))
        .groupBy("random", "pair")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = {0: [1.0] * (CODES * CODES), 1: [1.0] * (CODES * CODES)}
    for row in pairs.collect():
        counts[row.random][row.pair] += row.n
    # What is judged is one of the ordinary tokens: its own pairs do not count for it.
    return _ratios(counts[1], [max(n - 1.0, 1.0) for n in counts[0]])


def _ratios(random: list[float], ordinary: list[float]) -> list[float]:
    from math import log

    ratios = []
    for first in range(CODES):
        row = slice(first * CODES, (first + 1) * CODES)
        shift = log(sum(ordinary[row]) / sum(random[row]))
        ratios += [
            round(log(r / o) + shift, 4) for r, o in zip(random[row], ordinary[row], strict=True)
        ]
    return ratios


def ratio_of(token: Column, ratios: Column) -> Column:
    """Log-likelihood ratio of a token: above 0 it looks random rather than ordinary."""
    return F.aggregate(
        F.array(codes_of(token)),
        F.lit(0.0),
        lambda _, codes: F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 2),
            F.lit(0.0),
            lambda sum_, i: sum_
            + F.get(ratios, F.get(codes, i) * CODES + F.get(codes, i + 1)),
        ),
    )


def scan_secrets(
    docs: DataFrame,
    *,
    text: str = "text",
    ratios: list[float] | None = None,
    threshold: float = 12.0,
) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: sorted arrays of ``start, kind, end``.

    ``kind`` is the place in ``KINDS``. ``base`` holds the matches of the base patterns,
    ``spans`` also the candidate strings whose log-likelihood ratio (``train_models``)
    reaches ``threshold`` and that are not within a base match; they may overlap one. Positions are code points of the
    whole text. A null or empty text has no spans; rows are judged alone, so repeated rows
    get the same spans; an empty table gives none. Columns of ``docs`` are kept; columns
    called ``base`` or ``spans`` are replaced.
    """
    if ratios is None:
        ratios = train_models(docs, text=text)
    model = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    content = F.coalesce(F.col(text), F.lit(""))
    nothing = F.array().cast(f"array<{SPAN}>")
    based = docs.withColumn(
        "base",
        F.array_sort(
            F.concat(
                *[
                    pattern_spans(content, pattern, kind, group, least)
                    for kind, (_, pattern, group, least) in enumerate(BASE)
                ]
            )
        ),
    )
    candidates = pattern_spans(
        content, CANDIDATE, len(BASE), 0, threshold, lambda token: ratio_of(token, model)
    )
    judged = F.filter(
        candidates,
        lambda s: ~F.exists(
            F.col("base"), lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])
        ),
    )
    return based.withColumn(
        "spans",
        F.array_sort(F.concat(F.col("base"), F.coalesce(judged, nothing))),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each run of overlapping spans replaced by a mark."""
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda state, s: F.when(s["end"] <= state["at"], state).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(s["start"] < state["at"], state["out"])
                .otherwise(
                    F.concat(
                        state["out"],
                        text.substr(state["at"] + 1, s["start"] - state["at"]),
                        F.lit(mark),
                    )
                )
                .alias("out"),
            )
        ),
        lambda state: F.concat(
            state["out"], text.substr(state["at"] + 1, F.length(text) - state["at"])
        ),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
