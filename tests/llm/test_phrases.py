import random
import re
from collections import Counter

import numpy as np
import pytest

from dewpoint.llm.phrases import (
    Marks,
    _bucket,
    _hash,
    _Words,
    collocations,
    count_phrases,
    open_buckets,
)

DOCS = "doc_id long, text string, lang string, phrase string, n int, rank string"


def brute_force(rows, support, longest=5, best=2_000):
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", small):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    frequent = {key: f for key, f in counts.items() if f >= support}
    found = {}
    for (lang, phrase), a in frequent.items():
        if len(phrase) == 1 or any(
            o[0] == lang and len(o[1]) > len(phrase) and frequent[o] >= a
            and any(o[1][i : i + len(phrase)] == phrase for i in range(len(o[1])))
            for o in frequent
        ):
            continue
        score, _, l, r = min(
            (1000 * a * sizes[lang] // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k,
             counts[lang, phrase[:k]], counts[lang, phrase[k:]])
            for k in range(1, len(phrase))
        )
        found.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score)
        for lang, phrases in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:best], 1)
    )


def texts(seed, n):
    draw = random.Random(seed)
    words = ["The", "of", "é", "Été", "x\x00y", " ", "stuffed", "a'b", "日本"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n):
        count = draw.choice((0, 1, 3, 40, 120))
        parts = draw.choices(words, [30 // (k + 1) + 1 for k in range(len(words))], k=count)
        gaps = draw.choices([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?"], [20, 2, 2, 1, 1, 1, 1, 1], k=count)
        rows.append(("".join(p + g for p, g in zip(parts, gaps)), draw.choice(["en", "fr", None, "und"])))
    rows += [(None, None), ("", "en"), ("...", "de"), ("Stuffed " * 300, "en"), ("solo", "xx")]
    rows += [("one two three four five six", "en")] * 12
    return rows


@pytest.mark.parametrize("sample", [0.5, 1e-9])
def test_equal_to_brute_force(spark, sample):
    """Also where the sample proposes nothing, so that all is found by the expansion."""
    rows = texts(4, 60)
    docs = spark.createDataFrame([(i, t, l, "x", 1, "y") for i, (t, l) in enumerate(rows)], DOCS)
    found = collocations(docs.repartition(5), support=8, sample=sample).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, 8)


def test_best_phrases_and_empty_table(spark):
    rows = texts(5, 40)
    docs = spark.createDataFrame([(i, t, l, "x", 1, "y") for i, (t, l) in enumerate(rows)], DOCS)
    found = collocations(docs, support=5, best=3, salts=2).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, 5, best=3)
    assert collocations(docs.limit(0)).collect() == []


def test_long_text_equals_brute_force(spark):
    """Texts beyond the words counted at once, and one long piece."""
    draw = random.Random(1)
    long = " ".join(draw.choice("abcdefgh") for _ in range(60_000))
    rows = [(long, "en"), (long[:50_001].upper(), "en"), ("a b, " * 20_000, "fr")]
    docs = spark.createDataFrame([(i, t, l, "x", 1, "y") for i, (t, l) in enumerate(rows)], DOCS)
    assert sorted(map(tuple, collocations(docs).collect())) == brute_force(rows, 100)


def test_marks_are_at_the_places_that_tasks_look_at(spark):
    phrases = [("en", 1, "été"), ("en", 2, "a b"), ("und", 2, "日本 x")]
    table = spark.createDataFrame(phrases, "lang string, length int, phrase string")
    marks = Marks.unpacked(Marks(3).with_phrases(table, grow=True).packed())
    words = _Words()
    words.add("Été a b. b a")
    found = {
        (length, phrase.decode()): bool(m)
        for length, starts, _, marked in words.levels(b"en", marks, None, 2)
        for start, m in zip(starts, marked)
        for (phrase,), _ in words.counted(length, np.array([start]))
    }
    # "b a" and "a b" are no phrases whose words are marked.
    assert found == {(1, "Été"): False, (1, "a"): False, (1, "b"): False}
    everything = Marks(3)
    everything.bits[1][:] = True
    everything = everything.with_phrases(table.filter("length = 2"), grow=False)
    found = {
        phrase.decode(): bool(m)
        for length, starts, _, marked in words.levels(b"en", everything, None, 2)
        for start, m in zip(starts, marked)
        for (phrase,), _ in words.counted(length, np.array([start]))
        if length == 2
    }
    assert found == {"Été a": False, "a b": True, "b a": False}


def test_words_in_portions():
    """Numbers go on over portions and start anew beyond a bound."""
    words = _Words(remembered=3)
    for text in ("a b a", "b c", "a d", "e a", "x a e"):
        words.add(text)
        (level,) = words.levels(b"en", Marks(1), None, 1)
        counted = dict(zip(*next(words.counted(1, level[1]))))
        assert counted == dict(Counter(w.encode() for w in text.split()))
        words.restart()


def test_buckets_hold_every_frequent_border_phrase(spark):
    rows = texts(6, 60)
    docs = spark.createDataFrame([("en", t or "") for t, _ in rows], "lang string, text string")
    nothing = Marks(3)
    open_ = open_buckets(docs.repartition(3), nothing, 300, 2, buckets=2**15)
    counts = count_phrases(docs, nothing, range(1, 3)).collect()
    assert len(counts) > 15 and max(r.n for r in counts) > 300
    for row in counts:
        place = _bucket(_hash(b"en", row.phrase.encode()), 1, 2**15)[0]
        assert open_[place] or row.n < 300
    assert open_.sum() <= sum(r.n >= 300 for r in counts) + 2
