import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dewpoint.llm import queries as llm
from dewpoint.llm.runs import periodic_runs, runs_in

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(words):
    """Every stretch equal to itself q later, q being its smallest period."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        begin = 0
        for i, equal in enumerate(same):
            if equal:
                continue
            a, length = begin, i - begin + q
            begin = i + 1
            if i - a < q or length < 12:
                continue
            run = words[a : a + length]
            if not any(run[d:] == run[:-d] for d in range(1, q)):
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def nested(draw, letters):
    """Words in which periods lie within, beside and across periods."""
    words = []
    while len(words) < draw.choice((0, 60, 200, 500)):
        cycle = [draw.randrange(letters) for _ in range(draw.choice((1, 2, 3, 5, 9, 40, 75)))]
        part = (cycle * 140)[: draw.choice((1, 5, 17, 33, 65, 131))]
        words += part * draw.choice((1, 1, 2, 3))
        if words and draw.random() < 0.3:
            words += words[-draw.randrange(1, len(words) + 1) :]
    return words[:700]


@pytest.mark.parametrize("letters", [1, 2, 3, 60])
def test_runs_equal_brute_force(letters):
    draw = random.Random(letters)
    for _ in range(25):
        docs = [nested(draw, letters) for _ in range(3)]
        ids, ends, expected = [], [], []
        for words in docs:
            expected += [(len(ids) + a, length, q) for a, length, q in brute_force(words)]
            ids += [*words, -1 - len(ends)]
            ends.append(len(ids))
        found = runs_in(np.array(ids, dtype=np.int64), np.array(ends))
        assert [tuple(r) for r in found.tolist()] == expected


def test_runs_across_two_shorter_ones():
    """A period whose one copy lies in a shorter run and whose other one in the next."""
    for k in (20, 33, 50):
        for cycle in ([0, 1], [0, 1, 1], [0, 0, 1, 0, 2]):
            words = [7, *(cycle * k + cycle[:1]) * 2, 8]
            found = runs_in(np.array([*words, -1]), np.array([len(words) + 1]))
            expected = brute_force(words)
            assert max(q for _, _, q in expected) >= 32
            assert [tuple(r) for r in found.tolist()] == expected


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for row in rows:
        words = planted(row.doc_id, WORDS.findall(row.text or ""))
        runs = brute_force(words)
        dropped = {i for a, length, q in runs for i in range(a + q, a + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        expected[row.doc_id] = (
            len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{a},{length},{q}\n" for a, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
        )
    found = llm.op13_periodic_runs(spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected
    assert sum(r.period is not None and r.period >= 32 for r in found) > 5


def test_odd_texts(spark):
    cycle = " ".join(f"w{i}" for i in range(50))
    rows = [
        (1, None, 1), (1, "", 1), (2, " \t\r\n\x0b\x0c ", 2), (3, "a " * 12, 3), (3, "a " * 12, 3),
        (4, "a " * 11, 4), (None, f"x {cycle}\n{cycle}\t{cycle} y", 5),
        (5, "a\xa0b " * 12, 6), (6, "b " * 200_000 + "x", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = {
        (r.doc_id, r.text): ([tuple(x) for x in r.runs], r.collapsed)
        for r in periodic_runs(docs.repartition(2), words_at_once=100).collect()
    }
    assert found == {
        (1, None): ([], ""), (1, ""): ([], ""), (2, rows[2][1]): ([], ""),
        (3, rows[3][1]): ([(0, 12, 1)], "a"), (4, rows[5][1]): ([], " ".join("a" * 11)),
        (None, rows[6][1]): ([(1, 150, 50)], f"x {cycle} y"),
        (5, rows[7][1]): ([(0, 12, 1)], "a\xa0b"), (6, rows[8][1]): ([(0, 200_000, 1)], "b x"),
    }
    assert periodic_runs(docs).count() == len(rows)
    assert periodic_runs(docs.limit(0)).collect() == []


def test_made_periodic_as_defined(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 23))) for i in range(300)] + [(None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in docs.withColumn("made", llm._made_periodic()).collect():
        assert row.made.split() == planted(row.doc_id, row.text.split())
    assert docs.filter(F.col("doc_id").isNull()).select(llm._made_periodic()).first()[0] == "a b"
