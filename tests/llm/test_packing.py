import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from dewpoint.llm import queries as llm
from dewpoint.llm.packing import optimal_boundaries, pack_documents

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def least_padding(lengths, buckets):
    """By trying all boundaries."""
    ends = sorted(set(lengths))
    return min(
        sum(min(b for b in (*chosen, ends[-1]) if b >= x) - x for x in lengths)
        for n in range(min(buckets, len(ends)))
        for chosen in combinations(ends[:-1], n)
    )


def check_batches(packed, budget):
    for (_, _), batch in packed.groupby(["bucket", "batch"]):
        assert sorted(batch.place) == list(range(len(batch)))
        assert len(batch) * batch.bucket_length.iloc[0] <= budget or len(batch) == 1
    for _, bucket in packed.groupby("bucket"):
        sizes = bucket.groupby("batch").size()
        assert sorted(sizes.index) == list(range(len(sizes)))
        assert (sizes[sizes.index < sizes.index.max()] == sizes.max()).all()  # only the last is short


def test_long_texts_equal_brute_force(spark):
    """Lengths beyond two thousand words that differ by one, many rows of one length."""
    draw = random.Random(5)
    for buckets in (1, 3, 4):
        near = [4_000 + draw.randrange(6) for _ in range(8)]
        lengths = near + [2_049, 2_050, 9_001, 9_002, 30_000, 0, 0, 7] + [2_051] * 40
        docs = spark.createDataFrame(
            [(i, "w " * n if n else None) for i, n in enumerate(lengths)],
            "doc_id long, text string",
        )
        packed = pack_documents(docs, buckets=buckets, token_budget=20_000).toPandas()
        assert sorted(packed.length) == sorted(lengths)
        assert packed.bucket.nunique() <= buckets
        padding = int((packed.bucket_length - packed.length).sum())
        assert padding == least_padding(lengths, buckets)
        assert (packed.oversize == (packed.length > 20_000)).all()
        check_batches(packed, 20_000)


def test_query_equals_a_plain_version(spark):
    """op2 over the whole table: lengths counted in Python, the least padding by a plain
    quadratic programme."""
    packed = llm.queries()["op2_packing"](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs)
    assert sorted(zip(packed.doc_id, packed.length)) == expected
    lengths = np.array([n for _, n in expected])
    ends, rows = np.unique(lengths, return_counts=True)
    best = np.array([0.0] + [np.inf] * len(ends))
    for _ in range(packed.bucket.nunique()):
        now = best.copy()
        for j in range(1, len(ends) + 1):
            for i in range(j):
                now[j] = min(now[j], best[i] + ((ends[j - 1] - ends[i:j]) * rows[i:j]).sum())
        best = now
    assert (packed.bucket_length - packed.length).sum() == best[-1]
    check_batches(packed, 65_536)


def test_many_lengths_take_time_in_proportion():
    """A hundred thousand lengths, and the same result as from the cells of equal lengths."""
    lengths = np.arange(1, 100_001)
    bounds = optimal_boundaries(lengths, np.ones_like(lengths), lengths, 4)
    assert bounds == [25_000, 50_000, 75_000, 100_000]


def test_lengths_are_those_of_the_words(spark):
    texts = [None, "", " \t\n", "a", "a\x0bb\x0cc\rd", "   x", "😀 ÿ"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.length for r in pack_documents(docs).select("doc_id", "length").collect()}
    assert found == {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    assert pack_documents(docs.withColumn("bucket", F.lit("x")).limit(0)).count() == 0
