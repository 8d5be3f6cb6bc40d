from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from dewpoint.llm import topk


def pair(q, x):
    return SimpleNamespace(
        q_parts=q.tobytes(), q_n=len(q), q_width=q.shape[1], parts=x.tobytes(), n=len(x),
        width=x.shape[1], q_ids=np.arange(len(q)).tobytes(), q_block=0,
        ids=np.arange(1000, 1000 + len(x)).tobytes(), given=np.ones(len(x), bool).tobytes(),
    )


def test_only_collected_rows_are_completed(monkeypatch):
    """In both phases: the local lists, then the rows that reach their share of the cutoff."""
    draw = np.random.default_rng(1)
    q, x = (draw.integers(-300, 300, (n, 32)) for n in (20, 4_000))
    completed = []
    whole = topk._completed
    monkeypatch.setattr(topk, "_completed", lambda *a: completed.append(len(a[2])) or whole(*a))
    first = topk._gather(pair(q, x), 5, 2, None)
    assert len(first) == completed[0] <= 20 * 2 * 6
    cut = first.groupby("query_no")["score"].apply(lambda s: sorted(s)[-5])
    cutoffs = [{"query_no": i, "score": c} for i, c in cut.items()]
    second = topk._gather(pair(q, x), 5, 2, cutoffs)
    assert len(second) <= completed[1] < 20 * 4_000 / 8
    exact = q @ x.T
    for i in range(20):
        best = np.sort(exact[i])[-5:]
        found = sorted(int(s) for s in second[second["query_no"] == i]["score"])
        assert found[-5:] == best.tolist()


def test_many_blocks_equal_brute_force(spark):
    draw = np.random.default_rng(2)
    x = draw.integers(-2**20, 2**20, (700, 9))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[3].tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    found = topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), block_rows=40, query_rows=4)
    exact = x @ x.T
    expected = set()
    for i in range(0, 700, 50):
        scored = [(-int(exact[i, j]), j is None, j) for j in range(700) if j != i]
        scored.append((-int(exact[i, 3]), True, 10**9))
        for rank, (score, _, j) in enumerate(sorted(scored)[:5], 1):
            expected.add((i, rank, None if j == 10**9 else j, -score))
    assert {tuple(r) for r in found.collect()} == expected


def test_no_task_gets_all_matrices(spark):
    """The one window over all blocks sees their numbers only."""
    vectors = spark.range(100).select(F.col("id").alias("vec_id"), F.array("id").alias("vector"))
    packed = topk._packed(vectors, 10)
    assert sorted(r.block for r in packed.select("block").collect()) == list(range(packed.count()))
