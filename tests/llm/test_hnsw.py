"""The graphs of shards: what is searched, what is compared, and what both find."""

import numpy as np
import pytest

from dewpoint.llm.embeddings import LINK, _linked
from dewpoint.llm.hnsw import Graph, Shard

REACH = float(np.arccos(0.9))


def _shard(draw, vectors, first=0):
    keys = np.array([list((first + i).to_bytes(16, "big")) for i in range(len(vectors))], dtype=np.uint8)
    vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    levels = np.minimum(draw.geometric(15 / 16, len(vectors)) - 1, 4)
    return Shard.build(keys, vectors, np.ones(len(vectors), np.int64), levels, REACH / 2 - 1e-6)


@pytest.mark.parametrize("same", [True, False])
def test_queries_compared_whole_are_searched_only_for_the_audit(same, monkeypatch):
    draw, n, planted = np.random.default_rng(3), 3_000, 150
    x = draw.normal(size=(n, 64))
    partners = x[:planted] + 0.3 * draw.normal(size=(planted, 64))
    if same:
        a = b = _shard(draw, np.vstack([x[planted:], x[:planted], partners]))
    else:
        a, b = _shard(draw, x), _shard(draw, np.vstack([draw.normal(size=(n, 64)), partners]), 10**6)
    work = {"searched": 0, "compared": 0}
    search, exact = Graph.search, Shard._exact

    def searching(self, queries, beam):
        work["searched"] += len(queries)
        return search(self, queries, beam)

    def comparing(self, queries, block, *rest):
        work["compared"] += len(block)
        return exact(self, queries, block, *rest)

    monkeypatch.setattr(Graph, "search", searching)
    monkeypatch.setattr(Shard, "_exact", comparing)
    found = _linked(a, b, same, REACH, 0.9, 32, 64, 0.98)
    queries = len(a.start) - 1
    assert 0 < work["compared"] < queries  # an audit, not a whole comparison
    assert queries <= work["compared"] + work["searched"] <= 1.1 * queries

    true = np.argwhere(a.pivots() @ b.pivots().T >= 0.9)
    true = {(i, j) for i, j in true.tolist() if not same or i < j}
    found = found[found["kind"] == LINK]
    number = {k.tobytes(): i for i, k in enumerate(b.keys[b.start[:-1]])}
    own = {k.tobytes(): i for i, k in enumerate(a.keys[a.start[:-1]])}
    got = {(own[r.a], number[r.b]) for r in found.itertuples()}
    assert len(true) > 100
    assert got <= true and len(got) >= 0.98 * len(true)


def test_a_search_does_not_depend_on_its_batch():
    draw = np.random.default_rng(4)
    graph = _shard(draw, draw.normal(size=(1_500, 16))).graph
    queries = draw.normal(size=(70, 16))
    queries[::7] = graph.vectors[5]
    ids, sims = graph.search(queries, 12)
    for at, query in enumerate(queries):
        alone, near = graph.search(query[None], 12)
        assert alone[0].tolist() == ids[at].tolist()
        assert near[0] == pytest.approx(sims[at], abs=1e-5)
        held = ids[at][ids[at] >= 0]
        assert len(set(held.tolist())) == len(held) == 12
        assert (np.diff(sims[at]) <= 0).all()
        assert graph.vectors[held] @ query == pytest.approx(sims[at], abs=1e-4)
    none = graph.search(queries[:0], 12)
    assert none[0].shape == (0, 12)
