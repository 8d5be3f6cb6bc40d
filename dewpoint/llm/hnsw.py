"""A navigable small-world graph over unit vectors, searched for many queries at once."""

from __future__ import annotations

import io

import numpy as np

BATCH = 256


class Graph:
    """Layers of neighbour lists over the rows of ``vectors``; layer l holds the first rows.

    Rows come by falling level, so each layer begins as a copy of the one above and every
    row is inserted once, into the layer of its level. ``links`` bounds a row's neighbours.
    """

    def __init__(self, width: int, capacity: int, links: int = 24, beam: int = 48):
        self.links, self.beam = links, beam
        self.vectors = np.zeros((capacity, width), dtype=np.float32)
        self.layers: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.n = 0

    def open_layer(self) -> None:
        """Begin the next lower layer."""
        layer = np.full((len(self.vectors), self.links), -1, dtype=np.int32)
        if self.layers:
            self.sizes[-1] = self.n
            self.layers[-1] = self.layers[-1][: self.n]
            layer[: self.n] = self.layers[-1]
        self.layers.append(layer)
        self.sizes.append(self.n)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query the rows (-1: none) and similarities of its beam, best first."""
        queries = queries.astype(np.float32)
        entries = np.zeros((len(queries), 1), dtype=np.int64)
        if not self.n:
            none = np.full((len(queries), beam), -1, dtype=np.int64)
            return none, np.full(none.shape, -np.inf, dtype=np.float32)
        for layer in self.layers[:-1]:
            if len(layer):
                entries, _ = self._walk(layer, queries, entries, 4)
        return self._walk(self.layers[-1], queries, entries, beam)

    def _walk(
        self, layer: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int, step: int = 4
    ) -> tuple[np.ndarray, np.ndarray]:
        """Expands each query's ``step`` best unexpanded rows until its beam is expanded.

        Queries that are done leave the arrays, so that the work shrinks with them.
        """
        n, cells = len(queries), self.n + 1
        step = min(step, beam)
        # Cell 0 of a query stands for no row (-1) and counts as seen.
        seen = np.zeros(n * cells, dtype=bool)
        seen[::cells] = True
        ids = np.full((n, beam), -1, dtype=np.int64)
        sims = np.full((n, beam), -np.inf, dtype=np.float32)
        done = np.zeros((n, beam), dtype=bool)
        end_ids, end_sims = ids.copy(), sims.copy()
        active = np.arange(n)
        fresh = entries
        while active.size:
            new = np.sort(fresh, axis=1)
            cell = new + (active * cells + 1)[:, None]
            known = seen.take(cell)
            known[:, 1:] |= new[:, 1:] == new[:, :-1]
            seen[cell] = True
            rows = self.vectors.take(new, axis=0, mode="clip")
            score = np.matmul(rows, queries[:, :, None])[:, :, 0]
            score[known] = -np.inf
            new[known] = -1
            all_sims = np.concatenate([sims, score], axis=1)
            best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            best += (np.arange(len(best)) * all_sims.shape[1])[:, None]
            sims = all_sims.take(best)
            ids = np.concatenate([ids, new], axis=1).take(best)
            done = np.concatenate([done, np.zeros(new.shape, dtype=bool)], axis=1).take(best)
            waiting = np.where(done | (ids < 0), -np.inf, sims)
            more = np.isfinite(waiting).any(axis=1)
            if not more.all():
                end_ids[active[~more]], end_sims[active[~more]] = ids[~more], sims[~more]
                active, queries, waiting = active[more], queries[more], waiting[more]
                ids, sims, done = ids[more], sims[more], done[more]
                if not active.size:
                    break
            top = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            open_ = np.isfinite(np.take_along_axis(waiting, top, axis=1))
            chosen = np.where(open_, np.take_along_axis(ids, top, axis=1), -1)
            row, column = np.nonzero(open_)
            done[row, top[row, column]] = True
            fresh = np.where(chosen[:, :, None] >= 0, layer[np.maximum(chosen, 0)], -1)
            fresh = fresh.reshape(len(active), -1).astype(np.int64)
        order = np.argsort(-end_sims, axis=1, kind="stable")
        return np.take_along_axis(end_ids, order, axis=1), np.take_along_axis(end_sims, order, axis=1)

    def insert(self, vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Append rows to the open layer, given the beams a search found for them."""
        start, b = self.n, len(vectors)
        vectors = vectors.astype(np.float32)
        self.vectors[start : start + b] = vectors
        among = vectors @ vectors.T
        np.fill_diagonal(among, -np.inf)
        take = min(self.links, b)
        near = np.argpartition(-among, take - 1, axis=1)[:, :take]
        near_sims = np.take_along_axis(among, near, axis=1)
        near_ids = np.where(np.isfinite(near_sims), near + start, -1)
        self.n += b
        candidates = np.concatenate([ids, near_ids], axis=1)
        scores = np.where(candidates >= 0, np.concatenate([sims, near_sims], axis=1), -np.inf)
        layer = self.layers[-1]
        layer[start : start + b] = self._select(candidates, scores)
        self._link_back(layer, np.arange(start, start + b))

    def _select(self, ids: np.ndarray, sims: np.ndarray) -> np.ndarray:
        """Neighbours that are nearer to the row than to each other, then the nearest rest."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        found = self.vectors[np.maximum(ids, 0)]
        between = np.matmul(found, found.transpose(0, 2, 1))
        nearest = np.full(sims.shape, -np.inf, dtype=np.float32)
        taken = np.zeros(ids.shape, dtype=bool)
        count = np.zeros(len(ids), dtype=np.int64)
        for k in range(ids.shape[1]):
            good = (ids[:, k] >= 0) & (nearest[:, k] < sims[:, k]) & (count < self.links)
            taken[:, k] = good
            count += good
            nearest = np.where(good[:, None], np.maximum(nearest, between[:, k]), nearest)
        # Chosen ones first, then the rest by nearness, cut to the bound.
        rank = np.where(taken, 0, np.where(ids >= 0, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        first = np.argsort(rank, axis=1, kind="stable")[:, : self.links]
        chosen = np.take_along_axis(ids, first, axis=1)
        out = np.full((len(ids), self.links), -1, dtype=np.int32)
        out[:, : chosen.shape[1]] = chosen
        return out

    def _link_back(self, layer: np.ndarray, rows: np.ndarray) -> None:
        target = layer[rows].ravel()
        source = np.repeat(rows, self.links)[target >= 0]
        target = target[target >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        at, first, count = np.unique(target, return_index=True, return_counts=True)
        most = int(count.max(initial=0))
        if not most:
            return
        # Rows of many newcomers are few; taking all by their number keeps arrays small.
        for low, high in ((1, 8), (9, 64), (65, most)):
            part = (count >= low) & (count <= high)
            if part.any():
                self._merge(layer, at[part], first[part], count[part], source)

    def _merge(self, layer, at, first, count, source) -> None:
        wide = int(count.max())
        place = np.arange(wide)[None, :]
        new = np.where(
            place < count[:, None], source[np.minimum(first[:, None] + place, len(source) - 1)], -1
        )
        # A newcomer may be linked already if both chose each other.
        known = (new[:, :, None] == layer[at][:, None, :]).any(axis=2)
        new = np.where(known, -1, new)
        both = np.concatenate([layer[at], new], axis=1)
        full = (both >= 0).sum(axis=1) > self.links
        if (~full).any():
            order = np.argsort(both[~full] < 0, axis=1, kind="stable")[:, : self.links]
            layer[at[~full]] = np.take_along_axis(both[~full], order, axis=1)
        crowded = at[full]
        for start in range(0, len(crowded), 512):
            rows = crowded[start : start + 512]
            ids = both[full][start : start + 512]
            sims = np.matmul(self.vectors[np.maximum(ids, 0)], self.vectors[rows][:, :, None])
            sims = np.where(ids >= 0, sims[:, :, 0], -np.inf)
            layer[rows] = self._select(ids, sims)

    def close(self) -> None:
        self.sizes[-1] = self.n
        self.layers[-1] = self.layers[-1][: self.n]
        self.vectors = self.vectors[: self.n]


class Shard:
    """Vectors grouped into balls around pivots, and a graph over the pivots.

    A vector within ``radius`` (an angle) of a pivot joins its ball, so that a dense group
    is one graph row; with twice the radius within the linking angle, all vectors of a
    ball link with each other. Rows are sorted by ball, pivots first; ball b is
    ``start[b]:start[b + 1]`` and reaches as far as ``reach[b]``.
    """

    FIELDS = ("keys", "vectors", "weights", "start", "reach")

    @classmethod
    def build(
        cls, keys: np.ndarray, vectors: np.ndarray, weights: np.ndarray, levels: np.ndarray,
        radius: float,
    ) -> Shard:
        order = np.lexsort((np.arange(len(keys)), -levels))
        keys, vectors, weights, levels = keys[order], vectors[order], weights[order], levels[order]
        graph = Graph(vectors.shape[1], len(vectors))
        pivots: list[int] = []
        ball = np.full(len(vectors), -1, dtype=np.int64)
        least = np.cos(radius)
        for level in range(int(levels.max(initial=0)), -1, -1):
            graph.open_layer()
            rows = np.flatnonzero(levels == level)
            for begin in range(0, len(rows), BATCH):
                part = rows[begin : begin + BATCH]
                ids, sims = graph.search(vectors[part], graph.beam)
                new = cls._assign(vectors, part, ids, pivots, ball, least)
                if len(new):
                    graph.insert(vectors[part[new]], ids[new], sims[new])
        graph.close()
        self = cls()
        by_ball = np.lexsort((np.arange(len(ball)), ball))
        self.graph = graph
        self.keys, self.weights = keys[by_ball], weights[by_ball]
        self.vectors = vectors[by_ball]
        self.start = np.searchsorted(ball[by_ball], np.arange(len(pivots) + 1))
        # A pivot is the first of its ball: it came before its members.
        owner = np.repeat(np.arange(len(pivots)), np.diff(self.start))
        cosine = np.einsum("ij,ij->i", self.vectors, self.vectors[self.start[:-1]][owner])
        angle = np.arccos(np.clip(cosine, -1, 1))
        angle[self.start[:-1]] = 0
        self.reach = np.maximum.reduceat(angle, self.start[:-1]) if len(pivots) else angle
        return self

    @staticmethod
    def _assign(vectors, part, ids, pivots, ball, least) -> np.ndarray:
        """Sends a batch to balls found or founded; returns the founders' places in it."""
        at = np.array(pivots, dtype=np.int64)
        founders: list[int] = []
        among = vectors[part] @ vectors[part].T
        if len(at):
            found = at[np.maximum(ids[:, 0], 0)]
            nearest = np.einsum("ij,ij->i", vectors[part], vectors[found])
            nearest[ids[:, 0] < 0] = -2
        else:
            nearest = np.full(len(part), -2.0)
        for place, row in enumerate(part):
            own = among[place, founders] if founders else np.zeros(0)
            best = int(own.argmax()) if len(own) else -1
            if nearest[place] >= least and (best < 0 or nearest[place] >= own[best]):
                ball[row] = ids[place, 0]
            elif best >= 0 and own[best] >= least:
                ball[row] = ball[part[founders[best]]]
            else:
                ball[row] = len(pivots)
                pivots.append(int(row))
                founders.append(place)
        return np.array(founders, dtype=np.int64)

    def pivots(self) -> np.ndarray:
        return self.vectors[self.start[:-1]]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        arrays = {name: getattr(self, name) for name in self.FIELDS}
        layers = {f"layer{k}": layer for k, layer in enumerate(self.graph.layers)}
        np.savez(out, **arrays, **layers)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        self = cls()
        with np.load(io.BytesIO(data)) as arrays:
            for name in cls.FIELDS:
                setattr(self, name, arrays[name])
            layers = [arrays[f"layer{k}"] for k in range(len(arrays.files) - len(cls.FIELDS))]
        graph = Graph(self.vectors.shape[1], 0)
        graph.vectors = self.pivots().astype(np.float32)
        graph.n, graph.layers = len(graph.vectors), layers
        self.graph = graph
        return self

    def within(
        self,
        queries: np.ndarray,
        reach: float,
        spread: np.ndarray,
        same: bool,
        beam: int,
        audit: int,
        recall: float,
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, ball) pairs that may link: angles up to ``reach`` and both spreads.

        ``same`` says that the queries are this shard's own pivots; pairs then come once,
        the smaller first, and no query is its own partner. A beam whose rows are all
        similar enough is doubled, since more may lie behind it. Before that queries in a
        fixed shuffled order are compared with every pivot, in blocks, until ``audit`` of
        them have a partner. If less than ``recall`` of these pairs, or of the pairs of a
        query on average, was found, all beams are doubled again. Of the queries compared
        only those with a partner are searched as well, to tell the beam that passes; it
        then serves all others. Where all queries had to be compared, or a beam would hold
        the whole graph, the pairs are those compared.
        """
        n = self.graph.n
        far = reach + spread + self.reach.max(initial=0)
        least = np.where(far < np.pi, np.cos(np.minimum(far, np.pi)), -1.0)
        order = np.random.default_rng(0).permutation(len(queries))
        checked, partnered, pairs = 0, 0, []
        while checked < len(order) and partnered < audit:
            block = order[checked : checked + BATCH]
            pairs.append(self._exact(queries, block, reach, spread, least, same))
            partnered += len(np.unique(pairs[-1][0]))
            checked += len(block)
        if checked < len(order):
            asked, partner = (np.concatenate(part) for part in zip(*pairs, strict=True))
            true = self._coded(asked, partner, same)
            _, owner = np.unique(asked, return_inverse=True)
            # Within a shard a pair may be found from either end.
            judged = np.union1d(asked, partner if same else asked)
            others = np.setdiff1d(order[checked:], judged)
            while beam < n:
                found = self._coded(*self._range(queries, least, beam, judged), same)
                got = np.isin(true, found)
                per_query = np.bincount(owner, got) / np.bincount(owner)
                if min(got.mean(), per_query.mean()) >= recall:
                    rest = self._coded(*self._range(queries, least, beam, others), same)
                    codes = np.unique(np.concatenate([found, rest, true]))
                    return codes // n, codes % n
                beam *= 2
            for begin in range(checked, len(order), BATCH):
                block = order[begin : begin + BATCH]
                pairs.append(self._exact(queries, block, reach, spread, least, same))
        if not pairs:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        codes = np.unique(
            self._coded(*(np.concatenate(part) for part in zip(*pairs, strict=True)), same)
        )
        return codes // n, codes % n

    def _coded(self, query: np.ndarray, ball: np.ndarray, same: bool) -> np.ndarray:
        """A number per pair; within a shard both directions have one, own rows are left out."""
        if same:
            other = query != ball
            query, ball = query[other], ball[other]
            query, ball = np.minimum(query, ball), np.maximum(query, ball)
        return query.astype(np.int64) * self.graph.n + ball

    def _exact(self, queries, block, reach, spread, least, same):
        """The pairs of some queries by comparison with every pivot."""
        sims = queries[block].astype(np.float32) @ self.graph.vectors.T
        row, ball = np.nonzero(sims >= least[block][:, None] - 1e-5)
        far = np.minimum(reach + spread[block[row]] + self.reach[ball], np.pi)
        near = sims[row, ball] >= np.cos(far) - 1e-5
        if same:
            near &= block[row] != ball
        return block[row[near]], ball[near]

    def _range(self, queries, least, beam, open_) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of the queries numbered ``open_`` that beams of the graph hold."""
        out_query, out_ball = [open_[:0]], [open_[:0]]
        while open_.size:
            width = min(beam, self.graph.n)
            again = []
            block = max(16, BATCH * 48 // max(width, 48))
            for begin in range(0, len(open_), block):
                part = open_[begin : begin + block]
                ids, sims = self.graph.search(queries[part], width)
                # Single precision may err by 1e-6; what lies near the limit stays in.
                good = (ids >= 0) & (sims >= least[part][:, None] - 1e-5)
                full = good.all(axis=1) & (width < self.graph.n)
                again.append(part[full])
                row, column = np.nonzero(good & ~full[:, None])
                out_query.append(part[row])
                out_ball.append(ids[row, column])
            open_ = np.concatenate(again)
            beam *= 2
        return np.concatenate(out_query), np.concatenate(out_ball)
