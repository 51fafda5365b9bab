"""A hierarchical navigable small-world graph that is built and searched many nodes at a time.

Nodes are unit vectors, ordered so that those of higher layers come first: layer ``l``
holds the first ``sizes[l]`` nodes. Every array step works on a whole batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LINKS, BASE_LINKS = 12, 24
BUILD_BEAM, RECONNECT = 48, 8
BATCH, EXPAND = 256, 4
WALKERS, OPENED = 256, 4096
VISITED_BYTES = 64 << 20


def _layer_sizes(count: int) -> list[int]:
    sizes = [count]
    while sizes[-1] > 64:
        sizes.append(max(1, sizes[-1] // LINKS))
    return sizes


def _search(x: np.ndarray, links: np.ndarray, q: np.ndarray, entries: np.ndarray, beam: int, limit: int):
    """The ``beam`` nearest nodes below ``limit`` that walks from ``entries`` find for each query.

    In each round every query opens its ``EXPAND`` nearest unopened nodes; it ends when
    all nodes of its beam are open. Returns ids (-1 where fewer) and similarities, unordered.
    """
    count = len(q)
    rows = np.arange(count)
    stamp = np.zeros((count, limit), dtype=np.uint16)
    ids = np.full((count, beam), -1, dtype=np.int32)
    sims = np.full((count, beam), -np.inf, dtype=np.float32)
    opened = np.ones((count, beam), dtype=bool)
    entries = entries[:, : min(entries.shape[1], beam)]
    valid = entries >= 0
    r, c = np.nonzero(valid)
    stamp[r, entries[r, c]] = c + 1
    valid[r, c] = stamp[r, entries[r, c]] == c + 1
    r, c = np.nonzero(valid)
    ids[r, c] = entries[r, c]
    sims[r, c] = np.einsum("fd,fd->f", x[entries[r, c]], q[r])
    opened[r, c] = False
    active = rows
    while len(active):
        ahead = np.where(opened[active], -np.inf, sims[active])
        pick = np.argpartition(-ahead, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND] if beam > 1 else np.zeros((len(active), 1), int)
        usable = np.take_along_axis(ahead, pick, 1) > -np.inf
        go = usable.any(axis=1)
        active, pick, usable = active[go], pick[go], usable[go]
        if not len(active):
            break
        picked = ids[active[:, None], pick]
        r, c = np.nonzero(usable)
        opened[active[r], pick[r, c]] = True
        near = links[picked]
        near[~usable] = -1
        near = near.reshape(len(active), -1)
        near[near >= limit] = -1
        r, c = np.nonzero(near >= 0)
        node = near[r, c]
        new = stamp[active[r], node] == 0
        r, c, node = r[new], c[new], node[new]
        stamp[active[r], node] = (c + 1).astype(np.uint16)
        first = stamp[active[r], node] == c + 1
        r, c, node = r[first], c[first], node[first]
        fresh_ids = np.full(near.shape, -1, dtype=np.int32)
        fresh = np.full(near.shape, -np.inf, dtype=np.float32)
        fresh_ids[r, c] = node
        fresh[r, c] = np.einsum("fd,fd->f", x[node], q[active[r]])
        all_sims = np.concatenate([sims[active], fresh], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        sims[active] = np.take_along_axis(all_sims, top, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], fresh_ids], axis=1), top, 1)
        shut = np.concatenate([opened[active], fresh_ids < 0], axis=1)
        opened[active] = np.take_along_axis(shut, top, 1)
    return ids, sims


def _choose(x: np.ndarray, base: np.ndarray, found: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` of the candidates of each node: those nearer to it than to any chosen
    before them, then the nearest of the rest, so that clusters stay tied to what surrounds them."""
    chosen = np.full((len(base), links), -1, dtype=np.int32)
    for low in range(0, len(base), 512):
        own = slice(low, low + 512)
        cand = found[own]
        vectors = x[cand]
        sims = np.einsum("acd,ad->ac", vectors, x[base[own]])
        sims[(cand < 0) | (cand == base[own][:, None])] = -np.inf
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        vectors = np.take_along_axis(vectors, order[:, :, None], 1)
        between = vectors @ vectors.transpose(0, 2, 1)
        valid = sims > -np.inf
        taken = np.zeros(cand.shape, dtype=bool)
        count = np.zeros(len(cand), dtype=np.int64)
        for j in range(cand.shape[1]):
            near = (taken[:, :j] & (between[:, j, :j] > sims[:, j, None])).any(axis=1)
            ok = valid[:, j] & ~near & (count < links)
            taken[:, j] = ok
            count += ok
        rest = valid & ~taken
        taken |= rest & (np.cumsum(rest, axis=1) <= (links - count)[:, None])
        order = np.argsort(~taken, axis=1, kind="stable")[:, :links]
        picked = np.where(np.take_along_axis(taken, order, 1), np.take_along_axis(cand, order, 1), -1)
        chosen[own, : picked.shape[1]] = picked
    return chosen


def _link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Link the neighbours of new nodes with them; full lists are chosen anew."""
    r, c = np.nonzero(links[new] >= 0)
    node, other = links[new][r, c], new[r]
    order = np.argsort(node, kind="stable")
    node, other = node[order], other[order]
    width = links.shape[1]
    while len(node):
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        place = np.arange(len(node)) - np.repeat(first, np.diff(np.concatenate([first, [len(node)]])))
        now = place < width
        at, group = np.unique(node[now], return_inverse=True)
        more = np.full((len(at), width), -1, dtype=np.int32)
        more[group, place[now]] = other[now]
        known = (links[at][:, :, None] == more[:, None, :]).any(axis=1)
        more[known] = -1
        both = np.concatenate([links[at], more], axis=1)
        fits = (both >= 0).sum(axis=1) <= width
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :width]
        links[at[fits]] = packed[fits]
        if not fits.all():
            links[at[~fits]] = _choose(x, at[~fits], both[~fits], width)
        node, other = node[~now], other[~now]


class Graph:
    """Unit vectors ``x`` with the links of every layer, lowest first."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray]):
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        """Vectors must come in random order: the first of them make up the higher layers."""
        x = np.ascontiguousarray(x, dtype=np.float32)
        sizes = _layer_sizes(len(x))
        graph = cls(x, [np.empty((0, 0), np.int32)] * len(sizes))
        for layer in range(len(sizes) - 1, -1, -1):
            above = sizes[layer + 1] if layer + 1 < len(sizes) else sizes[layer]
            links = np.full((sizes[layer], BASE_LINKS if layer == 0 else LINKS), -1, dtype=np.int32)
            graph.layers[layer] = links
            low = 0
            while low < sizes[layer]:
                high = min(low + BATCH, sizes[layer], above if low < above else sizes[layer])
                graph._insert(layer, low, high, direct=low < above)
                low = high
            graph.layers[layer] = graph._reconnect(links)
        return graph

    def _reconnect(self, links: np.ndarray) -> np.ndarray:
        """Make every node reachable from the first one.

        A tight cluster can fill its lists with its own members while all others prune
        theirs, so that no walk comes in. Such a cluster gets links from its nearest
        reachable nodes, in further columns where the lists are full.
        """
        size = len(links)
        reached = np.zeros(size, dtype=bool)
        ahead = np.zeros(1, dtype=np.int64)
        while True:
            while len(ahead):
                reached[ahead] = True
                ahead = np.unique(links[ahead])
                ahead = ahead[ahead >= 0]
                ahead = ahead[~reached[ahead]]
            if reached.all():
                return links
            lost = int(np.argmin(reached))
            known = np.flatnonzero(reached)
            near = self.x[known] @ self.x[lost]
            for node in known[np.argsort(-near, kind="stable")[:RECONNECT]]:
                free = np.flatnonzero(links[node] < 0)
                if not len(free):
                    links = np.concatenate([links, np.full((size, 1), -1, np.int32)], axis=1)
                    free = [links.shape[1] - 1]
                links[node, free[0]] = lost
            ahead = np.array([lost])

    def _insert(self, layer: int, low: int, high: int, direct: bool) -> None:
        x, links = self.x, self.layers[layer]
        new = np.arange(low, high, dtype=np.int32)
        if direct:
            sims = x[low:high] @ x[:high].T
            keep = min(BUILD_BEAM, high)
            found = np.argpartition(-sims, keep - 1, axis=1)[:, :keep].astype(np.int32)
        else:
            entries = self._descend(x[low:high], layer, BUILD_BEAM // 2)
            found, _ = _search(x, links, x[low:high], entries, BUILD_BEAM, low)
            beside = x[low:high] @ x[low:high].T
            keep = min(16, high - low)
            near = np.argpartition(-beside, keep - 1, axis=1)[:, :keep].astype(np.int32) + low
            found = np.concatenate([found, near.astype(np.int32)], axis=1)
        links[low:high] = _choose(x, new, found, links.shape[1])
        _link_back(x, links, new)

    def _descend(self, q: np.ndarray, layer: int, beam: int) -> np.ndarray:
        """Entries into a layer: the nearest nodes that a beam finds in the layers above it."""
        entries = np.zeros((len(q), 1), dtype=np.int32)
        for above in range(len(self.layers) - 1, layer, -1):
            links = self.layers[above]
            entries, _ = _search(self.x, links, q, entries, min(beam, len(links)), len(links))
        return entries

    def nearest(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the ``beam`` nearest nodes that a walk finds for each query, unordered."""
        entries = self._descend(q, 0, max(8, beam // 2))
        return _search(self.x, self.layers[0], q, entries, beam, len(self.x))

    def within(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of ``blocks`` at once, as ``(query, node)``."""
        queries, nodes = [], []
        for row, node, _ in self.blocks(q, least, beam):
            queries.append(row)
            nodes.append(node)
        return np.concatenate([*queries, np.empty(0, int)]), np.concatenate([*nodes, np.empty(0, int)])

    def blocks(self, q: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs ``(query, node, similarity)`` of ``least`` or more, no pair twice, a block at a time.

        A beam finds where the near nodes of a query lie. Queries whose whole beam is near
        walk on from there, in batches of neighbours.
        """
        q = np.ascontiguousarray(q, dtype=np.float32)
        size = len(self.x)
        beam = min(beam, size)
        step = max(1, min(512, VISITED_BYTES // max(size, beam * 64)))
        full, seeds = [np.empty(0, int)], [np.empty((0, beam), np.int32)]
        for low in range(0, len(q), step):
            own = np.arange(low, min(low + step, len(q)))
            entries = self._descend(q[own], 0, max(8, beam // 2))
            ids, sims = _search(self.x, self.layers[0], q[own], entries, beam, size)
            near = (sims >= least) & (ids >= 0)
            more = near.all(axis=1) & (beam < size)
            r, c = np.nonzero(near & ~more[:, None])
            yield own[r], ids[r, c], sims[r, c]
            full.append(own[more])
            seeds.append(ids[more])
        hot, starts = np.concatenate(full), np.concatenate(seeds)
        if not len(hot):
            return
        order = np.argsort(starts.min(axis=1), kind="stable")
        behind = self._backward()
        for low in range(0, len(order), WALKERS):
            some = order[low : low + WALKERS]
            yield from self._walk(hot[some], q[hot[some]], np.unique(starts[some]), behind, least)

    def _backward(self) -> tuple[np.ndarray, np.ndarray]:
        """The links of the lowest layer turned round: nodes that link to node ``n`` are ``[end[n], end[n + 1])``."""
        links = self.layers[0]
        source, column = np.nonzero(links >= 0)
        target = links[source, column]
        end = np.concatenate([[0], np.cumsum(np.bincount(target, minlength=len(links)))])
        return source[np.argsort(target, kind="stable")], end

    def _walk(self, own: np.ndarray, q: np.ndarray, ahead: np.ndarray, behind: tuple[np.ndarray, np.ndarray], least: float):
        """Opens every node that is near to one of the queries, and no other, each once for all of them.

        Links are followed both ways: a node whose own neighbours all dropped it is met too.
        """
        source, end = behind
        seen = np.zeros(len(self.x), dtype=bool)
        seen[ahead] = True
        while len(ahead):
            opened = []
            for low in range(0, len(ahead), OPENED):
                some = ahead[low : low + OPENED]
                sims = q @ self.x[some].T
                near = sims >= least
                r, c = np.nonzero(near)
                yield own[r], some[c], sims[r, c]
                opened.append(some[near.any(axis=0)])
            hits = np.concatenate(opened)
            counts = end[hits + 1] - end[hits]
            back = np.repeat(end[hits] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            ahead = np.unique(np.concatenate([self.layers[0][hits].ravel(), source[back]]))
            ahead = ahead[ahead >= 0]
            ahead = ahead[~seen[ahead]]
            seen[ahead] = True
