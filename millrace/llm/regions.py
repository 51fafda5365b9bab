"""Regions of unit vectors: where a vector is at home and which other regions it has to ask."""

from __future__ import annotations

import numpy as np

from millrace.llm.hnsw import BASE_LINKS, Graph

WALK_BYTES = 4 << 20
ASKED_BEAM = 16


def spread(vectors: np.ndarray, count: int, apart: float) -> np.ndarray:
    """Places of up to ``count`` vectors, from the first on, of which no two have a cosine of ``apart`` or more."""
    chosen: list[int] = []
    for low in range(0, len(vectors), 256):
        if len(chosen) >= count:
            break
        some = vectors[low : low + 256]
        free = (some @ vectors[chosen].T < apart).all(axis=1) if chosen else np.ones(len(some), dtype=bool)
        beside = some @ some.T
        for k in np.flatnonzero(free):
            if free[k]:
                chosen.append(low + int(k))
                free &= beside[k] < apart
    return np.array(chosen[:count], dtype=np.int64)


class Regions:
    """Every vector is at home in the region of its nearest centre.

    Let a vector be nearer to its own centre ``c`` than to another one ``d`` by ``gap``, the
    difference of both cosines. It asks the region of ``d`` if ``gap`` is up to ``reach`` times
    ``sqrt(2 - 2 * least) / 2 * |c - d|``. Of two vectors with a cosine of ``least`` or more and
    homes ``c`` and ``d`` the gaps add up to twice that product without ``reach`` at most, so with
    a ``reach`` of 1 one of the two asks the other's region. The smaller it is, the more pairs near
    ``least`` are missed.

    Centres are found by a walk through a small-world graph of them that keeps the ``beam``
    nearest. Where such a walk would meet all of them, as it reads the links of ``beam`` nodes, all
    are compared without it. What is decided about a vector does not depend on the others of its
    batch, so that copies of a vector are dealt alike.
    """

    def __init__(self, centres: np.ndarray, least: float, beam: int, reach: float = 1.0):
        self.centres, self.beam, self.reach = centres, beam, reach
        self.half = np.sqrt(max(0.0, 2 - 2 * least)) / 2
        self.single = centres.astype(np.float32)
        self.graph = Graph.build(centres) if len(centres) > beam * BASE_LINKS else None

    @classmethod
    def fitted(cls, centres: np.ndarray, sample: np.ndarray, least: float, beam: int) -> Regions:
        """Regions with the reach at which the vectors of a sample have ``beam / ASKED_BEAM`` regions on
        average, their own included, or with 1 if that is less."""
        regions = cls(centres, least, beam)
        row, _, _, needed = regions._near(sample)
        more = round((beam / ASKED_BEAM - 1) * len(sample))
        needed = np.sort(needed[needed >= 0])
        regions.reach = float(needed[max(more, 0)]) if more < len(needed) else 1.0
        return regions

    def asked(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(home of each vector, rows, regions)``: a pair for each other region that a vector asks."""
        row, centre, home, needed = self._near(unit)
        own = np.empty(len(unit), dtype=np.int64)
        own[row[needed < 0]] = home[needed < 0]
        go = needed >= 0
        return own, row[go], centre[go]

    def _near(self, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(row, centre, home, reach needed)``, by row; -1 is needed for the home itself."""
        step = max(1, WALK_BYTES // (4 * len(self.centres)))
        if self.graph:
            step = max(1, min(512, WALK_BYTES // max(2 * len(self.centres), 512 * self.beam)))
        parts = [self._near_some(low, unit[low : low + step]) for low in range(0, len(unit), step)]
        return tuple(np.concatenate(part) for part in zip(*parts, strict=True))

    def _near_some(self, low: int, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        single = unit.astype(np.float32)
        if self.graph:
            ids, sims = self.graph.nearest(single, self.beam)
        else:
            sims = single @ self.single.T
            ids = np.broadcast_to(np.arange(len(self.centres)), sims.shape)
        # Nothing is decided in single precision; no two centres are further apart than 2.
        r, k = np.nonzero(sims >= sims.max(axis=1, keepdims=True) - (2 * self.half * self.reach + 1e-3))
        centre = ids[r, k]
        sim = np.einsum("fd,fd->f", unit[r], self.centres[centre])
        order = np.lexsort((centre, -sim, r))
        r, centre, sim = r[order], centre[order], sim[order]
        first = np.searchsorted(r, np.arange(len(unit)))
        home = centre[first][r]
        apart = self.centres[home] - self.centres[centre]
        apart = np.sqrt(np.einsum("fd,fd->f", apart, apart))
        room = self.half * apart
        needed = np.where(room > 0, (sim[first][r] - sim) / np.where(room > 0, room, 1), 0.0)
        needed[first] = -1
        keep = needed <= self.reach + 1e-9
        return r[keep] + low, centre[keep].astype(np.int64), home[keep].astype(np.int64), needed[keep]
