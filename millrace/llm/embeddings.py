"""Near-duplicate vectors: regions around centres met by a small-world graph, verified cosine, components."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from millrace.llm.components import components
from millrace.llm.regions import Regions, spread
from millrace.session import session_conf, written

SHARDS, REGION_ROWS = 8, 24_576
# Of the vectors that a task holds, and of a batch that it hands on; pairs that it compares, at 64 numbers each.
BLOCK_BYTES, BATCH_BYTES, TASK_PAIRS = 16 << 20, 2 << 20, 1 << 32
DRAWN, COUNTED = 4096, 1 << 18
AUDIT_BLOCK = 512
# Queries and members of a tile; the share of near pairs, one in so many, from which no list of them is
# made, and from which bounds of them are not worth their while.
TILE, DENSE, VAGUE = (512, 2048), 16, 256
DEALT = "slot long, rank int, node long, size long, home int, asking boolean, asks binary, vector binary"

log = logging.getLogger(__name__)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks if len(c)])
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("nd,nd->n", scaled, scaled))[:, None]


class _Forest:
    """Of pairs that come in blocks, few more than those that keep what they link together."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
        self.left, self.right = at[: len(left)], at[len(left) :]
        self.root = np.arange(len(self.ids))
        self.kept: list[tuple[int, int]] = []
        self.own = len(self.ids)

    def guests(self, left: np.ndarray) -> None:
        """A new left list of ids that the right one lacks; parts of the right one stay together.

        A part that has a pair holds an id of the right list, and that one is its root.
        """
        self.ids = np.concatenate([self.ids[: self.own], left])
        self.root = np.concatenate([self.root[: self.own], np.arange(self.own, len(self.ids))])
        self.left = np.arange(self.own, len(self.ids))

    def one(self, left: np.ndarray, right: np.ndarray) -> bool:
        """Whether these places of the two lists are in one part already."""
        roots = np.concatenate([self.root[self.left[left]], self.root[self.right[right]]])
        return bool((roots == roots[:1]).all())

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        """Pairs of places in the two lists. Each round joins every part with another one."""
        u, v = self.left[left], self.right[right]
        if len(u) <= 64:
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                self._join(a, b)
            return
        while True:
            apart = self.root[u] != self.root[v]
            u, v = u[apart], v[apart]
            if not len(u):
                return
            picked = []
            for side in (u, v):
                pick = np.full(len(self.ids), -1)
                pick[side] = np.arange(len(side))
                picked.append(pick[pick >= 0])
            for k in np.unique(np.concatenate(picked)).tolist():
                self._join(u[k], v[k])
            while (self.root != (above := self.root[self.root])).any():
                self.root = above

    def _join(self, a: int, b: int) -> None:
        root, x, y = self.root, a, b
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            self.kept.append((self.ids[a], self.ids[b]))


@dataclass
class _Deal:
    """Where the vectors of one length go: the slots of region ``r`` are ``first[r]`` and on, one for
    each of its blocks and each part of those that ask it."""

    regions: Regions
    first: np.ndarray
    blocks: np.ndarray
    parts: np.ndarray


def _mixed(node: np.ndarray, salt: int) -> np.ndarray:
    """Ids dealt anew, as non-negative numbers below 2**31."""
    x = node.view(np.uint64) + np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(33)).astype(np.int64)


def _by_length(batches):
    """``(length, nodes, sizes, vectors)`` of the distinct vectors of each batch ``(node, vector)``."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column(1)).to_numpy()
        for dim in np.unique(lengths).tolist():
            own = batch if (lengths == dim).all() else batch.filter(pa.array(lengths == dim))
            node, at, size = np.unique(own.column(0).to_numpy(), return_index=True, return_counts=True)
            yield dim, node, size, _matrix(pa.chunked_array([own.column(1)]))[at]


def _counted(regions: dict[int, Regions]):
    """``(dim, region, members, askers)`` of some vectors."""

    def run(batches):
        counts = {dim: np.zeros((2, len(r.centres)), np.int64) for dim, r in regions.items()}
        for dim, _, _, vectors in _by_length(batches):
            home, _, asked = regions[dim].asked(_unit(vectors))
            counts[dim] += [np.bincount(x, minlength=len(regions[dim].centres)) for x in (home, asked)]
        for dim, (members, askers) in counts.items():
            met = np.flatnonzero(members + askers)
            columns = [np.full(len(met), dim, np.int32), met.astype(np.int32), members[met], askers[met]]
            yield pa.record_batch([pa.array(x) for x in columns], names=["dim", "region", "members", "askers"])

    return run


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of bytes, ``counts[i]`` values in row ``i``."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _dealt(deals: dict[int, _Deal]):
    """Vectors to slots, see ``DEALT``: members to their block, once for each part of those that
    ask, and all that ask to each block, in one part."""

    def run(batches):
        for dim, node, size, vectors in _by_length(batches):
            deal = deals[dim]
            home, asker, asked = deal.regions.asked(_unit(vectors))
            asks = np.bincount(asker, minlength=len(node))
            begin = np.cumsum(asks) - asks
            block, part = _mixed(node, 1) % deal.blocks[home], _mixed(node, 2)
            own_part = part % deal.parts[home]
            everyone = np.arange(len(node))

            def rows(row, region, at_block, at_part, rank, asking):
                slot = deal.first[region] + at_block * deal.parts[region] + at_part
                return row, slot, np.full(len(row), rank), np.broadcast_to(asking, len(row))

            row, at_part = _each(everyone, deal.parts[home])
            out = [rows(row, home[row], block[row], at_part, 0, at_part == own_part[row])]
            row, at_block = _each(everyone, deal.blocks[home])
            row, at_block = row[at_block != block[row]], at_block[at_block != block[row]]
            out.append(rows(row, home[row], at_block, own_part[row], 1, True))
            k, at_block = _each(np.arange(len(asker)), deal.blocks[asked])
            out.append(rows(asker[k], asked[k], at_block, (part[asker] % deal.parts[asked])[k], 1, True))
            row, slot, rank, asking = (np.concatenate(x) for x in zip(*out, strict=True))
            step = max(1, BATCH_BYTES // vectors[0].nbytes)
            for low in range(0, len(row), step):
                r, own = row[low : low + step], slice(low, low + step)
                counts = np.where(rank[own] == 0, asks[r], 0)
                k, place = _each(np.arange(len(r)), counts)
                yield pa.record_batch(
                    [
                        pa.array(slot[own], pa.int64()),
                        pa.array(rank[own], pa.int32()),
                        pa.array(node[r]),
                        pa.array(size[r], pa.int64()),
                        pa.array(home[r], pa.int32()),
                        pa.array(asking[own]),
                        _packed(asked[begin[r[k]] + place].astype(np.int32), counts),
                        _packed(vectors[r], np.full(len(r), dim)),
                    ],
                    names=["slot", "rank", "node", "size", "home", "asking", "asks", "vector"],
                )

    return run


def _each(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every value as often as its count says, and the numbers of its repeats from 0."""
    ends = np.cumsum(counts)
    return np.repeat(values, counts), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _bytes(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of rows of bytes, and how many each has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    low, high = int(ends[0]), int(ends[-1])
    values = np.frombuffer(column.buffers()[2].slice(low, high - low), dtype) if low < high else np.empty(0, dtype)
    return values, np.diff(ends) // np.dtype(dtype).itemsize


def _whole_nodes(batches):
    """Sorted rows in batches that no run of one ``(slot, rank, node)`` reaches out of."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.concat_batches([held, batch]) if held is not None else batch
        last = np.ones(batch.num_rows, dtype=bool)
        for name in ("slot", "rank", "node"):
            values = batch.column(name).to_numpy()
            last &= values == values[-1]
        cut = int(np.argmax(last))
        held = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if held is not None:
        yield held


def _places(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few that are true."""
    rows = np.flatnonzero(near.any(axis=1))
    r, c = np.nonzero(near[rows])
    return rows[r], c


class _Block:
    """Members of a region, all compared with whoever asks; counts of members and a forest of links.

    Similarities are found in single precision; pairs that its rounding leaves in doubt are
    decided in double precision, the others by themselves. No more than a tile of pairs is held.
    Most tiles have no near pair, which half of the numbers are enough to see: along the main axes
    of the members, with the length of what is left over, they give a bound.
    """

    def __init__(self, least: float, pieces: list[dict]):
        self.least = least
        self.node, self.size, self.home, self.asking, self.asks, self.counts, self.vectors = (
            np.concatenate([piece[name] for piece in pieces]) for name in ("node", "size", "home", "asking", "asks", "counts", "vectors")
        )
        pieces.clear()
        self.single = np.empty(self.vectors.shape, np.float32)
        for low in range(0, len(self.node), TILE[1]):
            self.single[low : low + TILE[1]] = _unit(self.vectors[low : low + TILE[1]])
        self.doubt = max(1e-4, (self.vectors.shape[1] + 3) * 2.0**-23)
        self.asks_of = np.repeat(np.arange(len(self.node)), self.counts)
        self.codes = np.append(np.sort((self.asks_of << 32) | self.asks), -1)
        self.links, self.linked = np.zeros(len(self.node), np.int64), np.zeros(len(self.node), np.int64)
        self.forest = _Forest(self.node, self.node)
        self.tile = np.empty(TILE[0] * TILE[1], np.float32)
        self.heads, self.clear = None, 8
        length = self.vectors.shape[1]
        if length >= 16 and len(self.node) >= 4 * length:
            some = self.single[:: max(1, len(self.single) // 4096)]
            self.axes = np.linalg.eigh((some.T @ some).astype(np.float64))[1][:, -(length // 2) :].astype(np.float32)
            self.heads = self._headed(self.single)

    def _headed(self, single: np.ndarray) -> np.ndarray:
        head = single @ self.axes
        rest = 1 - np.einsum("nd,nd->n", head, head)
        return np.concatenate([head, np.sqrt(np.maximum(rest, 0) + 1e-6)[:, None]], axis=1)

    def members(self) -> None:
        """The members that ask here; if all do, a pair is looked at once, for both."""
        some = np.flatnonzero(self.asking)
        self.half = len(some) == len(self.node)
        links, linked = self._compare(self.vectors[some], self.size[some], None, some)
        self.links[some] += links
        self.linked[some] += linked

    def guests(self, rows: dict) -> tuple[np.ndarray, np.ndarray]:
        """Links of other vectors. A member that does not ask such a vector's home gets the link as well."""
        self.forest.guests(rows["node"])
        return self._compare(rows["vectors"], rows["size"], rows["home"], np.arange(len(rows["node"])))

    def _compare(self, vectors, size, home, place) -> tuple[np.ndarray, np.ndarray]:
        links, linked = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        for low in range(0, len(place), TILE[0]):
            own = slice(low, low + TILE[0])
            unit = _unit(vectors[own])
            single = unit.astype(np.float32)
            head = self._headed(single) if self.heads is not None else None
            asking = size[own], None if home is None else home[own], place[own]
            start = low // TILE[1] * TILE[1] if home is None and self.half else 0
            for left in range(start, len(self.node), TILE[1]):
                members = slice(left, left + TILE[1])
                pairs = None
                if self.heads is not None:
                    pairs = self._bounded(single, head, members)
                if pairs is None:
                    sims = self._product(single, self.single[members])
                    near = sims >= self.least - self.doubt
                    many = np.count_nonzero(near)
                    if many > near.size // DENSE:
                        counts = self._dense(unit, sims, near, left, *asking)
                        links[own] += counts[0]
                        linked[own] += counts[1]
                        continue
                    r, c = _places(near) if many else (np.empty(0, np.int64),) * 2
                    pairs = r, c, sims[r, c]
                if len(pairs[0]):
                    counts = self._sparse(unit, *pairs, left, *asking)
                    links[own] += counts[0]
                    linked[own] += counts[1]
        return links, linked

    def _product(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.matmul(left, right.T, out=self.tile[: len(left) * len(right)].reshape(len(left), -1))

    def _bounded(self, single, head, members: slice):
        """The pairs of a tile that are near, or nothing if the bounds leave too many."""
        near = self._product(head, self.heads[members]) >= self.least - self.doubt
        many = np.count_nonzero(near)
        if many > near.size // VAGUE:
            self.clear -= 1
            if not self.clear:
                self.heads = None
            return None
        self.clear = min(self.clear + 1, 64)
        r, c = _places(near) if many else (np.empty(0, np.int64),) * 2
        sims = np.einsum("fd,fd->f", single[r], self.single[members][c])
        keep = sims >= self.least - self.doubt
        return r[keep], c[keep], sims[keep]

    def _sure(self, unit: np.ndarray, r: np.ndarray, member: np.ndarray) -> np.ndarray:
        """Pairs decided in double precision."""
        sure = np.empty(len(r), dtype=bool)
        for low in range(0, len(r), 4096):
            some = slice(low, low + 4096)
            sure[some] = np.einsum("fd,fd->f", unit[r[some]], _unit(self.vectors[member[some]])) >= self.least
        return sure

    def _sparse(self, unit, r, c, sims, left, size, home, place):
        member = c + left
        keep = np.ones(len(r), dtype=bool)
        if home is None:
            keep = place[r] < member if self.half else place[r] != member
        unsure = np.flatnonzero(keep & (sims < self.least + self.doubt))
        keep[unsure] = self._sure(unit, r[unsure], member[unsure])
        r, member = r[keep], member[keep]
        if home is None:
            back = np.full(len(r), self.half)
        else:
            code = (member << 32) | home[r]
            known = self.codes[np.searchsorted(self.codes[:-1], code)] == code
            back = ~known & (home[r] != self.home[member])
        if back.any():
            np.add.at(self.links, member[back], 1)
            np.add.at(self.linked, member[back], size[r[back]])
        self.forest.add(place[r], member)
        linked = np.zeros(len(unit), np.int64)
        np.add.at(linked, r, self.size[member])
        return np.bincount(r, minlength=len(unit)), linked

    def _dense(self, unit, sims, near, left, size, home, place):
        """The same for a tile in which many pairs are near: no list of pairs, unless they tie parts together."""
        members = slice(left, left + near.shape[1])
        if home is None:
            other = np.arange(left, members.stop)
            near &= place[:, None] < other if self.half else place[:, None] != other
        r, c = _places(near & (sims < self.least + self.doubt))
        near[r, c] = self._sure(unit, r, c + left)
        back = [(np.arange(len(unit)), near)] if home is None and self.half else []
        for region in np.unique(home).tolist() if home is not None else ():
            free = self.home[members] != region
            asking = self.asks_of[self.asks == region] - left
            free[asking[(asking >= 0) & (asking < len(free))]] = False
            some = np.flatnonzero(home == region)
            back.append((some, near[some] & free))
        for some, linked in back:
            self.links[members] += np.count_nonzero(linked, axis=0)
            self.linked[members] += (size[some].astype(np.float64) @ linked).astype(np.int64)
        row, column = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if len(row) and not self.forest.one(place[row], column + left):
            r, c = np.nonzero(near)
            self.forest.add(place[r], c + left)
        return np.count_nonzero(near, axis=1), (near @ self.size[members].astype(np.float64)).astype(np.int64)


def _found(node, links, linked, edges=()) -> pa.RecordBatch:
    """Rows ``(node, links, vectors linked)`` of nodes that have links, and edges ``(node, other)``."""
    met = np.flatnonzero(links)
    u, v = np.array(edges, dtype=np.int64).reshape(-1, 2).T
    none = np.zeros(len(u), np.int64)
    columns = [
        pa.array(np.concatenate([node[met], u])),
        pa.concat_arrays([pa.nulls(len(met), pa.int64()), pa.array(v)]),
        pa.array(np.concatenate([links[met], none])),
        pa.array(np.concatenate([linked[met], none])),
    ]
    return pa.record_batch(columns, names=["node", "other", "links", "vectors"])


def _answers(least: float, dtype: str):
    """What the members of each slot and those that ask them have in links, see ``_found``.

    Rows come by slot, members first. Copies of a vector, dealt alike, are taken together.
    """

    def run(batches):
        slot, pieces, block = None, [], None

        def ready():
            made = _Block(least, pieces)
            made.members()
            return made

        for batch in _whole_nodes(batches):
            keys = [batch.column(name).to_numpy() for name in ("slot", "rank", "node")]
            new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            first = np.flatnonzero(new)
            size = np.add.reduceat(batch.column("size").to_numpy(), first)
            if len(first) < batch.num_rows:
                batch = batch.take(pa.array(first))
            slots, ranks = keys[0][first], keys[1][first]
            turn = np.flatnonzero(np.concatenate([[True], (slots[1:] != slots[:-1]) | (ranks[1:] != ranks[:-1])]))
            for low, high in zip(turn, np.append(turn[1:], len(first)), strict=True):
                own = batch.slice(low, high - low)
                asks, counts = _bytes(own.column("asks"), np.int32)
                values, width = _bytes(own.column("vector"), dtype)
                rows = {name: own.column(name).to_numpy(zero_copy_only=False).copy() for name in ("node", "home", "asking")}
                rows |= {"size": size[low:high], "asks": asks.astype(np.int64), "counts": counts}
                rows |= {"vectors": values.reshape(-1, width[0]).copy(), "home": rows["home"].astype(np.int64)}
                if slots[low] != slot:
                    block = ready() if pieces else block
                    if block:
                        yield _found(block.node, block.links, block.linked, block.forest.kept)
                    slot, block = slots[low], None
                if ranks[low] == 0:
                    pieces.append(rows)
                    continue
                block = ready() if pieces else block
                if block:
                    yield _found(rows["node"], *block.guests(rows))
        block = ready() if pieces else block
        if block:
            yield _found(block.node, block.links, block.linked, block.forest.kept)

    return run


def _look_up(least: float, beam: int):
    """``(divide, answer)``: regions for centres and a sample of vectors, and what a slot answers."""
    return lambda centres, sample: Regions.fitted(centres, sample, least, beam), lambda dtype: _answers(least, dtype)


def _audit(nodes: np.ndarray, units: np.ndarray, least: float):
    """Exact links of a few vectors with all vectors of a batch that are not equal to them."""
    doubt = max(1e-4, (units.shape[1] + 3) * 2.0**-23)

    def run(batches):
        single = units.astype(np.float32)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            unit = _unit(_matrix(pa.chunked_array([batch.column(1)])))
            other = unit.astype(np.float32).T
            for low in range(0, len(nodes), AUDIT_BLOCK):
                cosine = single[low : low + AUDIT_BLOCK] @ other
                r, c = np.divmod(np.flatnonzero(cosine >= least - doubt), len(own))
                keep = nodes[low + r] != own[c]
                unsure = np.flatnonzero(keep & (cosine[r, c] < least + doubt))
                for start in range(0, len(unsure), 4096):
                    some = unsure[start : start + 4096]
                    keep[some] = np.einsum("fd,fd->f", units[low + r[some]], unit[c[some]]) >= least
                met, links = np.unique(r[keep], return_counts=True)
                if len(met):
                    yield pa.record_batch([pa.array(nodes[low + met]), pa.array(links, pa.int64())], names=["node", "links"])

    return run


def _truth(
    nodes: DataFrame, least: float, hot: int, first: int, linked: int, most: int, keys: DataFrame | None = None
) -> dict[int, int]:
    """Exact link counts of the linked ones among random nodes, each vector equal to a linked one counted.

    ``first`` nodes are drawn, then as many again as there are or as seem to be needed, until
    ``linked`` of them have up to ``hot`` links, ``most`` are drawn or no node is left.
    ``keys``: the nodes and their lengths alone, where that is read at less cost.
    """
    spark = nodes.sparkSession
    truth: dict[int, int] = {}
    order = (nodes if keys is None else keys).select("node", "dim").distinct()
    order = order.orderBy(F.xxhash64("node", F.lit("audit")), "node").limit(most).toArrow()
    picked = F.broadcast(spark.createDataFrame(order.select(["node"])))
    vectors = nodes.join(picked, "node", "left_semi").groupBy("node").agg(F.first("vector").alias("vector")).toArrow()
    order = order.append_column("vector", vectors["vector"].take(pc.index_in(order["node"], vectors["node"])))
    drawn, more = 0, min(first, most)
    while more:
        some = order.slice(drawn, more)
        for dim in some.column("dim").unique().to_pylist():
            own = some.filter(pa.array(some.column("dim").to_numpy() == dim))
            check = _audit(own.column("node").to_numpy(), _unit(_matrix(own.column("vector"))), least)
            exact = nodes.where(F.col("dim") == dim).select("node", "vector").mapInArrow(check, "node long, links long")
            truth |= {r.node: r.links for r in exact.groupBy("node").agg(F.sum("links").alias("links")).collect()}
        drawn += some.num_rows
        few = sum(n <= hot for n in truth.values())
        if some.num_rows < more or few >= linked:
            break
        needed = math.ceil(1.2 * drawn * linked / few) - drawn if few else drawn
        more = min(needed, 3 * drawn, most - drawn)
        if not more:
            log.warning("the audit drew %d vectors, of which %d have 1 to %d links", drawn, few, hot)
    return truth


def _recall(truth: dict[int, int], found: dict[int, int], hot: int) -> float:
    """The mean share of its links that a node found, of nodes with up to ``hot`` links or of the others, whichever is less."""
    parts: dict[bool, list[float]] = {}
    for node, links in truth.items():
        parts.setdefault(links > hot, []).append(min(found.get(node, 0), links) / links)
    return min((sum(part) / len(part) for part in parts.values()), default=1.0)


def _usable(vector: Column, kind: str) -> Column:
    """Whether a vector has numbers, finite ones alone, and not all zero.

    NaN is above infinity; what an array with a null does not contain is not known.
    """
    infinite = F.lit(float("inf")).cast(kind)
    top, low = F.array_max(vector), F.array_min(vector)
    finite = ~F.array_contains(vector, infinite) & (top < infinite) & (low > -infinite)
    return F.coalesce(finite & ((top != 0) | (low != 0)), F.lit(False))


def _share(salt: str, shares: dict[int, float]) -> Column:
    """Whether a node is among a share of those of its length, drawn by a hash."""
    share = F.lit(0.0)
    for dim, part in shares.items():
        share = F.when(F.col("dim") == dim, part).otherwise(share)
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(1 << 30)) < share * (1 << 30)


def _regions(n: int, dim: int, shards: int, size: int) -> int:
    most = max(1, min(REGION_ROWS, BLOCK_BYTES // (size * dim)))
    return max(min(shards, -(-n // 512)), -(-n // most))


def _sample(nodes: DataFrame, dims: dict[int, int], shards: int, size: int) -> dict[int, np.ndarray]:
    """Random unit vectors of each length, some for each region."""
    shares = {dim: min(1.0, max(DRAWN, 4 * _regions(n, dim, shards, size)) / n) for dim, n in dims.items()}
    drawn = nodes.where(_share("centre", shares)).groupBy("node", "dim").agg(F.first("vector").alias("vector")).toArrow()
    sample = {}
    for dim in dims:
        own = drawn.filter(pa.array(drawn.column("dim").to_numpy() == dim))
        if own.num_rows:
            node = own.column("node").to_numpy()
            sample[dim] = _unit(_matrix(own.column("vector")))[np.lexsort((node, _mixed(node, 3)))]
    return sample


def _deals(
    nodes: DataFrame, dims: dict[int, int], sample: dict[int, np.ndarray], divide, least: float, shards: int, size: int
) -> dict[int, _Deal]:
    """Slots for the vectors of each length, by the members and askers of its regions, as some vectors tell them."""
    regions = {}
    for dim, n in dims.items():
        some = sample.get(dim, np.eye(1, dim))
        at = spread(some, _regions(n, dim, shards, size), least)
        others = np.delete(some, at, axis=0)
        regions[dim] = divide(some[at], others[:DRAWN] if len(others) else some)
    share = min(1.0, max(COUNTED, 512 * sum(len(r.centres) for r in regions.values())) / sum(dims.values()))
    counted = nodes.where(_share("count", dict.fromkeys(dims, share))).select("node", "vector")
    counted = counted.mapInArrow(_counted(regions), "dim int, region int, members long, askers long")
    counted = counted.groupBy("dim", "region").agg(F.sum("members").alias("members"), F.sum("askers").alias("askers"))
    counts = {dim: np.zeros((2, len(r.centres))) for dim, r in regions.items()}
    for r in counted.collect():
        counts[r.dim][:, r.region] = r.members / share, r.askers / share
    deals, first = {}, 0
    for dim, (members, askers) in counts.items():
        most = max(1, BLOCK_BYTES // (size * dim))
        blocks = np.maximum(1, np.ceil(members / most)).astype(np.int64)
        pairs = (members + askers) * np.minimum(members, most) * dim / 64
        parts = np.maximum(1, np.ceil(pairs / TASK_PAIRS)).astype(np.int64)
        ends = np.cumsum(blocks * parts)
        deals[dim] = _Deal(regions[dim], first + ends - blocks * parts, blocks, parts)
        first += int(ends[-1])
    return deals


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    beam: int = 48,
    audit_rows: int = 512,
    audit_recall: float = 0.99,
    audit_linked: int = 200,
    audit_most: int = 8192,
    shards: int = SHARDS,
) -> DataFrame:
    """One row per vector: ``(id, n_links, component_id, kept)``.

    Two vectors are linked when their cosine in double precision is ``least`` or more.

    * Equal vectors are one node, which counts as often as it occurs.
    * Regions: centres are drawn from the vectors, no two of them linked, at least ``shards``
      unless the table is very small and more if a region would exceed ``REGION_ROWS`` or
      ``BLOCK_BYTES``. A vector is at home with its nearest centre and asks further regions
      whose centres are hardly less near, see ``Regions``; on average, the home included,
      it asks ``beam / ASKED_BEAM`` regions, or fewer if these are sure to suffice.
    * A region's members are compared with each other and with all that ask it, so that
      each of two linked vectors is told if one asks the other's home. Members that exceed
      ``BLOCK_BYTES`` are dealt to blocks, and those that ask to parts, so that a task holds
      a block and a batch of rows, however large the table or a group of near vectors. Each
      hit is verified. A hot group costs its links, which are never listed.
    * Audit: ``audit_rows`` random nodes are compared with all vectors, then more, until
      ``audit_linked`` of them have links but no more than the first beam, or
      ``audit_most`` are drawn, which is logged. Each linked node counts alike, whatever
      its group's size, and nodes with more links than the first beam count apart. While
      either part found on average less than ``audit_recall`` of a node's links, the beam
      is doubled and the search repeated; in the end all that may hold a link are asked.
    * Each task hands on counts and a spanning forest of its links, not all pairs.
      Components are taken over the forests.

    Null, empty and zero vectors and those with a null or non-finite component have no
    links and are their own component; vectors of different length are not linked. A
    null id counts as a vector; ``component_id`` is the smallest id of the group, and
    null only if it has none. Rows that repeat an id and vector are vectors of their own,
    linked with each other and all kept where the id is. Other columns are not read. An
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kind = "float" if isinstance(vectors.schema[vector_col].dataType.elementType, FloatType) else "double"
    dtype = {"float": "float32", "double": "float64"}[kind]
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    usable, node, dim = _usable(F.col("vector"), kind), F.xxhash64("vector").alias("node"), F.size("vector").alias("dim")
    nodes = rows.where(usable).select(node, dim, "vector")
    keys = written(rows.select("id", F.when(usable, node).alias("node"), dim), "keys")
    known = keys.where("node is not null")
    dims = {r.dim: r.n for r in known.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    links = spark.createDataFrame([], "node long, links long, vectors long")
    roots = spark.createDataFrame([], "node long, root long")
    if dims:
        size = np.dtype(dtype).itemsize
        batch = max(64, min(8192, BATCH_BYTES // (size * max(dims))))
        with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}):
            hot = beam
            truth = _truth(nodes, least, hot, audit_rows, audit_linked, audit_most, known)
            linked = F.broadcast(spark.createDataFrame(pa.table({"node": pa.array(list(truth), pa.int64())})))
            sample = _sample(nodes, dims, shards, size)
            widest = max(dims.values())
            while True:
                divide, answer = _look_up(least, beam)
                deals = _deals(nodes, dims, sample, divide, least, shards, size)
                found = nodes.select("node", "vector").mapInArrow(_dealt(deals), DEALT)
                found = found.repartition("slot").sortWithinPartitions("slot", "rank", "node")
                found = found.mapInArrow(answer(dtype), "node long, other long, links long, vectors long")
                found = written(found, "links")
                links = found.where("other is null").groupBy("node")
                links = links.agg(F.sum("links").alias("links"), F.sum("vectors").alias("vectors"))
                hits = {r.node: r.vectors for r in links.join(linked, "node", "left_semi").collect()}
                if _recall(truth, hits, hot) >= audit_recall or beam >= widest:
                    break
                beam *= 2
        roots = components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    met = known.groupBy("node").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("size"))
    met = met.join(links.drop("links"), "node", "left").join(roots, "node", "left")
    met = met.where("size > 1 or vectors is not null or root is not null")
    met = written(met.withColumn("root", F.coalesce("root", "node")), "linked")
    smallest = met.groupBy("root").agg(F.min("least_id").alias("component_id"))
    met = met.join(smallest, "root").select(
        "node", (F.coalesce("vectors", F.lit(0)) + F.col("size") - F.lit(1)).alias("n_links"), "component_id"
    )
    done = keys.select("id", "node").join(met, "node", "left")
    own = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return done.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("id") == own, own.isNull()).alias("kept"),
    )
