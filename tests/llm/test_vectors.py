"""How near vectors are dealt to regions, and what a task holds of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import embeddings
from millrace.llm.embeddings import _Block, _unit, near_vectors
from millrace.llm.hnsw import BASE_LINKS
from millrace.llm.regions import Regions, spread


def _table(spark, x, kind="double"):
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def _links(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    return close


def test_no_row_holds_a_shard(spark, monkeypatch):
    """What is written has no value that grows with the table: a shard's graph in one value took the executors' memory."""
    rng = np.random.default_rng(12)
    longest, write = [0], embeddings.written

    def seen(df, label, *args):
        out = write(df, label, *args)
        for name in (f.name for f in out.schema if f.dataType.typeName() == "binary"):
            longest.append(out.agg(F.max(F.length(name))).first()[0] or 0)
        return out

    monkeypatch.setattr(embeddings, "written", seen)
    near_vectors(_table(spark, rng.normal(size=(4000, 16)))).count()
    assert max(longest) <= 16 * 8


def test_blocks_and_parts_give_the_same(spark, monkeypatch):
    """A hot group far beyond a task's bytes, and copies of vectors, with every count and component right."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[::3] = x[0] + 0.15 * rng.normal(size=(1000, 32))
    x[1:1500:3] = x[2]
    monkeypatch.setattr(embeddings, "BLOCK_BYTES", 128 * 4 * 32)
    monkeypatch.setattr(embeddings, "TASK_PAIRS", 10_000)
    made, deals = embeddings._deals, []

    def seen(*args):
        deals.append(made(*args))
        return deals[-1]

    monkeypatch.setattr(embeddings, "_deals", seen)
    close = _links(x.astype(np.float64))
    found = {r.vec_id: r for r in near_vectors(_table(spark, x, "float")).collect()}
    deal = deals[-1][32]
    assert deal.blocks.max() >= 4 and deal.parts.max() >= 4 and len(deal.regions.centres) >= 20
    assert [found[i].n_links for i in range(3000)] == close.sum(axis=1).tolist()
    assert {found[i].component_id for i in range(0, 3000, 3) if close[i].any()} == {0}
    assert {found[i].component_id for i in range(1, 1500, 3)} == {1}
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_block_against_brute_force():
    """Links of members, of those that ask, and of members that do not ask back; sparse and dense, any length."""
    rng = np.random.default_rng(14)
    for dim, hot, every in ((8, 0, 7), (64, 0, 7), (64, 400, 7), (64, 0, 2000), (64, 400, 2000)):
        m = rng.normal(size=(1500, dim)).astype(np.float32)
        m[:hot] = m[0] + 0.3 * rng.normal(size=(hot, dim))
        g = np.concatenate([m[:700], rng.normal(size=(500, dim)).astype(np.float32)])
        g = rng.permutation(g + 0.1 * rng.normal(size=g.shape).astype(np.float32))
        asks = rng.random((1500, 5)) < 0.4
        asks[:, 0] = False
        size, home, guests = rng.integers(1, 4, 1500), rng.integers(0, 5, 1200), rng.integers(1, 3, 1200)
        rows = {"node": np.arange(1500), "size": size, "home": np.zeros(1500, np.int64), "asking": np.arange(1, 1501) % every > 0}
        rows |= {"asks": np.nonzero(asks)[1], "counts": asks.sum(axis=1), "vectors": m}
        block = _Block(0.9, [rows])
        block.members()
        own = _unit(m) @ _unit(m).T >= 0.9
        np.fill_diagonal(own, False)
        own[~rows["asking"]] = False
        assert (block.links == own.sum(axis=1)).all() and (block.linked == own @ size).all()
        links, linked = block.guests({"node": np.arange(5000, 6200), "size": guests, "home": home, "vectors": g})
        asked = _unit(g) @ _unit(m).T >= 0.9
        assert (links == asked.sum(axis=1)).all() and (linked == asked @ size).all()
        back = asked & ~(asks[:, home].T | (home == 0)[:, None])
        assert (block.links == own.sum(axis=1) + back.sum(axis=0)).all()
        assert (block.linked == own @ size + guests @ back).all()
        parts = {i: i for i in [*range(1500), *range(5000, 6200)]}
        tied = dict(parts)

        def root(at, i):
            while at[i] != i:
                i = at[i]
            return i

        for a, b in block.forest.kept:
            tied[root(tied, int(a))] = root(tied, int(b))
        for i, j in [*np.argwhere(own).tolist(), *(np.argwhere(asked) + [5000, 0]).tolist()]:
            assert root(tied, i) == root(tied, j)


def test_regions_are_sure_with_a_reach_of_one():
    rng = np.random.default_rng(15)
    x = _unit(rng.normal(size=(2000, 12)))
    y = x + 0.12 * rng.normal(size=x.shape)
    y = _unit(y)
    near = np.einsum("nd,nd->n", x, y) >= 0.9
    centres = x[spread(x, 40, 0.9)]
    assert len(centres) == 40 and (centres @ centres.T)[~np.eye(40, dtype=bool)].max() < 0.9

    def met(regions):
        (h, row, asked), (k, other, back) = regions.asked(x), regions.asked(y)
        pairs, backs = set(zip(row.tolist(), asked.tolist())), set(zip(other.tolist(), back.tolist()))
        assert (h == (x @ centres.T).argmax(axis=1)).all()
        return np.array([h[i] == k[i] or (i, k[i]) in pairs or (i, h[i]) in backs for i in range(len(x))]), len(row)

    sure, most = met(Regions(centres, 0.9, 48))
    assert near.sum() > 1000 and sure[near].all() and most < 39 * len(x)
    fitted = Regions.fitted(centres, x, 0.9, 48)
    assert abs(fitted.asked(x)[1].size - 2 * len(x)) < 0.02 * len(x) and fitted.reach < 1
    assert met(fitted)[0][near].mean() > 0.8


def test_walk_through_many_centres():
    """Beyond the centres that a walk would meet, it finds the same home and regions without comparing all."""
    rng = np.random.default_rng(16)
    x = _unit(rng.normal(size=(3000, 12)))
    centres = x[:1000]
    few, all_met = Regions(centres, 0.9, 16, 0.2), Regions(centres, 0.9, 1000, 0.2)
    assert few.graph and len(centres) > 16 * BASE_LINKS and not all_met.graph
    (h, row, asked), (k, other, back) = few.asked(x[1000:]), all_met.asked(x[1000:])
    assert (h == k).mean() > 0.99
    expected = set(zip(other.tolist(), back.tolist()))
    assert len(expected & set(zip(row.tolist(), asked.tolist()))) > 0.9 * len(expected)
    one, *_ = few.asked(x[1500:1501])
    assert one[0] == h[500]
