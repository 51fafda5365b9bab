"""Near-duplicate documents by MinHash, banding, verification and components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.joins import small
from millrace.llm.text import chunks, mix, randoms, shingles, split_words
from millrace.session import SMALL_BATCHES, session_conf, written

_ODD = np.uint64(1)
# Nodes, and shingles of their sets, that a group of the last comparison takes from either side.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20


def _class_of(own: np.ndarray) -> tuple[int, bytes]:
    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), digest


def _signatures(found: list[np.ndarray], minima: int) -> np.ndarray:
    """The minima of ``minima`` universal hash functions over each non-empty set, 16 bits of each."""
    sizes = np.array([len(own) for own in found])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keys = np.concatenate(found)
    factors, shifts = randoms(11, minima) | _ODD, randoms(12, minima)
    least = np.empty((len(found), minima), dtype=np.uint64)
    scratch = np.empty_like(keys)
    for j in range(minima):
        np.multiply(keys, factors[j], out=scratch)
        scratch += shifts[j]
        least[:, j] = np.minimum.reduceat(scratch, starts)
    return (mix(least) >> np.uint64(48)).astype("<u2")


def _sign(size: int, minima: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 2):
            found = shingles(split_words(part.column(2), lower=True), size)
            full = [i for i, own in enumerate(found) if len(own)]
            sign: list[bytes | None] = [None] * len(found)
            node: list[int | None] = [None] * len(found)
            if full:
                for i, row in zip(full, _signatures([found[i] for i in full], minima)):
                    sign[i], node[i] = row.tobytes(), _class_of(found[i])[0]
            yield pa.record_batch(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(own) for own in found], pa.int64()),
                    pa.array(node, pa.int64()),
                    pa.array(sign, pa.binary()),
                ],
                names=["__id", "__at", "n_shingles", "__node", "__sign"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 0):
            found = shingles(split_words(part.column(0), lower=True), size)
            found = [own for own in found if len(own)]
            lengths = np.concatenate([[0], np.cumsum([len(own) for own in found])]).astype(np.int32)
            values = np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.record_batch(
                [
                    pa.array([_class_of(own)[0] for own in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(values)),
                ],
                names=["node", "members"],
            )

    return run


def _least_share(percent: int, minima: int) -> float:
    """The share of equal minima below which a pair is not confirmed: 5.5 deviations below the threshold."""
    share = percent / 100
    return share - 5.5 * (share * (1 - share) / minima) ** 0.5


def _alike(least: float):
    """Keep the pairs whose signatures agree in at least this share of the minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1)
                for i in (2, 3)
            )
            keep = (left == right).mean(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


class _Links:
    """Which roots have been linked so far in one group."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, a: int) -> int:
        while (above := self.up.get(a, a)) != a:
            a = self.up[a] = self.up.get(above, above)
        return a

    def joins(self, a: int, b: int) -> bool:
        """Link two roots; whether they were apart before."""
        a, b = self.top(a), self.top(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _across(bands: int, rows: int, least: float, percent: int):
    """Links of a stray and a member of another component, of each sorted group.

    A pair is looked at in the first band that it shares, so once. Signatures that agree
    too little rule it out; the others are compared on their full sets here, unless the
    links of this group have brought their components together already. What comes out is
    a forest over the components: rejected pairs, and links that add nothing, are no rows.
    """

    def links(table: pa.Table) -> list[tuple[int, int]]:
        node, root = table.column("node").to_numpy(), table.column("root").to_numpy()
        stray = table.column("stray").to_numpy()
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), dtype="<u2").reshape(len(node), -1)
        number = table.column("number")[0].as_py()
        sets = table.column("members").combine_chunks()
        first = sets.offsets.to_numpy().astype(np.int64)
        length = np.diff(first)
        values, codes = np.unique(sets.values.to_numpy()[first[0] : first[-1]], return_inverse=True)
        first = first - first[0]
        marked = np.zeros(len(values), dtype=bool)
        them, us = np.flatnonzero(~stray), np.flatnonzero(stray)
        forest, found = _Links(), []
        for low in range(0, len(us), 16):
            own = us[low : low + 16]
            same = sign[own][:, None, :] == sign[them][None, :, :]
            shared = same[:, :, : bands * rows].reshape(len(own), len(them), bands, rows).all(axis=3)
            keep = (same.mean(axis=2) >= least) & (shared.argmax(axis=2) == number)
            keep &= root[own][:, None] != root[them][None, :]
            short = np.minimum(length[own][:, None], length[them][None, :])
            keep &= 100 * short >= percent * np.maximum(length[own][:, None], length[them][None, :])
            for r, i in enumerate(own):
                near = them[np.flatnonzero(keep[r])]
                if not len(near):
                    continue
                marked[codes[first[i] : first[i + 1]]] = True
                for j in near:
                    if forest.top(int(root[i])) != forest.top(int(root[j])):
                        both = int(np.count_nonzero(marked[codes[first[j] : first[j + 1]]]))
                        if 100 * both >= percent * (length[i] + length[j] - both):
                            forest.joins(int(root[i]), int(root[j]))
                            found.append((min(node[i], node[j]), max(node[i], node[j])))
                marked[codes[first[i] : first[i + 1]]] = False
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush():
            found = np.array(links(pa.concat_tables(held).combine_chunks()), dtype=np.int64).reshape(-1, 2)
            held.clear()
            return pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = np.stack([table.column(k).to_numpy().astype(np.int64) for k in ("band", "block", "chunk")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                key = tuple(keys[:, low])
                if held and key != last:
                    yield flush()
                held.append(table.slice(low, high - low))
                last = key
        if held:
            yield flush()

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per document: ``(id, n_shingles, component_id, kept)``.

    Words are lower-cased (A-Z) runs without white space; a document's set holds its
    distinct ``shingle_words``-word shingles (the whole sequence if it has fewer words).
    Two documents are linked when ``100 * intersection >= percent * union`` of their sets.

    * Documents with equal sets become one node (a 64-bit digest of the set).
    * Each node gets ``minima`` universal hash minima, the first ``bands * rows`` of which
      are banded. Nodes that share a band are candidates.
    * Candidates are first the nodes of a band with one of them, its centre, which is
      linear in the number of nodes. While bands hold several components and many pairs
      across them, another centre is tried. Last, each member outside a band's largest
      component is compared with all members of other components, in blocks to which the
      full sets are brought, so that links alone come out of them. So every pair of a band
      is linked, in one component already, or compared.
    * Candidates whose signatures agree well enough (five and a half deviations below
      the threshold) are confirmed on their full sets of 64-bit shingle hashes.
    * Components come from alternating large-star and small-star.

    At the threshold a pair shares no band with probability ``(1 - 0.8 ** 5) ** 32``,
    about three in a million; further above it much less. Its signatures agree too little
    with a probability of about one in ten million.

    An empty or null text has size 0 and is linked with nothing. A null id stays null in
    the result, with ``component_id`` null and ``kept`` true unless its group has an id,
    which then is the component's. Repeated rows are copies of each other: all rows with
    the id of the component are kept. Other columns are not read, whatever their names.
    An empty table gives an empty result. The options are those of ``_grouped``.
    """
    with session_conf(docs.sparkSession, SMALL_BATCHES):
        signed, known = _grouped(docs, id_col, text_col, **options)
    known = known.select("__node", F.col("first.id").alias("component_id"))
    own = F.when(F.col("__node").isNull(), F.col("__id")).otherwise(F.col("component_id"))
    return (
        signed.select("__id", "n_shingles", "__node")
        .join(known, "__node", "left")
        .select(F.col("__id").alias(id_col), "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))
    )


def _grouped(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    shingle_words: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 5,
    minima: int = 256,
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(__id, __at, n_shingles, __node, __sign)`` and, per node, the first row of its component.

    ``__at`` is a hash of the text. ``first`` is ``(none, id, at)``: rows without id come
    after all others, and rows of one id in the order of their hashes.
    """
    texts = docs.select(
        F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__at"), F.col(text_col).alias("__text")
    )
    kind = texts.schema["__id"].dataType.simpleString()
    signed = written(
        texts.mapInArrow(
            _sign(shingle_words, minima), f"__id {kind}, __at long, n_shingles long, __node long, __sign binary"
        ),
        "signatures",
    )
    first = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__at").alias("at"))
    nodes = written(
        signed.where("__node is not null")
        .groupBy(F.col("__node").alias("node"))
        .agg(F.min(first).alias("first"), F.first("n_shingles").alias("n"), F.first("__sign").alias("sign")),
        "nodes",
    )

    step = 2 * rows
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.substring("sign", i * step + 1, F.lit(step))),
    )
    banded = nodes.select("node", F.col("n").alias("length"), F.posexplode(keys).alias("number", "band"))
    centres = banded.groupBy("band").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
    members = written(banded.join(centres.where("n > 1").drop("n"), "band"), "members")
    # Full sets of all nodes that share a band; they are needed for any confirmation.
    needed = nodes.join(members.select("node").distinct(), "node", "left_semi")
    needed = needed.select(F.col("first.id").alias("needed_id"), F.col("first.at").alias("needed_at")).distinct()
    same = texts["__id"].eqNullSafe(needed["needed_id"]) & (texts["__at"] == needed["needed_at"])
    wanted = texts.join(needed, same).select("__text")
    sets = wanted.mapInArrow(_sets(shingle_words), "node long, members array<long>")
    sets = written(sets.groupBy("node").agg(F.first("members").alias("members")), "sets")

    least = _least_share(percent, minima)

    def alike(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs ``(u, v)``, those whose sizes and signatures allow a link."""
        u = nodes.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("sign").alias("sign_u"))
        v = nodes.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("sign").alias("sign_v"))
        sized = pairs.join(u, "u").join(v, "v")
        sized = sized.where(F.lit(100) * F.least("n_u", "n_v") >= F.lit(percent) * F.greatest("n_u", "n_v"))
        return sized.select("u", "v", "sign_u", "sign_v").mapInArrow(_alike(least), "u long, v long")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs ``(u, v)``, those whose sets are alike enough."""
        u = sets.select(F.col("node").alias("u"), F.col("members").alias("set_u"))
        v = sets.select(F.col("node").alias("v"), F.col("members").alias("set_v"))
        shared = F.size(F.array_intersect("set_u", "set_v"))
        union = F.size("set_u") + F.size("set_v") - shared
        both = pairs.join(u, "u").join(v, "v")
        return both.where(F.lit(100) * shared >= F.lit(percent) * union).select("u", "v")

    pairs = members.where("node <> centre").select(F.col("node").alias("u"), F.col("centre").alias("v")).distinct()
    edges: DataFrame | None = None
    phase = "centre"
    while True:
        more = written(confirmed(alike(pairs)) if phase != "all" else pairs, "edges")
        edges = more if edges is None else edges.unionByName(more)
        roots = components(edges)
        if phase == "all":
            break
        placed = members.join(roots, "node", "left")
        placed = placed.select("band", "number", "node", "length", F.coalesce("root", "node").alias("root"))
        parts = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("length"))
        mixed = parts.groupBy("band").agg(
            F.sum("n").alias("size"),
            F.sum("length").alias("shingles"),
            F.max(F.struct("n", "root", "length")).alias("main"),
            (F.pow(F.sum("n"), 2) - F.sum(F.col("n") * F.col("n"))).alias("across"),
        )
        mixed = mixed.where("across > 0")
        across, size = mixed.agg(F.sum("across"), F.sum("size")).first()
        if not across:
            break
        placed = written(placed.join(mixed, "band"), "mixed")
        # A try that is linear in the members comes first while the pairs are many.
        phase = "other centre" if phase == "centre" and across > 4 * size else "all"
        if phase == "other centre":
            centre = placed.groupBy("band").agg(
                F.min_by(F.struct("node", "root"), F.xxhash64("node", F.lit(1))).alias("centre")
            )
            pairs = placed.join(centre, "band").where("root <> centre.root")
            u, v = F.col("node"), F.col("centre.node")
            pairs = pairs.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()
            continue

        def parts_of(count, shingles):
            return F.ceil(F.greatest(count / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")

        blocks = parts_of(F.col("size"), F.col("shingles"))
        chunks_of = parts_of(F.col("size") - F.col("main.n"), F.col("shingles") - F.col("main.length"))
        own = F.pmod(F.xxhash64("node"), blocks).cast("int")
        part = F.pmod(F.xxhash64("node", F.lit("chunk")), chunks_of).cast("int")
        kept = ["band", "number", "node", "root"]
        member = placed.select(*kept, own.alias("block"), F.explode(F.sequence(F.lit(0), chunks_of - 1)).alias("chunk"))
        stray = placed.where("root <> main.root")
        stray = stray.select(*kept, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), part.alias("chunk"))
        both = member.withColumn("stray", F.lit(False)).unionByName(stray.withColumn("stray", F.lit(True)))
        both = both.join(nodes.select("node", "sign"), "node").join(sets, "node").repartition("band", "block", "chunk")
        both = both.sortWithinPartitions("band", "block", "chunk")
        pairs = both.mapInArrow(_across(bands, rows, least, percent), "u long, v long")

    known = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = known.groupBy("root").agg(F.min("first").alias("first"))
    return signed, known.drop("first").join(smallest, "root").select(F.col("node").alias("__node"), "first")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, of which one stays per group (see ``near_duplicates``).

    The one with the smallest id stays. Rows are told apart by id and text, so a repeated
    id is decided for each of its texts; of several texts of that id in one group the one
    whose hash is smallest stays, and of rows equal in both any one. A row without id
    stays only in a group in which no row has one. Rows without words are in no group:
    they stay, once per id and text where they have an id.
    """
    with session_conf(docs.sparkSession, SMALL_BATCHES):
        signed, known = _grouped(docs, id_col, text_col, **options)
    rows = signed.groupBy("__id", "__at").agg(F.first("__node").alias("__node"), F.count(F.lit(1)).alias("n"))
    leads = F.col("__id").eqNullSafe(F.col("first.id")) & (F.col("__at") == F.col("first.at"))
    rows = rows.join(known, "__node", "left").withColumn("stays", F.col("__node").isNull() | leads)
    rows = written(rows.select("__id", "__at", "__node", "n", "stays"), "kept")
    key = ["__id", "__at"]

    def same(left: DataFrame, some: DataFrame):
        return left[id_col].eqNullSafe(some["__id"]) & (F.xxhash64(left[text_col]) == some["__at"])

    gone = rows.where(~F.col("stays")).select(*key)
    gone = small(gone, gone.count())
    left = docs.join(gone, same(docs, gone), "left_anti")
    again = rows.where("stays and n > 1 and (__node is not null or __id is not null)").select(*key)
    repeated = again.count()
    if not repeated:
        return left
    some = small(again, repeated)
    once = left.join(some, same(left, some), "left_semi").dropDuplicates([id_col, text_col])
    return left.join(some, same(left, some), "left_anti").unionByName(once)
