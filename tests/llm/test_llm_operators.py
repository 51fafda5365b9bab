"""The numbered operators on small tables, against brute force and on edge rows."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check import TABLES
from millrace.llm import queries as llm
from millrace.llm import embeddings, sharding
from millrace.llm.chat import format_chats, parse_chat, read_back
from millrace.llm.decontamination import contaminated, decontaminate
from millrace.llm.embeddings import _Forest, _recall, _truth, near_vectors
from millrace.llm.hnsw import Graph
from millrace.llm.minhash import _least_share, drop_near_duplicates, near_duplicates
from millrace.llm.mixing import _rate, fit_rates, mix, mixing_rates
from millrace.llm.repeats import remove_repeats
from millrace.llm.sharding import assign_shards
from millrace.llm.tokens import PieceCounter, count_tokens, read_vocabulary
from millrace.llm.toxicity import drop_toxic, toxicity
from millrace.llm.warc import round_trip

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# A clashing column, nulls, empty texts, ties, repeated rows and a long text.
EDGE = "doc_id long, text string, `slot` string, rate string"
LONG = " ".join(f"w{i}" for i in range(20_000))


def edge_rows():
    return [
        (1, "One two three four five six seven", "a", None),
        (1, "One two three four five six seven", "a", None),
        (2, "one TWO three four\tfive six seven", None, "x"),
        (3, None, "b", "y"),
        (4, "", None, None),
        (5, " \n\t ", None, None),
        (6, "single", None, None),
        (None, "no id at all but some words here", None, None),
        (7, LONG, None, None),
        (8, "w0 " + LONG, None, None),
    ]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], EDGE)


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def shingle_set(text, size):
    own = words(text, True)
    if not own:
        return set()
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))}


def groups(sets, percent=80):
    parent = {k: k for k in sets}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {k: top(k) for k in sets}


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = llm.REGISTRY[name](spark, SF_DIR)
    names = sorted(result.columns)
    expected = db.execute(f"SELECT {', '.join(names)} FROM ({llm.ORACLE[name]})").fetchall()
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted((tuple(r) for r in result.select(*names).collect()), key=key) == sorted(expected, key=key)


def test_near_duplicates_edge(spark, edge, nothing):
    found = {r.doc_id: r for r in near_duplicates(edge, shingle_words=2).collect()}
    assert found[2].component_id == 1 and not found[2].kept and found[1].kept
    assert [found[i].n_shingles for i in (3, 4, 5, 6)] == [0, 0, 0, 1]
    assert all(found[i].kept and found[i].component_id == i for i in (3, 4, 5, 6))
    assert found[8].component_id == 7
    assert found[None].kept and found[None].component_id is None
    left = drop_near_duplicates(edge, shingle_words=2)
    assert left.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 3, 4, 5, 6, 7]
    assert near_duplicates(nothing).count() == 0


def test_near_copies_without_id(spark):
    """Documents without id are linked like all others, and join the groups on their two sides."""
    base = [f"b{i}" for i in range(100)]
    near, far = [*base[:90], *(f"n{i}" for i in range(8))], [*base[8:90], *(f"n{i}" for i in range(8))]
    alone = [f"c{i}" for i in range(60)]
    rows = [(1, base), (None, near), (2, far), (None, alone), (None, [*alone, "more"]), (3, [f"d{i}" for i in range(9)])]
    docs = spark.createDataFrame([(i, " ".join(own)) for i, own in rows], "doc_id long, text string")
    sets = [shingle_set(" ".join(own), 1) for _, own in rows]
    assert groups(dict(enumerate(sets))) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}
    assert groups({0: sets[0], 2: sets[2]}) == {0: 0, 2: 2}
    found = near_duplicates(docs, shingle_words=1).collect()
    assert sorted(((r.doc_id or 0), r.n_shingles, (r.component_id or 0), r.kept) for r in found) == [
        (0, 60, 0, True), (0, 61, 0, True), (0, 98, 1, False), (1, 100, 1, True), (2, 90, 1, False), (3, 9, 3, True)
    ]


def test_signatures_lose_less_than_bands():
    share, minima = 0.8, 256
    few = range(math.ceil(_least_share(80, minima) * minima))
    lost = sum(math.comb(minima, k) * share**k * (1 - share) ** (minima - k) for k in few)
    assert lost < (1 - share**5) ** 32 / 10


def test_dropped_near_duplicates_are_rows(spark):
    """A repeated id is decided text by text, and rows without id are copies like all others."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(3, a), (5, a), (5, b), (5, b), (None, a), (None, a + " end"), *[(None, c)] * 30, (None, d)]
    rows += [(6, ""), (6, ""), (6, None), (None, ""), (None, ""), (7, d + " x"), (7, d + " y")]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, slot string")
    left = drop_near_duplicates(docs, shingle_words=2)
    assert left.columns == docs.columns
    left = sorted(((r.doc_id or 0), r.text or repr(r.text)) for r in left.collect())
    seven = [r for r in left if r[0] == 7]
    assert len(seven) == 1 and seven[0][1] in (d + " x", d + " y")
    assert [r for r in left if r[0] != 7] == [(0, "''"), (0, "''"), (0, c), (3, a), (5, b), (6, "''"), (6, "None")]


def test_near_copies_of_every_degree(spark):
    """A band-sharing group in which some pairs are linked and many are not."""
    rng = random.Random(5)
    base = [f"v{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(160):
        own = list(base)
        for _ in range(rng.choice([0, 1, 3, 6, 9, 12])):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    expected = groups({i: shingle_set(t, 2) for i, t in rows})
    assert {r.doc_id: r.component_id for r in found} == expected


def test_shards(spark, edge, nothing):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = assign_shards(docs, shards=7).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    held = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r.slot)
        assert r["size"] == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(sorted(slots) == list(range(len(slots))) for slots in held.values())
    sizes = [len(held[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1
    moved = {r.doc_id: r.shard for r in assign_shards(docs, shards=8).collect()}
    assert sum(moved[r.doc_id] != r.shard for r in rows) < len(rows) / 2
    assert sorted(r.slot for r in assign_shards(edge, shards=1).collect()) == list(range(10))
    assert assign_shards(nothing).count() == 0


def test_shards_against_single_keys(spark):
    """The ring walked one key after another gives the same shards."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id < 5").withColumn("text", F.lit(None).cast("string")))
    shards, virtual, slots = 5, 8, 64
    nodes = sharding.ring(spark, shards, virtual)
    keys = docs.select(
        F.xxhash64("doc_id", F.crc32(F.coalesce("text", F.lit(""))), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8),
        "doc_id",
        F.crc32(F.coalesce("text", F.lit(""))).alias("crc"),
    ).collect()
    keys = sorted(((k[0] & (1 << 64) - 1) >> 2, k.doc_id, k.crc) for k in keys)
    room = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    expected, over = {}, []
    for place, doc, crc in keys:
        slot = place >> 56
        at = next((i for i, (position, _) in enumerate(nodes) if position >= slot << 56), 0)
        if room[nodes[at][1]]:
            room[nodes[at][1]] -= 1
            expected[doc, crc] = nodes[at][1]
        else:
            over.append((at, doc, crc))
    for at, doc, crc in over:
        while not room[nodes[at % len(nodes)][1]]:
            at += 1
        room[nodes[at % len(nodes)][1]] -= 1
        expected[doc, crc] = nodes[at % len(nodes)][1]
    found = assign_shards(docs, shards=shards, virtual=virtual, slots=slots).collect()
    assert {(r.doc_id, r.text_crc32): r.shard for r in found} == expected
    assert len(found) == len(keys)


def test_shards_of_a_repeated_row(spark, monkeypatch):
    """A row that occurs very often is written out in ranges, and takes each place once."""
    monkeypatch.setattr(sharding, "REPEATED", 16)
    docs = spark.range(1000).select(F.when(F.col("id") > 900, F.col("id")).alias("doc_id"), F.lit("").alias("text"))
    rows = assign_shards(docs, shards=3).collect()
    held = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(3)}
    assert [len(held[s]) for s in range(3)] == [334, 333, 333]
    assert all(slots == list(range(len(slots))) for slots in held.values())
    assert sum(r.doc_id is None for r in rows) == 901


def test_shards_start_no_python_on_executors(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = assign_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_chats_round_trip(spark):
    rows = [
        (1, 2, "assistant", "b <|im_end|>\n<||im_start|> <"),
        (1, 1, "user", None),
        (1, 1, "odd\nrole\\n<|", "| tail"),
        (2, None, None, ""),
        (2, 0, "assistant", "é <|"),
        (2, 0, "assistant", "é <|"),
        (None, 0, "user", "x" * 100_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("formatted", F.lit("clash"))
    made = {r.conv_id: r for r in format_chats(turns).collect()}
    assert parse_chat(made[1].formatted.encode()) == [
        ("odd\nrole\\n<|", b"| tail"),
        ("user", b""),
        ("assistant", rows[0][3].encode()),
    ]
    assert made[1].formatted.count("<|im_end|>") == 3
    digest = {r.conv_id: r for r in read_back(format_chats(turns)).collect()}
    assert digest[2].n_turns == 3 and digest[2].loss_chars == 8
    assert digest[2].loss_sha256 == hashlib.sha256(("é <|" * 2).encode()).hexdigest()
    assert digest[None].loss_chars == 0 and digest[None].formatted_chars == 100_000 + 4 + 24
    assert format_chats(turns.limit(0)).count() == 0


def test_warc_edge(spark):
    rows = [(1, "u\n%", "same"), (3, None, "same"), (2, "v", None), (4, "w", ""), (None, "x", "same"), (5, "y", "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    found = {r.page_id: r for r in round_trip(pages).collect()}
    assert found[1].record_type == "revisit" and found[1].refers_to == 3 and found[1].payload is None
    assert found[1].url == "u\n%" and found[1].payload_bytes == 4
    assert found[3].record_type == "response" and bytes(found[3].payload) == b"same"
    assert found[None].refers_to == 3 and found[2].refers_to == 4 and found[5].payload_bytes == 2
    short = {r.page_id: r for r in round_trip(pages, min_bytes=1).collect()}
    assert short[2].record_type == short[4].record_type == "response"
    assert round_trip(pages.limit(0)).count() == 0


def greedy(pieces, longest, word):
    count = at = 0
    while at < len(word):
        size = next(n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in pieces)
        count, at = count + 1, at + size
    return count


def test_token_counts(spark, edge, nothing):
    small = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bcd", b"abcde", b" a", b" abx", b"cdcd", b"dc"]
    counter, rng = PieceCounter(small), random.Random(3)
    for _ in range(3000):
        word = bytes(rng.choice(b" abcdex") for _ in range(rng.randrange(1, 24)))
        assert counter.count(word) == greedy(set(small), 5, word)
    pieces = read_vocabulary(VOCABULARY)
    longest, known = max(map(len, pieces)), set(pieces)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in count_tokens(docs, VOCABULARY).collect():
        own = words(texts[r.doc_id])
        assert (r.n_words, r.n_tokens) == (len(own), sum(greedy(known, longest, b" " + w) for w in own))
    found = [(r.doc_id, r.n_words) for r in count_tokens(edge, VOCABULARY).collect()]
    assert (3, 0) in found and (7, 20_000) in found and len(found) == 10
    assert count_tokens(nothing, VOCABULARY).count() == 0


def test_contaminated_edge(spark, edge, nothing):
    items = spark.createDataFrame(
        [
            (1, "TWO three four five six"),
            (2, "nothing like this is in there"),
            (3, None),
            (4, "single"),
            (5, " ".join(f"w{i}" for i in range(700, 760)) + " zz"),
            (None, "no id at all but some words here"),
        ],
        "item_id long, text string",
    )
    found = {(r.doc_id, r.item_id) for r in contaminated(edge, items).collect()}
    assert found == {(1, 1), (2, 1), (6, 4), (7, 5), (8, 5), (None, None)}
    left = decontaminate(edge, items)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5] and left.columns == edge.columns
    assert contaminated(nothing, items).count() == 0
    assert contaminated(edge, items.limit(0)).count() == 0
    assert decontaminate(edge, items.limit(0)).count() == 10


def test_repeats_edge(spark, nothing):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [
        (5, f"a b {passage} c"),
        (3, passage),
        (9, f"x {passage[: passage.index('p14')]} y {passage}"),
        (9, passage),
        (None, passage),
        (4, None),
        (6, ""),
        (7, LONG),
        (8, LONG + " end"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1))
    found = sorted(((r.doc_id or 0, r.n_words, r.n_removed, r.kept[:20]) for r in remove_repeats(docs).collect()))
    assert found == [
        (0, 30, 0, passage[:20]),
        (3, 30, 0, passage[:20]),
        (4, 0, 0, ""),
        (5, 33, 30, "a b c"),
        (6, 0, 0, ""),
        (7, 20_000, 0, LONG[:20]),
        (8, 20_001, 20_000, "end"),
        (9, 30, 30, ""),
        (9, 46, 44, "x y"),
    ]
    assert remove_repeats(nothing).count() == 0


def test_graph_finds_every_close_node():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    x = np.concatenate([rng.normal(size=(1500, 24)), centres.repeat(30, axis=0) + 0.1 * rng.normal(size=(1200, 24))])
    x = rng.permutation(x / np.linalg.norm(x, axis=1, keepdims=True))
    row, node = Graph.build(x).within(x, 0.9, 24)
    expected = np.argwhere(x @ x.T >= 0.9)
    found = set(zip(row.tolist(), node.tolist()))
    assert sum(tuple(pair) in found for pair in expected.tolist()) >= 0.995 * len(expected)


def test_graph_walks_through_a_dense_group():
    """All pairs of a group far beyond the beam, each once, and a forest that ties it together."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=64) + 0.2 * rng.normal(size=(2000, 64)), rng.normal(size=(500, 64))])
    x = rng.permutation(x / np.linalg.norm(x, axis=1, keepdims=True))
    graph, forest, pairs = Graph.build(x), _Forest(np.arange(2500), np.arange(2500)), 0
    close = x @ x.T >= 0.9
    seen = np.zeros_like(close)
    for row, node, _ in graph.blocks(x, 0.9, 48):
        assert len(row) <= 1 << 20
        pairs += len(row)
        seen[row, node] = True
        forest.add(row, node)
    assert pairs == seen.sum() and seen.sum() >= 0.999 * close.sum()
    assert len(forest.kept) == 1999


def test_near_vectors_of_a_hot_group(spark):
    """Every link and component right in a group of a third of the vectors."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 32))
    x[::3] = x[0] + 0.15 * rng.normal(size=(1000, 32))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(vectors, shards=2).collect()}
    assert sum(min(found[i][0], n) for i, n in enumerate(links)) >= 0.999 * links.sum()
    assert all(found[i][0] <= n for i, n in enumerate(links))
    assert {found[i][1] for i in range(0, 3000, 3) if links[i]} == {0}


def test_near_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(1200, 16))
    base[300:420] = base[7] + 0.12 * rng.normal(size=(120, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(5000, rows[5][1]), (5001, [2 * x for x in rows[5][1]]), (None, rows[6][1])]
    rows += [(6000, None), (6001, []), (6002, [0.0] * 16), (6003, [float("nan")] * 16), (6004, [1.0, None])]
    rows += [(6005, [1.0, 0.0]), (6006, [2.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in near_vectors(vectors).collect()}
    keep = [(i, np.array(v)) for i, v in rows if i is not None and i < 6000]
    unit = np.array([v / np.linalg.norm(v) for _, v in keep])
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    extra = {6: 1}
    wrong = sum(found[i].n_links != close[k].sum() + extra.get(i, 0) for k, (i, _) in enumerate(keep))
    assert wrong <= 2
    assert found[5000].component_id == found[5001].component_id == found[5].component_id
    assert found[None].component_id == found[6].component_id and not found[None].kept
    for i in (6000, 6001, 6002, 6003, 6004):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert found[6006].component_id == 6005 and found[6006].n_links == 1
    assert near_vectors(vectors.limit(0)).count() == 0


def test_audit_repeats_a_search_that_misses_links(spark, monkeypatch):
    """Beams are doubled until the audit passes; here those below 32 miss the weaker links."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(2000, 32))
    x[1000:] = x[:1000] + 0.3 * rng.normal(size=(1000, 32))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    look_up, beams = embeddings._look_up, []

    def blunt(least, beam):
        beams.append(beam)
        return look_up(least if beam >= 32 else 0.96, beam)

    monkeypatch.setattr(embeddings, "_look_up", blunt)
    found = {r.vec_id: r.n_links for r in near_vectors(vectors, beam=8).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert beams == [8, 16, 32] and links.sum() > 500
    assert sum(min(found[i], n) for i, n in enumerate(links)) >= 0.99 * links.sum()


def test_audit_sees_small_groups(spark):
    """Few linked vectors are found by drawing on, and a hot group does not outweigh them."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(3000, 32))
    base[:20] = base[20:40] + 0.01
    rows = [(i, 32, v.tolist()) for i, v in enumerate(base)]
    nodes = spark.createDataFrame(rows, "node long, dim int, vector array<double>")
    assert _truth(nodes, 0.9, 48, 512, 200, 8192) == dict.fromkeys(range(40), 1)
    assert len(_truth(nodes, 0.9, 48, 512, 1, 8192)) < 40
    truth = {i: 20_000 for i in range(170)} | {i: 1 for i in range(170, 180)}
    found = {i: 20_000 for i in range(170)}
    assert sum(found.values()) >= 0.99 * sum(truth.values()) and _recall(truth, found, 48) == 0
    assert _recall(truth, truth, 48) == _recall({}, {}, 48) == 1


def test_toxicity(spark, edge, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity(docs, labels).join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(not r.toxic for r in rows)
    assert caught > 0.75 and wrong < 0.02
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    odd = spark.createDataFrame([(1, 1), (2, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    assert toxicity(edge, odd).count() == 10
    assert drop_toxic(edge, odd.limit(0)).columns == edge.columns
    assert drop_toxic(edge, odd.limit(0)).count() == 10 and toxicity(nothing, odd).count() == 0


def test_mixing(spark, edge, nothing):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = mixing_rates(docs, labels, {"1": 0.6, "0": 0.4}, "quality").collect()
    tokens = np.array([r.tokens for r in rows], dtype=float)
    share, rate = np.array([r.share for r in rows]), np.array([r.rate for r in rows])
    assert np.allclose(share.sum(axis=1), 1) and (rate >= 0).all()
    assert np.allclose((tokens * rate) @ share / tokens.sum(), [0.4, 0.6], atol=1e-3)
    # Brute force: the least change of the rates, weighted by tokens, with the same totals.
    gram = (share * tokens[:, None]).T @ share
    plain = 1 + share @ np.linalg.solve(gram, np.array([0.4, 0.6]) * tokens.sum() - tokens @ share)
    if (plain > 0).all():
        assert np.allclose(rate, plain, atol=1e-3)
    assert [r.tokens for r in rows] == [len(words(r2.text)) for r2 in docs.collect()]
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    marks = spark.createDataFrame([(1, 1), (2, 0), (None, 0), (7, None)], "doc_id long, quality int")
    mixed = mix(edge, marks, {"1": 0.5, "0": 0.5}, "quality")
    assert mixed.columns == edge.columns and mixed.count() >= 0
    assert mixing_rates(edge, marks.limit(0), {"unknown": 1.0}, "quality").count() == 10
    assert mixing_rates(nothing, marks, {"1": 1.0}, "quality").count() == 0


def test_domains_of_rows_not_learned_from(spark):
    """Junk of every kind, repeated words too, is told apart on labelled rows left out of the fit."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learned = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(2000)
    rated = mixing_rates(docs, labels, {"1": 0.95, "0": 0.05}, "quality", train_rows=2000)
    rows = rated.join(labels.withColumnRenamed("doc_id", "id"), "id")
    rows = rows.join(learned.select(F.col("doc_id").alias("id")), "id", "left_anti").collect()
    assert sum(r.quality == 0 for r in rows) > 200
    assert sum((r.share[1] > 0.5) != r.quality for r in rows) <= 0.005 * len(rows)
    tokens = {q: sum(r.tokens * r.rate for r in rows if r.quality == q) for q in (0, 1)}
    assert abs(tokens[0] / sum(tokens.values()) - 0.05) < 0.01


@pytest.mark.parametrize("targets", [{"a": 0.05, "b": 0.9, "c": 0.05}, {"a": 0.02, "b": 0.9, "c": 0.08}])
def test_clipped_rates_fit_as_well_as_can_be(spark, targets):
    """Rates stopped at zero leave no more misfit than plain descent over all single rates."""
    rng = np.random.default_rng(8)
    share = rng.dirichlet([0.3, 0.3, 0.05], size=300)
    tokens = rng.integers(1, 400, size=300).astype(float)
    scored = spark.createDataFrame([(int(t), s.tolist()) for t, s in zip(tokens, share)], "tokens long, share array<double>")
    names = ["a", "b", "c"]
    steps, misfit = fit_rates(scored, names, targets)
    rate = np.array([r.rate for r in scored.select(_rate("share", steps).alias("rate")).collect()])
    assert (rate >= 0).all() and (rate == 0).any()
    wanted = np.array([targets.get(n, 0.0) for n in names]) / sum(targets.values())
    mass = share * tokens[:, None] / tokens.sum()
    plain = np.ones(300)
    length = 1 / np.linalg.norm(mass, 2) ** 2
    for _ in range(20_000):
        plain = np.maximum(0, plain - length * (mass @ (plain @ mass - wanted)))
    best = np.linalg.norm(plain @ mass - wanted)
    assert np.linalg.norm(rate @ mass - wanted) <= best + 3e-4
    assert np.isclose(misfit[-1], np.abs(rate @ mass - wanted).max(), atol=1e-6)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]
    near = corpus_pipeline.remove_near_duplicates(spark, docs, SF_DIR)
    texts = {r.doc_id: r.text for r in docs.collect()}
    roots = groups({i: shingle_set(t, 5) for i, t in texts.items()})
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(roots.values()))
    done = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in done} <= set(texts) and len({r.shard for r in done}) == min(24, len(done))
