"""Token counts by a linear longest-match automaton over a word-piece vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS = 500_000


def read_vocabulary(path: str) -> list[bytes]:
    """The pieces of a rank file: a base64 piece and its rank in each line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class PieceCounter:
    """A trie of the pieces with failure links and the pieces that each link gives up.

    Matching follows the trie. Where it cannot go on, the pieces that greedy longest match
    would have cut off the characters seen so far are known (``popped``), as is the node of
    what is left (``link``), so the characters are not read again and no piece is built. A
    word of ``n`` bytes takes at most ``2 n`` steps.
    """

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        depth, piece = [0], [False]
        for own in pieces:
            node = 0
            for byte in own:
                follow = children[node].get(byte)
                if follow is None:
                    follow = children[node][byte] = len(children)
                    children.append({})
                    depth.append(depth[node] + 1)
                    piece.append(False)
                node = follow
            if own:
                piece[node] = True
        missing = [b for b in range(256) if b not in children[0] or not piece[children[0][b]]]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        link, popped = [0] * len(children), [0] * len(children)
        level = [0]
        while level:
            below = []
            for node in level:
                for byte, child in children[node].items():
                    below.append(child)
                    if piece[child]:
                        link[child], popped[child] = 0, 1
                        continue
                    # The parent's longest pieces go first, then those on the way until the
                    # byte fits. From the root it always does.
                    at, count = link[node], popped[node]
                    while byte not in children[at]:
                        count += popped[at]
                        at = link[at]
                    link[child], popped[child] = children[at][byte], count
            level = below
        self.children, self.link, self.popped = children, link, popped

    def count(self, word: bytes) -> int:
        """How many pieces greedy longest match from the left cuts the word into."""
        children, link, popped = self.children, self.link, self.popped
        node = total = 0
        for byte in word:
            follow = children[node].get(byte)
            while follow is None:
                total += popped[node]
                node = link[node]
                follow = children[node].get(byte)
            node = follow
        while node:
            total += popped[node]
            node = link[node]
        return total


class _Cache(dict):
    """Counts of words seen; emptied when full, so its memory is bounded."""

    def __init__(self, counter: PieceCounter):
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self.counter.count(b" " + word)
        if len(word) <= 64:
            self[word] = found
        return found


_counters: dict[str, _Cache] = {}


def _count(path: str, held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _counters.get(path)
        if cache is None:
            cache = _counters[path] = _Cache(PieceCounter(held.value))
        look = cache.__getitem__
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1):
                own = (text.as_py() or "").encode().split()
                words.append(len(own))
                tokens.append(sum(map(look, own)))
            yield pa.record_batch(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=["__id", "n_words", "n_tokens"],
            )

    return run


def count_tokens(
    docs: DataFrame,
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, n_words, n_tokens)`` per document.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` of the whole text. Each is cut, with a blank
    before it, into the longest pieces of the vocabulary from the left; pieces that start
    with the blank open a word, all others continue one. The vocabulary is a rank file
    that has all single bytes, so every word can be cut; it is read by the driver and
    broadcast, and its size does not depend on the documents.

    Null and empty texts have no words and no tokens. Null ids and repeated rows stay
    rows of their own. Other columns are not read. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    done = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(
        _count(vocabulary, held), f"__id {kind}, n_words long, n_tokens long"
    )
    return done.withColumnRenamed("__id", id_col)
