"""Word-piece token counts by a linear longest-match automaton.

Greedy word pieces take the longest piece at a word's start, then the longest
continuation piece, and so on. All pieces stand in one trie with two roots, one for the
start of a word and one for continuations. Every node has a failure link: if no piece goes
on with the next byte, the longest pieces that the bytes read so far break into are popped,
and the link leads to the node of what is left. Only how many pieces a link pops is kept,
so a word's count comes from one pass over its bytes, without looking back and without
building a piece. A word that cannot be cut is one unknown token.

The automaton is built once per Python worker from the vocabulary file's pieces, which are
broadcast (a vocabulary has a bounded size). Counts of words already met are remembered,
up to a bound. Words are runs of anything but space and tab to carriage return.

Defined cases: a null or empty text has no words and no tokens; a word of any length is
read whole; an empty vocabulary makes every word unknown.
"""
from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare, word_blocks

START, INNER, DEAD = 0, 1, -1
#: Words a worker remembers, and the longest in bytes that it does.
REMEMBERED, WORD_BYTES = 400_000, 64


class Automaton:
    """Trie of word starts and continuations, with failure links and popped-piece counts."""

    def __init__(self, starts: list[bytes], inner: list[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces in ((START, starts), (INNER, inner)):
            for p in pieces:
                node = root
                for byte in p:
                    to = self.next[node].get(byte)
                    if to is None:
                        to = self.next[node][byte] = len(self.next)
                        self.next.append({})
                        piece.append(False)
                    node = to
                if p:
                    piece[node] = True
        self.fail = [DEAD] * len(self.next)
        self.popped = [0] * len(self.next)
        # parents come before children, and a link leads to a shorter rest
        queue = deque((child, byte, root) for root in (START, INNER) for byte, child in self.next[root].items())
        while queue:
            node, byte, parent = queue.popleft()
            if piece[node]:  # all that was read is one piece; continuations come next
                self.fail[node], self.popped[node] = INNER, 1
            else:
                to, n = self.fail[parent], self.popped[parent]
                while to != DEAD and byte not in self.next[to]:
                    n += self.popped[to]
                    to = self.fail[to]
                if to != DEAD:
                    self.fail[node], self.popped[node] = self.next[to][byte], n
            queue.extend((child, b, node) for b, child in self.next[node].items())

    def count(self, word: bytes) -> int:
        """Pieces of a word; -1 if it cannot be cut."""
        nxt, fail, popped = self.next, self.fail, self.popped
        node, n = START, 0
        for byte in word:
            to = nxt[node].get(byte)
            while to is None:
                n += popped[node]
                node = fail[node]
                if node == DEAD:
                    return -1
                to = nxt[node].get(byte)
            node = to
        while node != INNER:
            n += popped[node]
            node = fail[node]
            if node == DEAD:
                return -1
        return n


class Counted(dict):
    """Counts by word, filled as words come up."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word)
        if len(word) <= WORD_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


def byte_level_pieces(vocabulary: str) -> tuple[list[bytes], list[bytes]]:
    """(word starts, continuations) from a byte-level vocabulary file (JSON): tokens that begin
    with a space start words, the others go on; every single byte may do both."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    starts, inner = {bytes([b]) for b in range(256)}, {bytes([b]) for b in range(256)}
    for token in json.loads(vocabulary)["model"]["vocab"]:
        if all(c in shown for c in token):
            raw = bytes(shown[c] for c in token)
            if raw[:1] == b" ":
                starts.add(raw[1:])
            else:
                inner.add(raw)
    starts.discard(b"")
    return sorted(starts), sorted(inner)


def token_counts(docs: DataFrame, *, starts: list[bytes], inner: list[bytes], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens (an unknown word is one), n_unknown."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((starts, inner))
    src = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Counted(Automaton(*shared.value))
        for b in batches:
            words, tokens, unknown = [], [], []
            for t in b.column(1):
                k = total = bad = 0
                for w in word_blocks(t.as_py().encode("utf-8", "surrogatepass")):
                    n = list(map(known.__getitem__, w))
                    k, total, bad = k + len(n), total + sum(n), bad + n.count(-1)
                words.append(k)
                tokens.append(total + 2 * bad)
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                                             ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return src.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")
