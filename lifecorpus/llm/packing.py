"""Mixture-controlled packing into token sequences.

Every source is a queue of token runs, its documents one after another. The output is a
stream of windows, each ``window`` sequences long. By deficit round-robin every window
credits each queue with its share of the window, serves that many tokens of it, and
carries what rounding left over to the next; a queue that runs out leaves its share to the
others. The credit a queue has been served by the end of any window is a closed form of
the queue totals, so deficits are carried across windows and partitions without passing
anything along: a task that knows where its documents lie in their queues knows their
windows, and their places in them. The stream is cut every ``length`` tokens.

Three passes: tokens once, written to the shared folder with each document's place in its
queue within its partition; a sum per (queue, partition), whose running sums place the
partitions; and a map over the written tokens that cuts them. Token ids are not shuffled
unless the (queue, partition) table is too large to broadcast.

Shares default to the queues' own, so every window mirrors the corpus and all queues end
together. Only the last sequence can be short: it is padded to ``length``, unless its
length is a power of two.

Defined cases: a null or empty text is the end id alone; a null source is a queue of its
own; repeated rows are packed each; a source without a weight counts 1; an empty table gives
no piece; a text that spells out a special token has that token's id there; a run of white
space of any length is one piece of the vocabulary. Of more than ``MOST_QUEUES`` sources, those with a weight and the largest keep a
queue of their own; the others share queues by hash, each of the weight of its sources together.

At most so many queues share a window: of 131,072 tokens (64 sequences of 2048) each of 4,096
queues still gets 32 in the mean; more queues would cut documents into single tokens.

Ids are those of the byte-level BPE vocabulary whose rank file and special tokens are given.
"""
from __future__ import annotations

import base64
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import bounded, col, prepare, rows_in, stored

MOST_QUEUES = 4096
SPACE_BEFORE_SPACE = re.compile(r"\s(?:\s|\Z)")
LOOK_AHEAD = r"|\s+(?!\S)"
#: A run of Unicode white space that is cut out before the pattern sees it.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def id_type(ranks: bytes) -> np.dtype:
    """The narrowest unsigned integers that hold the vocabulary's ids (``ranks``: token and id a line)."""
    most = max(int(line.rpartition(b" ")[2]) for line in ranks.splitlines() if line)
    return np.dtype("<u2") if most < 1 << 16 else np.dtype("<u4")


class Encoder:
    """Texts to ids, packed as little-endian integers of ``dtype``. ``special``: tokens that a text
    may spell out, and their ids."""

    def __init__(self, ranks: bytes, pattern: str, special: dict[str, int] | None = None):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        # in a text without white space before white space or its end the look-ahead never
        # matches; without it the pattern is a plain automaton, twice as fast
        self.plain = tiktoken.Encoding("plain", pat_str=pattern.replace(LOOK_AHEAD, ""), mergeable_ranks=table,
                                       special_tokens={})
        self.special = special or {}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.spelled = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.dtype = np.dtype("<u4") if max(self.special.values(), default=0) >= 1 << 16 else id_type(ranks)

    def _plain_ids(self, text: str) -> list[int]:
        how = self.full if SPACE_BEFORE_SPACE.search(text) else self.plain
        return how.encode_ordinary(text)

    def _ids(self, text: str) -> list[int]:
        """Of a text without special tokens. The look-ahead tries a run of white space again and again,
        on a stack of its own: a long run's piece, all but its last character before other text, goes
        straight to the vocabulary."""
        out, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self._plain_ids(text[at:run.start()])
            out += self.full._encode_single_piece(text[run.start():end].encode())
            at = end
        return out + self._plain_ids(text[at:] if at else text)

    def encode(self, text: str) -> bytes:
        if self.spelled and any(s in text for s in self.special):
            ids = [i for part in self.spelled.split(text) if part
                   for i in ([self.special[part]] if part in self.special else self._ids(part))]
        else:
            ids = self._ids(text)
        return np.array(ids, dtype=self.dtype).tobytes()


class RoundRobin:
    """What every queue has been served by the end of any window. While queues are served by their
    shares, a queue has ``share * time`` tokens until it runs out at ``total / share``; the times at
    which queues run out are the phases, kept as numbers only, so many queues stay cheap."""

    def __init__(self, totals: list[int], weights: list[int] | None, window: int):
        self.totals, self.window, self.total = totals, window, sum(totals)
        self.windows = -(-self.total // window)
        exact = [Fraction(w) for w in (weights or totals)]
        scale = math.lcm(*(w.denominator for w in exact)) if exact else 1
        self.share = [int(w * scale) for w in exact]
        self.starts: list[Fraction] = []  # tokens served of all queues when a phase begins
        self.phases: list[tuple[Fraction, int]] = []  # its time, and the shares still served
        time, over, live = Fraction(0), 0, sum(s for s, n in zip(self.share, totals) if n)
        for end, q in sorted((Fraction(n, self.share[q]), q) for q, n in enumerate(totals) if n):
            if end > time:
                self.starts.append(over + time * live)
                self.phases.append((time, live))
                time = end
            over, live = over + totals[q], live - self.share[q]
        self.at = lru_cache(maxsize=max(16, 200_000 // max(len(totals), 1)))(self._at)
        self.upto = lru_cache(maxsize=max(16, 200_000 // max(len(totals), 1)))(self._upto)

    def _at(self, w: int) -> tuple[list[int], int]:
        """Tokens served of every queue before window ``w``, and their sum."""
        if w >= self.windows:
            return self.totals, self.total
        v = w * self.window
        k = bisect_right(self.starts, v) - 1
        time, live = self.phases[k]
        t = time + (v - self.starts[k]) / live
        a, b = 2 * t.numerator, 2 * t.denominator
        q = [min(n, (s * a + b // 2) // b) for n, s in zip(self.totals, self.share)]
        return q, sum(q)

    def _upto(self, w: int) -> list[int]:
        """Tokens served of all queues before each queue, before window ``w``."""
        return list(accumulate(self.at(w)[0], initial=0))

    def window_of(self, queue: int, token: int, guess: int) -> int:
        """The window that serves a queue's token."""
        for w in (guess, guess + 1):
            if self.at(w)[0][queue] <= token < self.at(w + 1)[0][queue]:
                return w
        lo, hi = 0, self.windows
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if self.at(mid)[0][queue] <= token else (lo, mid)
        return lo

    def pieces(self, queue: int, start: int, n: int, length: int, guess: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(start in the document, tokens, sequence, offset, window) of a run of a queue."""
        at, w = start, guess
        while at < start + n:
            w = self.window_of(queue, at, w)
            before, total = self.at(w)
            after, _ = self.at(w + 1)
            g = total + self.upto(w + 1)[queue] - self.upto(w)[queue] + at - before[queue]
            end = min(start + n, after[queue])
            while at < end:
                take = min(end - at, length - g % length)
                yield at - start, take, g // length, g % length, w
                at, g = at + take, g + take


def queues_of(docs: DataFrame, source_col: str, weights: dict[str | None, int] | None) -> tuple[Column, dict[str, int]]:
    """The queue of a row, and the weights of queues that do not count 1."""
    own = F.when(col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), col(source_col).cast("string")))
    shares = {"-" if s is None else f"+{s}": w for s, w in (weights or {}).items()}
    if docs.select(col(source_col)).distinct().count() <= MOST_QUEUES:
        return own, shares
    # half of the queues, and more for weights, are single sources'; the others are shared
    sizes = docs.groupBy(own.alias("queue")).agg(F.count("*").alias("n"))
    apart = set(shares)
    for r in sizes.orderBy(F.desc("n"), "queue").limit(MOST_QUEUES // 2).collect():
        if len(apart) < max(len(shares), MOST_QUEUES // 2):
            apart.add(r["queue"])
    shared = F.concat(F.lit("#"), F.pmod(F.xxhash64(own), F.lit(max(MOST_QUEUES - len(apart), 1))).cast("string"))
    queue = F.when(own.isin(sorted(apart)), own).otherwise(shared)
    if not weights:
        return queue, {}
    # "#..." is no single source's: those are "-" or begin with "+"
    sources = docs.select(own.alias("own"), queue.alias("queue")).where(F.col("queue").startswith("#")).distinct()
    return queue, shares | {r["queue"]: r["count"] for r in sources.groupBy("queue").count().collect()}


def tokens(docs: DataFrame, ranks: bytes, pattern: str, special: dict[str, int] | None, end_id: int, id_col: str,
           text_col: str, queue: Column) -> tuple[DataFrame, np.dtype]:
    """doc_id, queue, part, place (tokens of the queue before it in the partition), n, ids."""
    src = docs.select(col(id_col).alias("doc_id"), queue.alias("queue"), col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    dtype = np.dtype("<u4") if max((special or {}).values(), default=0) >= 1 << 16 else id_type(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, placed = Encoder(shared.value, pattern, special), TaskContext.get().partitionId(), {}
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for b in rows_in(batches, 256):
            ids = [enc.encode(t.as_py() or "") + end for t in b.column(2)]
            n = [len(x) // enc.dtype.itemsize for x in ids]
            queues, place = b.column(1).to_pylist(), []
            for q, k in zip(queues, n):
                place.append(placed.get(q, 0))
                placed[q] = place[-1] + k
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([part] * len(n), pa.int32()), pa.array(place, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "queue", "part", "place", "n", "ids"])

    return src.mapInArrow(run, f"doc_id {kind}, queue string, part int, place long, n long, ids binary"), dtype


def pack(docs: DataFrame, *, ranks: bytes, pattern: str, special: dict[str, int] | None = None, end_id: int = 1, length: int = 2048, window: int = 64,
         weights: dict[str | None, int] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, window_id. ``weights``: target shares by source, else the sources' own."""
    prepare(docs.sparkSession)
    queue, weight = queues_of(docs, source_col, weights)
    found, dtype = tokens(docs, ranks, pattern, special, end_id, id_col, text_col, queue)
    rows = stored(found, "packing-tokens")
    parts = rows.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(upto), F.lit(0))).checkpoint()
    queues = {r["queue"]: r["n"] for r in parts.groupBy("queue").agg(F.sum("n").alias("n")).orderBy("queue").collect()}
    number = {q: i for i, q in enumerate(queues)}  # at most MOST_QUEUES, or one more than the weights
    shares = [weight.get(q, 1) for q in queues] if weights else None
    plan = (list(queues.values()), shares, window * length)
    src = (rows.join(bounded(parts.select("queue", "part", "base")), ["queue", "part"])
           .select("doc_id", "queue", (F.col("base") + F.col("place")).alias("begin"), "n", "ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        robin, last = RoundRobin(*plan), {}
        for b in rows_in(batches, 512):
            row, cut, ids = [], [], []
            for i, (q, begin, n, raw) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 4)))):
                wide = np.frombuffer(raw, dtype).astype("<u4")
                k = number[q]
                for p in robin.pieces(k, begin, n, length, last.get(k, 0)):
                    row.append(i)
                    cut.append((p[0], p[1], n, p[2], p[3], p[4]))
                    ids.append(wide[p[0]:p[0] + p[1]].tobytes())
                    last[k] = p[4]
            c = [pa.array(x, pa.int64()) for x in np.array(cut, dtype=np.int64).reshape(-1, 6).T]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int32())), c[0], c[1],
                                              pa.array(ids, pa.binary()), *c[2:]], names)

    return src.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                               "sequence_id long, offset long, window_id long")


def sequences(pieces: DataFrame, *, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (binary, padded to ``length`` unless
    n_tokens is a power of two). A group holds at most ``length`` tokens."""
    put = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    s = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), put.alias("put"))
    ids = F.aggregate(F.col("put"), F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    even = F.bit_count("n_tokens") == 1
    hole = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(length) - F.col("n_tokens")).cast("int")))
    return s.select("sequence_id", "n_tokens", F.when(even, ids).otherwise(F.concat(ids, hole)).alias("ids"))
