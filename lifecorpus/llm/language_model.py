"""Whole-document log-likelihood from a gated recurrent language model.

Words of the training fold are counted over the whole corpus. The ``VOCABULARY`` most
frequent ones and the end of a document have ids and stand in classes of ``CLASS_SIZE``
neighbours in frequency; all other words share 16 tail classes by their shape. A gated
recurrent unit reads a document, and from its state the probability of the next word is
that of its class times that of the word in its class: a softmax in both steps for words
with ids; in a tail class ``(c + 1) / (N + V + 1)`` over the class's own counts, where an
unknown word counts as one further member. All of it sums to one over what can come next.

Training runs in rounds on all partitions of the training documents: windows of ``STEPS``
tokens with truncated backpropagation, from the round's common weights; the weights that
the partitions end with are averaged, weighted by tokens, in two steps of a tree. A document
belongs to one round, whole, so the rounds together train on every token of every document
once. Lanes of much the same length read documents one after the other, window after window,
with the state handed on as in scoring and the gradient cut at the window. The weights move
once for four windows; fewer tokens, at the end of a partition, move them by their share.
Weights start where the model equals the word counts. Scores depend on how the input is
partitioned, as copies are averaged.

Texts are cut into words and words looked up by Arrow, some MB at a time.

Scoring runs documents in lanes, window by window, with the state carried from one to the
next, so a document of any length is scored as a whole. Counts of rare words are joined by
a shuffle, as the table of words grows with the corpus; only the ``COMMON`` most frequent
are broadcast.

Defined cases: a null or empty text is the end token alone; a null id is in the training
fold; repeated rows are scored each; without training documents every count is zero.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifecorpus.llm.common import SPACE, col, fold, prepare, stored

VOCABULARY, CLASS_SIZE, TAILS, COMMON = 4096, 64, 16, 262_144
HIDDEN, STEPS, LANES = 16, 32, 128
#: Bytes of text cut into words at a time, words a task counts before it hands them on, and tokens it
#: scores at a time.
PIECE, COUNTED, SCORED = 1 << 22, 2_000_000, 3_000_000
#: Tokens of whole documents dealt to lanes at a time in training.
HELD = 4_000_000
#: Weights in one row of the averaging or moved at a time, and rows of a product over all classes: a core's cache holds them.
CHUNK, ROWS = 16_384, 512
#: Classes of at most so many rows, and those of up to twice, four times as many, are a product each.
BLOCK_ROWS = 16
END = b" "  # no word holds a space
NONE = 0xFFFF
#: Largest output weight.
LIMIT = 3.0


def pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(row, number of words, words) of pieces of texts in order, about PIECE bytes at a time; rows without
    words stay out. Words are bytes, A-Z lower-cased; a text longer than a piece is cut between words."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    if edges[0] == edges[-1]:
        return
    data, row, starts = texts.buffers()[2], [], []
    for k in np.flatnonzero(np.diff(edges)).tolist():
        at, end = int(edges[k]), int(edges[k + 1])
        while True:
            row.append(k)
            starts.append(at)
            gap = SPACE.search(data, at + PIECE, end) if end - at > PIECE else None
            if gap is None:
                break
            at = gap.start()
    row, cuts = np.array(row), np.array([*starts, edges[-1]], np.int32)
    i = 0
    while i < len(row):
        j = max(i + 1, int(np.searchsorted(cuts, int(cuts[i]) + PIECE, side="right")) - 1)
        some = data.slice(int(cuts[i]), int(cuts[j] - cuts[i]))  # lower-casing wants offsets from 0
        some = pa.Array.from_buffers(pa.string(), j - i, [None, pa.py_buffer(cuts[i:j + 1] - cuts[i]), some])
        found = pc.ascii_split_whitespace(pc.ascii_lower(some))
        words, n = found.flatten().view(pa.binary()), np.diff(found.offsets.to_numpy())
        full = pc.binary_length(words).to_numpy() > 0  # white space at the ends leaves empty ones
        if not full.all():
            n = np.diff(np.r_[0, np.cumsum(full)][np.r_[0, np.cumsum(n)]])
            words = words.filter(pa.array(full))
        yield row[i:j], n, words
        i = j


STOPS = np.isin(np.arange(256), list(b".,;:!?"))


def shapes(words: pa.Array) -> np.ndarray:
    """The tail classes of words: beyond ASCII or not, ends with a stop or not, length."""
    if not len(words):
        return np.zeros(0, np.int32)
    edges = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    last = np.frombuffer(words.buffers()[2], np.uint8)[edges[1:] - 1]
    beyond = ~pc.string_is_ascii(words.view(pa.string())).to_numpy(zero_copy_only=False)
    return (8 * beyond + 4 * STOPS[last] + np.searchsorted([5, 8, 12], np.diff(edges), side="right")).astype(np.int32)


def shape(word: bytes) -> int:
    return int(shapes(pa.array([word], pa.binary()))[0])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, tail, c) of ``docs`` (text); the end of each document is a word of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, ends = [], 0, 0

        def out() -> pa.RecordBatch:
            c = pa.chunked_array(held, pa.binary()).value_counts()
            words = pa.concat_arrays([c.field("values"), pa.array([END], pa.binary())])
            return pa.RecordBatch.from_arrays([words, pa.array(shapes(words)), pa.concat_arrays([c.field("counts"), pa.array([ends], pa.int64())])],
                                              ["word", "tail", "c"])
        for b in batches:
            ends += b.num_rows
            for _, _, words in pieces(b.column(0)):
                held.append(words)
                n += len(words)
                if n >= COUNTED:
                    yield out()
                    held, n, ends = [], 0, 0
        if held or ends:
            yield out()

    return docs.mapInArrow(run, "word binary, tail int, c long").groupBy("word", "tail").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Ids of frequent words, counts of common ones, and the sums of all."""
    words: list[bytes]
    counts: np.ndarray  # by id; fillers of the last class have -1
    common: dict[bytes, int]  # further words of which the count is known everywhere
    tail_tokens: np.ndarray
    tail_words: np.ndarray
    tokens: int
    kinds: int

    @property
    def size(self) -> int:
        return len(self.counts)


def common_words(counts: DataFrame) -> list[tuple[bytes, int, int]]:
    """(word, tail, c) of the words that occur at least so often that no more than COMMON do.

    The level is found on the number of words by count, so no task sends more than its share."""
    level, total = None, 0
    for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(COMMON).collect():
        total += r["n"]
        if total > COMMON:
            break
        level = r["c"]
    if level is None:
        return []
    rows = counts.where(F.col("c") >= level).select("word", "tail", "c").toArrow()
    return sorted(zip(*(c.to_pylist() for c in rows.columns)), key=lambda x: (-x[2], x[0]))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Collects up to COMMON words and one sum per tail class."""
    sums = {r["tail"]: r for r in counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    top = common_words(counts)
    end = next((c for w, _, c in top if w == END), 0)
    if not end and sums:
        end = counts.where(F.col("word") == F.lit(END)).agg(F.sum("c")).first()[0] or 0
    ranked = [(END, shape(END), end)] + [x for x in top if x[0] != END]
    mine, rest = ranked[:VOCABULARY], ranked[VOCABULARY:]
    size = -(-len(mine) // CLASS_SIZE) * CLASS_SIZE
    c = np.full(size, -1, np.int64)
    c[:len(mine)] = [x[2] for x in mine]
    n, v = np.zeros(TAILS), np.zeros(TAILS)
    for t, r in sums.items():
        n[t], v[t] = r["n"], r["v"]
    for _, t, k in mine:
        if k:
            n[t] -= k
            v[t] -= 1
    return Vocabulary([x[0] for x in mine], c, {w: k for w, _, k in rest}, n, v,
                      int(sum(r["n"] for r in sums.values())), int(sum(r["v"] for r in sums.values())))


class Ids:
    """Words to ids; words without one have their tail class's."""

    def __init__(self, v: Vocabulary, common: bool = False):
        self.base, self.n = v.size, len(v.words)
        self.words, self.common = pa.array(v.words, pa.binary()), pa.array(v.common if common else (), pa.binary())

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, place among the vocabulary and then, if asked for, the common words; -1: in neither)."""
        ids = pc.index_in(words, self.words).fill_null(-1).to_numpy().copy()
        tail, place = np.flatnonzero(ids < 0), ids.copy()
        words = words.take(pa.array(tail))
        place[tail] = pc.add(pc.index_in(words, self.common), self.n).fill_null(-1).to_numpy()
        ids[tail] = self.base + shapes(words)
        return ids, place

    def documents(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text with its end, which has id 0."""
        parts: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
        for row, n, words in pieces(texts):
            ids = self.of(words)[0]
            for k, x in zip(row.tolist(), np.split(ids, np.cumsum(n)[:-1])):
                parts[k].append(x)
        end = np.zeros(1, np.int32)
        return [np.concatenate([*x, end]) for x in parts]


class Model:
    """The network's weights in one flat array, and views of them."""

    def __init__(self, size: int, flat: np.ndarray | None = None):
        self.size, self.classes, self.rooms = size, size // CLASS_SIZE, {}
        h, c = HIDDEN, self.classes
        shapes = {"x": (size + TAILS, 3 * h), "u": (h, 2 * h), "un": (h, h), "wc": (h, c + TAILS), "bc": (c + TAILS,),
                  "ww": (c, h, CLASS_SIZE), "bw": (c, CLASS_SIZE)}
        n = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(n, np.float32) if flat is None else flat
        at = 0
        for name, s in shapes.items():
            setattr(self, name, self.flat[at:at + int(np.prod(s))].reshape(s))
            at += int(np.prod(s))

    @classmethod
    def first(cls, v: Vocabulary) -> Model:
        """Small random weights; biases that give the word counts."""
        m, rng = cls(v.size), np.random.default_rng(7)
        m.x[:] = rng.normal(0, 0.3, m.x.shape)
        m.u[:], m.un[:] = rng.normal(0, HIDDEN ** -0.5, m.u.shape), rng.normal(0, HIDDEN ** -0.5, m.un.shape)
        m.wc[:], m.ww[:] = rng.normal(0, 0.02, m.wc.shape), rng.normal(0, 0.02, m.ww.shape)
        mass = np.where(v.counts >= 0, v.counts + 1.0, 1e-20).reshape(m.classes, CLASS_SIZE)
        m.bw[:] = np.log(mass / mass.sum(1, keepdims=True))
        both = np.concatenate([mass.sum(1), v.tail_tokens + v.tail_words + 1])
        m.bc[:] = np.log(both / both.sum())
        return m

    def step(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        x = self.x[ids]
        zr = 1 / (1 + np.exp(-(x[:, :2 * HIDDEN] + h @ self.u)))
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        rh = r * h
        n = np.tanh(x[:, 2 * HIDDEN:] + rh @ self.un)
        return h + z * (n - h), z, r, rh, n

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array of any values that the next call with this name uses again: memory that goes back
        to the system with every window costs more than the work in it."""
        n = int(np.prod(shape))
        if len(self.rooms.get(name, "")) < n:
            self.rooms[name] = np.empty(n, self.flat.dtype)
        return self.rooms[name][:n].reshape(shape)

    def outputs(self, states: np.ndarray, targets: np.ndarray, grad: Model | None = None):
        """Natural log probabilities of ``targets`` and, with ``grad``, the gradient of the states.

        States lie in (-1, 1) and weights within LIMIT, so no exponential overflows. A last state of
        one stands for the biases. Each class has its rows in a block, filled up with zeros to the
        height of the blocks of about its size, which are one product."""
        which, rows = np.where(targets < self.size, targets // CLASS_SIZE, targets - self.size + self.classes), np.arange(len(targets))
        x = self.room("x", len(targets), HIDDEN + 1)
        x[:, :HIDDEN], x[:, HIDDEN] = states, 1
        w, one, logp = np.vstack([self.wc, self.bc]), np.ones(self.classes + TAILS, x.dtype), np.empty(len(targets), x.dtype)
        d_states = None if grad is None else self.room("d_states", *states.shape)
        for i in range(0, len(targets), ROWS):
            mine, y, k = x[i:i + ROWS], which[i:i + ROWS], rows[:len(targets[i:i + ROWS])]
            a = np.matmul(mine, w, out=self.room("a", len(mine), len(one)))
            own = a[k, y]
            np.exp(a, out=a)
            s = a @ one
            np.subtract(own, np.log(s), out=logp[i:i + ROWS])
            if grad is not None:
                a[k, y] -= s  # the narrow arrays beside it are divided by s
                share = 1 / s[:, None]
                d = (mine * share).T @ a
                grad.wc += d[:HIDDEN]
                grad.bc += d[HIDDEN]
                np.matmul(a, self.wc.T, out=d_states[i:i + ROWS])
                d_states[i:i + ROWS] *= share
        n = np.bincount(which, minlength=self.classes)[:self.classes]
        c = np.flatnonzero(n)
        if not len(c):
            return logp.astype(np.float64), d_states
        level = np.ceil(np.log2(np.maximum(n[c], BLOCK_ROWS) / BLOCK_ROWS))
        by = np.argsort(level, kind="stable")
        c, level, n = c[by], level[by], n[c[by]]
        place = np.full(self.classes + TAILS, len(c), np.uint16)
        place[c] = np.arange(len(c))
        order = np.argsort(place[which], kind="stable")[:n.sum()]
        cut = np.flatnonzero(np.r_[True, level[1:] != level[:-1], True])
        high = np.repeat(np.maximum.reduceat(n, cut[:-1]), np.diff(cut))
        start = np.cumsum(high) - high
        at, inside = rows[:len(order)] + np.repeat(start - (np.cumsum(n) - n), n), targets[order] % CLASS_SIZE
        total = int(high.sum())
        block, b, w = self.room("block", total, HIDDEN + 1), self.room("b", total, CLASS_SIZE), self.room("w", len(c), HIDDEN + 1, CLASS_SIZE)
        block[:] = 0
        block[at] = x[order]
        w[:, :HIDDEN], w[:, HIDDEN] = self.ww[c], self.bw[c]
        # (classes, rows of their blocks, blocks) of each product
        products = [(slice(i, j), slice(start[i], start[i] + (j - i) * high[i]), (j - i, high[i], -1)) for i, j in zip(cut, cut[1:])]
        for i, r, like in products:
            np.matmul(block[r].reshape(like), w[i], out=b[r].reshape(like))
        own = b[at, inside]
        np.exp(b, out=b)
        s = b @ np.ones(CLASS_SIZE, a.dtype)
        logp[order] += own - np.log(s[at])
        if grad is not None:
            b[at, inside] -= s[at]
            s = 1 / s[:, None]
            block *= s
            d, back = self.room("d", *w.shape), self.room("back", *block.shape)
            for i, r, like in products:
                np.matmul(block[r].reshape(like).transpose(0, 2, 1), b[r].reshape(like), out=d[i])
                np.matmul(b[r].reshape(like), w[i].transpose(0, 2, 1), out=back[r].reshape(like))
            grad.ww[c] += d[:, :HIDDEN]
            grad.bw[c] += d[:, HIDDEN]
            back *= s
            d_states[order] += back[at, :HIDDEN]
        return logp.astype(np.float64), d_states

    def gates(self) -> np.ndarray:
        """The gates' weights of the state, a matrix each."""
        return np.ascontiguousarray(self.u.reshape(HIDDEN, 2, HIDDEN).transpose(1, 0, 2))

    def read(self, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """(states, gates, gated states, candidates) of a (steps x lanes) window, as ``step`` has them.

        ``state`` is replaced by what the window leaves; it begins anew where the end (0) is read."""
        (steps, lanes), kind = inputs.shape, self.flat.dtype
        over = (inputs == 0).any(1).tolist()
        own = np.take(self.x, inputs, axis=0, out=self.room("own", steps, lanes, 3 * HIDDEN), mode="clip")
        x = self.room("inputs", steps, 3, lanes, HIDDEN)
        own = own.reshape(steps, lanes, 3, HIDDEN).transpose(0, 2, 1, 3)
        np.negative(own[:, :2], out=x[:, :2])
        x[:, 2] = own[:, 2]
        u, un, more = -self.gates(), self.un, np.empty((lanes, HIDDEN), kind)
        states, rh, n = (self.room(k, steps, lanes, HIDDEN) for k in ("states", "rh", "n"))
        zr, h = self.room("zr", steps, 2, lanes, HIDDEN), state
        for t in range(steps):
            if over[t]:
                h = h * (inputs[t] != 0).astype(kind)[:, None]
            g, a = zr[t], n[t]
            np.matmul(h, u, out=g)
            g += x[t, :2]
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            np.matmul(np.multiply(g[1], h, out=rh[t]), un, out=a)
            a += x[t, 2]
            np.tanh(a, out=a)
            np.subtract(a, h, out=more)
            more *= g[0]
            h = np.add(h, more, out=states[t])
        state[:] = h
        return states, zr, rh, n

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, grad: Model, state: np.ndarray | None = None) -> float:
        """Adds the gradient of the summed loss over a (steps x lanes) window, which is returned; NONE
        targets do not count.

        ``state``: what the window before left, replaced by what this one leaves (None: zero). The
        state begins anew where the end (0) is read, as in scoring."""
        (steps, lanes), kind = inputs.shape, self.flat.dtype
        keep, over = (inputs != 0).astype(kind)[:, :, None], (inputs == 0).any(1).tolist()
        state = np.zeros((lanes, HIDDEN), kind) if state is None else state
        before = self.room("before", steps, lanes, HIDDEN)
        before[0] = state
        states, zr, rh, n = self.read(inputs, state)
        before[1:] = states[:-1]
        before *= keep
        ok = targets.ravel() != NONE
        if ok.all():
            logp, d = self.outputs(states.reshape(-1, HIDDEN), targets.ravel(), grad)
        else:
            logp, some = self.outputs(states.reshape(-1, HIDDEN)[ok], targets.ravel()[ok], grad)
            d = np.zeros((steps * lanes, HIDDEN), kind)
            d[ok] = some
        d = d.reshape(steps, lanes, HIDDEN)
        u, un = np.ascontiguousarray(self.gates().transpose(0, 2, 1)), np.ascontiguousarray(self.un.T)
        z, r = zr[:, 0], zr[:, 1]
        stay = 1 - z
        to_n, to_z, to_r = z * (1 - n * n), (n - before) * z * stay, before * r * (1 - r)
        dh, drh, both = np.zeros((lanes, HIDDEN), kind), np.empty((lanes, HIDDEN), kind), np.empty((2, lanes, HIDDEN), kind)
        dx = self.room("dx", steps, 3, lanes, HIDDEN)
        for t in range(steps - 1, -1, -1):
            g = dx[t]
            dh += d[t]
            np.matmul(np.multiply(dh, to_n[t], out=g[2]), un, out=drh)
            np.multiply(dh, to_z[t], out=g[0])
            np.multiply(drh, to_r[t], out=g[1])
            dh *= stay[t]
            drh *= r[t]
            dh += drh
            np.matmul(g[:2], u, out=both)
            dh += both[0]
            dh += both[1]
            if over[t]:
                dh *= keep[t]
        own = self.room("own", steps, lanes, 3, HIDDEN)
        own[:] = dx.transpose(0, 2, 1, 3)
        flat = own.reshape(-1, 3 * HIDDEN)
        grad.un += rh.reshape(-1, HIDDEN).T @ flat[:, 2 * HIDDEN:]
        grad.u += before.reshape(-1, HIDDEN).T @ flat[:, :2 * HIDDEN]
        ids = inputs.ravel().astype(np.uint16)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        grad.x[ids[first]] += np.add.reduceat(np.take(flat, order, axis=0, out=self.room("inputs", *flat.shape), mode="clip"), first)
        return -float(logp.sum())


class Adam:
    """Moments are kept as sums (10 and 100 times the usual means), in parts that a core's cache holds."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.t = model, rate, 0
        self.m, self.v = (np.zeros_like(model.flat) for _ in range(2))

    def update(self, g: np.ndarray, count: float = 1.0, share: float = 1.0) -> None:
        """One step along ``g / count``; ``g`` is zero afterwards; ``share``: of a full window's tokens."""
        self.t += 1
        scale = 1 / count
        norm = float(np.linalg.norm(g)) * scale
        if norm > 1:
            scale /= norm
        rate = self.rate * share * float(np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t))
        for i in range(0, len(g), CHUNK):
            x, m, v, w = (a[i:i + CHUNK] for a in (g, self.m, self.v, self.model.flat))
            x *= scale
            m *= 0.9
            m += x
            x *= x
            v *= 0.99
            v += x
            np.sqrt(v, out=x)
            x += 1e-6
            np.divide(m, x, out=x)
            x *= rate
            w -= x
            x[:] = 0
        if self.t % 128 == 0:  # numbers near the least float are slow
            for x in (self.m, self.v):
                x[np.abs(x) < 1e-29] = 0
        for w in (self.model.wc, self.model.ww):
            np.clip(w, -LIMIT, LIMIT, out=w)


def training_documents(docs: DataFrame, v, rounds: int) -> DataFrame:
    """(round, ids): per row the ids of many whole documents, each with its end. ``v``: broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, turn = Ids(v.value), TaskContext.get().partitionId()
        for b in batches:
            found: list[list[bytes]] = [[] for _ in range(rounds)]
            for x in ids.documents(b.column(0)):
                found[turn % rounds].append(x.astype("<u2").tobytes())
                turn += 1
            yield pa.RecordBatch.from_arrays([pa.array(range(rounds), pa.int32()),
                                              pa.array([b"".join(x) for x in found], pa.binary())], ["round", "ids"])
    return docs.mapInArrow(run, "round int, ids binary")


def in_lanes(lengths: list[int], lanes: int) -> list[list[int]]:
    """Documents dealt to lanes of much the same length: the longest first, each to the shortest lane.
    A lane has its documents in the order given; the longest lane comes first."""
    loads, found = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
    for d in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n, k = heapq.heappop(loads)
        found[k].append(d)
        heapq.heappush(loads, (n + lengths[d], k))
    return [sorted(found[k]) for _, k in sorted(loads, key=lambda x: (-x[0], x[1]))]


def windows(lanes: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(inputs, targets), both (STEPS x lanes), of lanes of documents with their ends, the longest lane
    first. NONE stands where a lane is over; the end (0) is read before a lane's first word."""
    last, most = np.zeros(len(lanes), np.int32), 64 * STEPS
    for t0 in range(0, len(lanes[0]), most):
        high = -(-min(len(lanes[0]) - t0, most) // STEPS) * STEPS
        block = np.full((high, len(lanes)), NONE, np.int32)
        for k, x in enumerate(lanes):
            some = x[t0:t0 + high]
            block[:len(some), k] = some
        for t in range(0, high, STEPS):
            targets = block[t:t + STEPS]
            inputs = np.vstack([last, targets[:-1]])
            last = targets[-1]
            yield np.where(inputs == NONE, 0, inputs), targets


def dealt(docs: Iterator[np.ndarray], lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(inputs, targets) of windows (STEPS x lanes). A lane reads a document from window to window,
    then the next one; every token is a target once. Documents are taken HELD tokens at a time, so
    that lanes end at much the same window."""
    held, n = [], 0

    def out() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        mine = in_lanes([len(d) for d in held], lanes)
        yield from windows([np.concatenate([held[d] for d in ds]) if ds else held[0][:0] for ds in mine])
    for d in docs:
        held.append(d)
        n += len(d)
        if n >= HELD:
            yield from out()
            held, n = [], 0
    if held:
        yield from out()


def learn(m: Model, docs: Iterator[np.ndarray], lanes: int, rate: float, together: int = 4) -> tuple[int, float]:
    """Trains ``m`` on all documents (ids with the end last); (tokens, sum of their losses).

    The weights move once for ``together`` windows. Where lanes are over, that takes more windows,
    until half as many tokens have come together, and at the end what is left moves them by its share."""
    best, g, seen, moved, n, loss = Adam(m, rate), Model(m.size), 0, 0, 0, 0.0
    state, full = np.zeros((lanes, HIDDEN), np.float32), lanes * STEPS * together
    for inputs, targets in dealt(docs, lanes):
        live = int((targets[0] != NONE).sum())
        loss += m.gradient(inputs[:, :live], targets[:, :live], g, state[:live])
        seen, n = seen + int((targets != NONE).sum()), n + 1
        if n >= together and 2 * (seen - moved) >= full:
            best.update(g.flat, seen - moved, min((seen - moved) / full, 1.0))
            moved, n = seen, 0
    if seen > moved:
        best.update(g.flat, seen - moved, min((seen - moved) / full, 1.0))
    return seen, loss


def averaged(spark, texts: DataFrame, model: Model, lanes: int, rate: float) -> Model:
    """One round: every partition trains a copy; the copies' mean by tokens."""
    shared = spark.sparkContext.broadcast((model.size, model.flat))  # the model's size is fixed
    schema = "chunk int, lane int, task int, weight double, values binary"
    names = ["chunk", "lane", "task", "weight", "values"]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, flat = shared.value
        m = Model(size, flat.copy())

        def read() -> Iterator[np.ndarray]:
            for b in batches:
                for x in b.column(0):
                    ids = np.frombuffer(x.as_py(), "<u2")
                    at = 0
                    for end in (np.flatnonzero(ids == 0) + 1).tolist():
                        yield ids[at:end]
                        at = end
        seen, _ = learn(m, read(), lanes, rate)
        if seen:
            task = TaskContext.get().partitionId()
            chunks = [m.flat[i:i + CHUNK].astype("<f4").tobytes() for i in range(0, len(m.flat), CHUNK)]
            for i, c in enumerate(chunks):
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([task % 16], pa.int32()),
                                                  pa.array([task], pa.int32()), pa.array([float(seen)]),
                                                  pa.array([c], pa.binary())], names)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for b in batches:
            for c, lane, _, w, x in zip(*(b.column(k).to_pylist() for k in range(5))):
                s = total.setdefault((c, lane), [0.0, 0.0])
                s[0] += w
                s[1] = s[1] + w * np.frombuffer(x, "<f4").astype(np.float64)
        for (c, lane), (w, x) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([lane], pa.int32()), pa.array([0], pa.int32()),
                                              pa.array([w]), pa.array([(x / w).astype("<f4").tobytes()], pa.binary())], names)

    own = texts.mapInArrow(train, schema)
    by_lane = own.repartition("chunk", "lane").sortWithinPartitions("chunk", "lane", "task").mapInArrow(mean, schema)
    by_chunk = (by_lane.withColumn("task", F.col("lane")).withColumn("lane", F.lit(0))
                .repartition("chunk").sortWithinPartitions("chunk", "task").mapInArrow(mean, schema))
    got = sorted((r["chunk"], bytes(r["values"])) for r in by_chunk.collect())  # one model
    return Model(model.size, np.frombuffer(b"".join(x for _, x in got), "<f4").copy()) if got else model


def fit(docs: DataFrame, *, text_col: str = "text", rounds: int = 3, lanes: int = 64,
        rate: float = 0.06) -> tuple[DataFrame, Vocabulary, Model]:
    """(word counts, vocabulary, weights) from the documents given."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(col(text_col).alias("text"))
    counts = stored(word_counts(texts), "words")
    v = vocabulary(counts)
    ids = stored(training_documents(texts, spark.sparkContext.broadcast(v), rounds), "training")
    model = Model.first(v)
    for r in range(rounds):
        model = averaged(spark, ids.where(F.col("round") == r).select("ids"), model, lanes, rate / (1 + r))
    return counts, v, model


def lane_log_likelihood(m: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of whole documents (ids with the end last)."""
    if not docs:
        return np.zeros(0)
    lanes = in_lanes([len(d) for d in docs], min(LANES, len(docs)))
    lines = [np.concatenate([docs[d] for d in ds]) for ds in lanes]
    first = np.cumsum([0] + [len(x) for x in lines])[:-1]
    out, state, t0 = np.empty(sum(map(len, lines))), np.zeros((len(lanes), HIDDEN), np.float32), 0
    for inputs, targets in windows(lines):
        live = int((targets[0] != NONE).sum())
        states = m.read(inputs[:, :live], state[:live])[0].reshape(-1, HIDDEN)
        mine = targets[:, :live].ravel()
        at = (np.arange(t0, t0 + STEPS)[:, None] + first[:live]).ravel()
        ok = mine != NONE
        if not ok.all():
            states, mine, at = states[ok], mine[ok], at[ok]
        out[at] = m.outputs(states, mine)[0]
        t0 += STEPS
    order = [d for ds in lanes for d in ds]
    total = np.empty(len(docs))
    total[order] = np.add.reduceat(out, np.cumsum([0] + [len(docs[d]) for d in order])[:-1])
    return total


def score(docs: DataFrame, counts: DataFrame, v: Vocabulary, model: Model, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((v, model.size, model.flat))
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, size, flat = shared.value
        m, ids = Model(size, flat), Ids(vocab, common=True)
        norm = np.log10(vocab.tokens + vocab.kinds + 1)
        # by id: log count, counted or not, log norm of the tail class; by place: log count
        log_c = np.r_[np.log10(np.maximum(vocab.counts, 0) + 1.0), np.zeros(TAILS)]
        counted = np.r_[vocab.counts > 0, np.zeros(TAILS, bool)].astype(np.int64)
        tail_norm = np.r_[np.zeros(size), np.log10(vocab.tail_tokens + vocab.tail_words + 1)]
        common = np.r_[np.zeros(ids.n), np.log10(np.array([*vocab.common.values()], np.int64) + 1.0)]
        held, held_tokens = [], 0

        def flush() -> pa.RecordBatch:
            doc_id, xs, tail_log, tail_known, rare = zip(*held)
            xs, tail_log = [x for some in xs for x in some], np.concatenate(tail_log)
            edges, cuts = np.cumsum([0, *map(len, xs)]), [0]
            while cuts[-1] < len(xs):
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(edges, edges[cuts[-1]] + SCORED, side="right")) - 1))
            ln = np.concatenate([lane_log_likelihood(m, xs[i:j]) for i, j in zip(cuts, cuts[1:])])
            x, first, n = np.concatenate(xs), edges[:-1], np.diff(edges)
            known = np.add.reduceat(counted[x], first) + np.concatenate(tail_known)
            base = np.add.reduceat(log_c[x], first) + tail_log - n * norm
            net = ln / np.log(10) + tail_log - np.add.reduceat(tail_norm[x], first)
            return pa.RecordBatch.from_arrays([pa.concat_arrays(doc_id), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base),
                                               pa.array(net), pa.concat_arrays(rare)], ["doc_id", "n_tokens", "n_known", "base", "net", "rare"])

        for b in batches:
            rows, end = b.num_rows, np.zeros(1, np.int32)
            tail_log, tail_known, missing = np.zeros(rows), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            parts: list[list[np.ndarray]] = [[] for _ in range(rows)]
            rare = [pa.array([], pa.binary())]
            for row, n, words in pieces(b.column(1)):
                x, place = ids.of(words)
                for k, some in zip(row.tolist(), np.split(x, np.cumsum(n)[:-1])):
                    parts[k].append(some)
                owner, tail, late = np.repeat(row, n), place >= ids.n, place < 0
                tail_log += np.bincount(owner[tail], weights=common[place[tail]], minlength=rows)
                tail_known += np.bincount(owner[tail], minlength=rows)
                missing += np.bincount(owner[late], minlength=rows)
                rare.append(words.filter(pa.array(late)))
            xs = [np.concatenate([*some, end]) for some in parts]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(missing)], pa.int32()), pa.concat_arrays(rare))
            held.append((b.column(0), xs, tail_log, tail_known, lists))
            held_tokens += sum(map(len, xs))
            if held_tokens >= SCORED:
                yield flush()
                held, held_tokens = [], 0
        if held_tokens:
            yield flush()

    first = src.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base double, net double, rare array<binary>")
    first = stored(first.withColumn("row", F.monotonically_increasing_id()), "scored")
    words = first.select("row", F.explode("rare").alias("word"))
    late = (words.join(counts.select("word", "c"), "word").groupBy("row")
            .agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("found")))
    out = first.drop("rare").join(late, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
                      F.lit(v.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
                      (F.col("net") + more).alias("score"))


def scored(docs: DataFrame, *, mod: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Learn from the documents whose fold is not ``held`` and score all of them."""
    part = fold(col(id_col), mod) == held
    counts, v, model = fit(docs.where(~part), text_col=text_col, **how)
    out = score(docs, counts, v, model, id_col=id_col, text_col=text_col)
    return out.select("doc_id", (fold(F.col("doc_id"), mod) == held).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
