"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is a position of a chain with two states, bad and good.
Its features are those of the line and of its two neighbours; a two by two
matrix scores the step from one line to the next. Forward-backward gives each
line's marginal probability of being good, and a document's score is their mean
weighted by line length, passed through a fitted logistic curve.

Lines carry no labels of their own, so a labelled document's lines all take its
label in training. The model is fitted in one task on a bounded sample:
``sample_docs`` labelled documents drawn by a hash of the id, none longer than
``sample_chars``; only its weights come to the driver. Scoring reads every whole text.

Defined cases: a null or empty text is one empty line and gets a score like any
other; a null id belongs to the training side but never joins a label; several
labels of one document count as the highest; with no labelled rows or one class
only, every score is the share of good labels (0.5 without any).
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, fold

#: Code points handled at once when a line's character classes are counted.
BLOCK = 1 << 20


@dataclass
class Crf:
    """Weights of one state against the other, the step matrix, and the curve of a document's score."""
    mean: np.ndarray
    scale: np.ndarray
    unary: np.ndarray
    step: np.ndarray
    curve: tuple[float, float]
    constant: float | None = None


#: Upper case, lower case, digit, '!', '|', other sign, beyond ASCII, plain (space, tab, newline, comma, full stop).
KINDS = np.full(129, 5)
KINDS[65:91], KINDS[97:123], KINDS[48:58], KINDS[33], KINDS[124], KINDS[128] = 0, 1, 2, 3, 4, 6
KINDS[[32, 9, 10, 44, 46]] = 7


def kind_counts(text: str, lines: int) -> np.ndarray:
    """(lines x 8): how many code points of each kind every line of ``text`` has."""
    total, base = np.zeros((lines, 8)), 0
    for i in range(0, len(text), BLOCK):
        c = np.frombuffer(text[i:i + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        line = np.cumsum(c == 10)
        n = int(line[-1]) + 1
        total[base:base + n] += np.bincount(line * 8 + KINDS[np.minimum(c, 128)], minlength=8 * n).reshape(n, 8)
        base += n - 1
    return total


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: (lines x features of the line and its two neighbours, line lengths as weights)."""
    split = [(t or "").split("\n") for t in texts]
    lines = [x for one in split for x in one]
    count = kind_counts("\n".join(t or "" for t in texts), len(lines))
    n = np.array([len(x) for x in lines], dtype=np.float64)
    k, kinds, again, end, start, dup = (np.zeros(len(lines)) for _ in range(6))
    i = 0
    for one in split:
        seen: set[str] = set()
        for x in one:
            words = x.split()
            k[i], kinds[i] = len(words), len(set(words))
            again[i] = sum(map(eq, words, words[1:]))
            if words:
                end[i], start[i] = words[-1][-1] in ".!?", x[:1].isupper()
                dup[i] = x in seen
                seen.add(x)
            i += 1
    d, w, letters = np.maximum(n, 1), np.maximum(k, 1), np.maximum(count[:, 0] + count[:, 1], 1)
    own = np.stack([np.log1p(n) / 10, count[:, 0] / letters, count[:, 2] / d, 10 * count[:, 3] / d, 10 * count[:, 4] / d,
                    10 * count[:, 5] / d, count[:, 6] / d, (n - k) / w / 10, kinds / w, again / np.maximum(k - 1, 1),
                    (count[:, 0] > 0.5 * letters).astype(float), end, start, dup, (n == 0).astype(float)], 1)
    out, i = [], 0
    pad = np.zeros((1, own.shape[1]))
    for one in split:
        o = own[i:i + len(one)]
        out.append((np.hstack([o, np.vstack([pad, o[:-1]]), np.vstack([o[1:], pad])]), d[i:i + len(one)]))
        i += len(one)
    return out


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))


def forward_backward(unary: list[np.ndarray], step: np.ndarray):
    """Over chains of any length at once: node marginals of state 1 per chain, the
    summed step marginals, and the summed log partition. ``unary``: a chain's
    scores of state 1 (state 0 scores zero)."""
    order = np.argsort([-len(u) for u in unary], kind="stable")
    lens = np.array([len(unary[i]) for i in order])
    offs = np.concatenate([[0], np.cumsum(lens)])[:-1]
    flat = np.concatenate([unary[i] for i in order])
    node = np.stack([np.zeros_like(flat), flat], 1)
    fwd, bwd = np.empty_like(node), np.zeros_like(node)
    active = [int((lens > t).sum()) for t in range(lens[0])]  # chains are longest first
    fwd[offs] = node[offs]
    for t in range(1, lens[0]):
        at = offs[:active[t]] + t
        fwd[at] = node[at] + _log_add(fwd[at - 1][:, :, None] + step[None], 1)
    for t in range(lens[0] - 2, -1, -1):
        at = offs[:active[t + 1]] + t
        bwd[at] = _log_add(step[None] + (node[at + 1] + bwd[at + 1])[:, None, :], 2)
    log_z = _log_add(fwd[offs + lens - 1], 1)
    z = np.repeat(log_z, lens)
    marginal = np.exp(fwd[:, 1] + bwd[:, 1] - z)
    inner = np.ones(len(flat), bool)
    inner[offs + lens - 1] = False
    at = np.flatnonzero(inner)
    steps = np.exp(fwd[at][:, :, None] + step[None] + (node[at + 1] + bwd[at + 1])[:, None, :] - z[at][:, None, None])
    out: list[np.ndarray] = [np.empty(0)] * len(unary)
    for k, i in enumerate(order):
        out[i] = marginal[offs[k]:offs[k] + lens[k]]
    return out, steps.sum(0), float(log_z.sum())


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _aggregate(marginals: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    return np.array([np.average(m, weights=w) for m, w in zip(marginals, weights)])


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 60, rate: float = 0.2,
        l2: float = 1e-3) -> Crf:
    """Maximum conditional likelihood by Adam; each document weighs the same."""
    if len(labels) == 0 or labels.min() == labels.max():
        return Crf(np.zeros(0), np.ones(0), np.zeros(0), np.zeros((2, 2)), (1.0, 0.0),
                   constant=float(labels.mean()) if len(labels) else 0.5)
    x = np.vstack([f for f, _ in docs])
    lens = np.array([len(f) for f, _ in docs])
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    cuts = np.cumsum(lens)[:-1]
    y = np.repeat(labels, lens).astype(float)
    share = np.repeat(1.0 / lens, lens)
    inner = np.ones(len(y), bool)
    inner[np.cumsum(lens) - 1] = False
    seen = np.zeros((2, 2))
    for s in (0, 1):
        seen[s, s] = float((inner & (y == s)).sum())
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    m = [np.zeros_like(w), np.zeros_like(step)]
    v = [np.zeros_like(w), np.zeros_like(step)]
    for t in range(1, rounds + 1):
        marg, steps, _ = forward_backward(np.split(x @ w, cuts), step)
        g_w = -(x.T @ ((y - np.concatenate(marg)) * share)) / len(docs) + l2 * w
        g_s = -(seen - steps) / max(seen.sum(), 1.0) + l2 * step
        for p, g, a, b in ((w, g_w, m[0], v[0]), (step, g_s, m[1], v[1])):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)
    marg, _, _ = forward_backward(np.split(x @ w, cuts), step)
    z = _logit(_aggregate(marg, [k for _, k in docs]))
    a, b = 1.0, 0.0
    for _ in range(300):  # the curve: logistic regression on one value, a little regularised towards a = 1
        p = 1 / (1 + np.exp(-(a * z + b)))
        g = np.array([((p - labels) * z).mean() + 0.01 * (a - 1), (p - labels).mean()])
        s = p * (1 - p)
        h = np.array([[(s * z * z).mean() + 0.01, (s * z).mean()], [(s * z).mean(), s.mean() + 1e-4]])
        d = np.linalg.solve(h, g)
        a, b = a - np.clip(d[0], -1, 1), b - np.clip(d[1], -1, 1)
    return Crf(mean, scale, w, step, (float(max(a, 0.05)), float(b)))


def score_texts(model: Crf, texts: list[str | None]) -> np.ndarray:
    if model.constant is not None or not texts:
        return np.full(len(texts), model.constant if model.constant is not None else 0.5)
    feats = features(texts)
    unary = [((f - model.mean) / model.scale) @ model.unary[:-1] + model.unary[-1] for f, _ in feats]
    marg, _, _ = forward_backward(unary, model.step)
    a, b = model.curve
    return 1 / (1 + np.exp(-(a * _logit(_aggregate(marg, [k for _, k in feats])) + b)))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", mod: int = 4, held: int = 2, sample_docs: int = 3000,
          sample_chars: int = 20_000) -> Crf:
    """Fit on at most ``sample_docs`` labelled documents whose fold is not ``held``."""
    pick = (labels.select(col(id_col).alias("id"), col(label_col).alias("y"))
            .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("id"), mod) != held))
            .orderBy(F.xxhash64("id"), "id", "y").limit(sample_docs).groupBy("id").agg(F.max("y").alias("y")))
    sample = (docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
              .where(F.length(F.coalesce(F.col("text"), F.lit(""))) <= sample_chars)
              .join(F.broadcast(pick), "id").orderBy(F.xxhash64("id"), "id", "text").limit(sample_docs))

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, y = [], []
        for b in batches:
            texts += b["text"].tolist()
            y += b["y"].tolist()
        yield pd.DataFrame({"model": [pickle.dumps(fit(features(texts), np.array(y, dtype=float)))]})

    found = sample.select("text", "y").coalesce(1).mapInPandas(fitted, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit([], np.empty(0))


def score(text: Column, model: Crf) -> Column:
    """Score column: an Arrow-batched function over whole texts."""
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            parts = [score_texts(model, s.iloc[i:i + 256].tolist()) for i in range(0, len(s), 256)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))
    return scored(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, model: Crf, *, id_col: str = "doc_id", text_col: str = "text", mod: int = 4,
             held: int = 2, threshold: float = 0.7) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    d = docs.select(col(id_col).alias("doc_id"), (fold(col(id_col), mod) == held).alias("held_out"),
                    score(col(text_col), model).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Crf, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their columns as they are."""
    names = docs.columns
    packed = docs.select(F.struct(*[col(c) for c in names]).alias("row"), score(col(text_col), model).alias("score"))
    return packed.where(F.col("score") >= threshold).select(*[F.col("row")[c].alias(c) for c in names])
