"""Ranked lexical search against scoring every document."""
from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lifecorpus.llm import lexical
from tests.llm.test_operators import LOWER, SCHEMA, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(rows, items, k):
    docs = [(i, Counter(ts), len(ts)) for i, ts in ((i, terms(t)) for i, t in rows) if ts]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in ts if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def corpus(n=700, seed=4):
    r = random.Random(seed)
    vocab = [f"t{i}" for i in range(400)] + ["Été", "日本語", "A1b2"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    rows = [(r.randint(0, 3 * n), r.choice([" ", ", ", "-", "\n"]).join(r.choices(vocab, weights, k=r.randint(1, 120)))) for _ in range(n)]
    rows += [(i, rows[5][1]) for i in range(5000, 5200)]  # ties by the hundred
    rows += [(None, rows[5][1]), (None, rows[5][1]), (7, None), (8, ""), (9, "-- !"), (10, "t399 " * 40_000), (11, "t399 t398"), (11, "t399 t398")]
    items = [(k, " ".join(r.choices(vocab, k=r.randint(1, 40)))) for k in range(30)]
    items += [(100, rows[5][1]), (101, None), (102, ""), (103, "unknown words only"), (3, "t399"), (None, "t1 T2"), (104, "t0 t0 t0"), (105, "t399 T398 é")]
    return rows, items


def found(df):
    return Counter(tuple(x) for x in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("k,item_bytes", [(50, 1 << 20), (1, 1 << 20), (7, 900)])
def test_against_all_documents(spark, k, item_bytes):
    rows, items = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, "h", 3, "x") for i, t in rows], SCHEMA).repartition(6)
    asked = spark.createDataFrame([(i, t, 5, "y") for i, t in items], "item_id long, text string, score int, doc_id string").repartition(3)
    assert found(lexical.rank(docs, asked, k=k, item_bytes=item_bytes)) == expected(rows, items, k)


def test_odd_documents(spark):
    rows = [r[:2] for r in documents()]
    items = [(1, "alpha beta"), (2, "日本 Ünder"), (3, "no id"), (4, "word")]
    docs = spark.createDataFrame(documents(), SCHEMA)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.rank(docs, asked)) == expected(rows, items, 50)


def test_nothing(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(docs, items).count() == 0
    assert lexical.rank(spark.createDataFrame([(1, "a", *[None] * 7)], SCHEMA), items.limit(0)).count() == 0
    assert lexical.rank(spark.createDataFrame([(1, None, *[None] * 7)], SCHEMA), items).count() == 0


def test_bounds_prune_and_never_drop():
    """Every row that reaches a threshold stays, and high thresholds leave few to score."""
    r = np.random.default_rng(3)
    weights = np.sort(r.integers(1, 5000, 60))[::-1]
    rows = [np.sort(r.choice(60, r.integers(1, 20), replace=False)) for _ in range(500)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    flat = np.concatenate(rows)
    impacts = r.integers(1, 10**6, len(flat))
    lengths = np.array([math.sqrt(sum(weights[t] * float(i) ** 2 for t, i in zip(flat[s:e], impacts[s:e]))) for s, e in zip(at, at[1:])])
    bucket = lexical.Bucket(lengths, at, flat, impacts, weights)
    item = lexical.Item(list(range(0, 60, 4)), weights)
    exact = bucket.scores(item, np.arange(500), np.zeros(60, np.int64))
    plain = [sum(int(weights[t] * i) for t, i in zip(flat[s:e], impacts[s:e]) if t % 4 == 0) for s, e in zip(at, at[1:])]
    assert exact.tolist() == plain
    for t in [0, *np.sort(exact)[[100, 400, 490, 499]]]:
        left = bucket.reach(item, int(t))
        assert set(np.flatnonzero((exact >= t) & (exact > 0))) <= set(left)
    assert len(bucket.reach(item, int(exact.max()))) < 100
    assert not len(bucket.reach(item, int(item.rest[0] * lengths.max() * 1.01)))
