"""Substring dedup against grouping every window."""
from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lifecorpus.llm import substring_dedup as sd
from tests.llm.test_operators import SCHEMA, documents, words


def expected(rows, width):
    last = 2**63 - 1
    texts = [(last if i is None else i, words(t)) for i, t in rows]
    least = {}
    for i, ws in texts:
        for k in range(len(ws) - width + 1):
            key = tuple(ws[k:k + width])
            least[key] = min(least.get(key, last), i)
    out = Counter()
    for (raw, _), (i, ws) in zip(rows, texts):
        gone = set()
        for k in range(len(ws) - width + 1):
            if least[tuple(ws[k:k + width])] < i:
                gone.update(range(k, k + width))
        out[raw, len(ws), len(gone), " ".join(w for j, w in enumerate(ws) if j not in gone)] += 1
    return out


def passages(n=150, seed=2):
    r = random.Random(seed)
    vocab = ["a", "b", "é日", "word", "Word", "x" * 30] + [f"w{i}" for i in range(300)]
    shared = [[r.choice(vocab) for _ in range(r.randint(8, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        ws = []
        for _ in range(r.randint(0, 4)):
            ws += r.choice(shared) if r.random() < 0.5 else [r.choice(vocab) for _ in range(r.randint(1, 70))]
        rows.append((r.randint(0, 2 * n), r.choice([" ", "  ", "\n", "\t "]).join(ws)))
    ws = [r.choice(vocab) for _ in range(100)]
    rows += [(i, " ".join(ws)) for i in range(1000, 1080)]  # a large group of copies
    rows += [(None, " ".join(ws)), (None, "a b c"), (5000, None), (5001, ""), (5002, " \n "), (5003, "same " * 500), (5003, "same " * 500),
             (-4, "same " * 90), (5004, "y" * 200_000 + " tail " * 20), (5005, "y" * 200_000 + " tail " * 20),
             (2**62, " ".join(ws[:40])), (5006, " ".join(f"u{i}" for i in range(60_000)))]
    return rows


def found(df):
    return Counter((r.id, r.n_words, r.n_removed, r.kept) for r in df.collect())


@pytest.mark.parametrize("chunk_bytes,width", [(None, 10), (4000, 10), (1 << 20, 1), (30_000, 50)])
def test_against_all_windows(spark, chunk_bytes, width):
    rows = passages()
    df = spark.createDataFrame([(i, t, "en", "s", 1, 2, "h", 3, "x") for i, t in rows], SCHEMA).repartition(5)
    out = sd.remove_repeats(df, width=width, chunk_bytes=chunk_bytes)
    assert found(out) == expected(rows, width)
    for r in out.collect():
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_odd_documents(spark):
    rows = documents()
    assert found(sd.remove_repeats(spark.createDataFrame(rows, SCHEMA), width=7, chunk_bytes=20_000)) == expected([x[:2] for x in rows], 7)


def test_nothing(spark):
    assert sd.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert found(sd.remove_repeats(spark.createDataFrame([(1, None, *[None] * 7)], SCHEMA))) == {(1, 0, 0, ""): 1}


def test_the_sketch_loses_none():
    """With far too few cells everything is estimated repeated, and with enough no true repeat is missed."""
    r = np.random.default_rng(1)
    hashes = [r.integers(0, 2**63, 4000).astype(np.uint64) for _ in range(3)]
    hashes[2][:500] = hashes[0][:500]
    hashes[1][0] = hashes[1][1]
    for total in (100, 6 * 12_000):
        shape = sd.Shape(total, 4 << 20)
        rows = [x for c, h in enumerate(hashes) for x in sd.cell_rows(shape, c, h)]
        answers = [{}, {}, {}]
        for block in {x[1] for x in rows}:
            for c, b, n, p in zip(
                    *(sd.merged_cells(shape, sd.sent([x for x in rows if x[1] == block]))[k].to_pylist() for k in ("chunk", "block", "n", "payload"))):
                answers[c][b] = (n, p)
        flagged = [sd.estimated_repeated(shape, h, a) for h, a in zip(hashes, answers)]
        assert flagged[0][:500].all() and flagged[2][:500].all() and flagged[1][:2].all()
        if total > 100:
            assert sum(f.sum() for f in flagged) < 1600


def test_equal_words_hash_alike_wherever_they_lie():
    r = random.Random(7)
    long = "z" * (sd.LONG + 5)
    ws = [r.choice(["a", "bb", "é", long, "q" * 999]) for _ in range(900)]
    c = sd.Chunk(pa.array([1, 2]), pa.array(["x " + "\n".join(ws), " ".join(ws)]), 3)
    h = c.word_hashes()
    assert (h[1:901] == h[901:]).all() and len(set(h.tolist())) == 6
