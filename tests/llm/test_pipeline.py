"""The pipeline stage by stage against plain Python, and the registered queries against their SQL."""
from __future__ import annotations

import os
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from lifecorpus.llm import mixing, oracle, packing, quality, queries, simhash
from tests.llm.test_operators import LOWER, SCHEMA, check_pieces, closed, documents

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark, tmp_path):
    rows = documents(200, seed=4)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    model = quality.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))

    def stage(k, d):
        out = corpus_pipeline.STAGES[k][1](spark, d, str(tmp_path))
        out.write.parquet(path := f"{tmp_path}/stage{k}")
        return spark.read.parquet(path)

    one = stage(0, docs)
    assert one.columns == names
    texts = [t for _, t, *_ in rows]
    good = [r for r, s in zip(rows, quality.score_texts(model, texts)) if s >= 0.7]
    assert Counter(map(tuple, one.collect())) == Counter(good)

    two = stage(1, one)
    best = {}
    for r in good:
        k = (r[1] or "").translate(LOWER)
        if k not in best or (r[0] is not None and (best[k][0] is None or r[0] > best[k][0])):
            best[k] = r
    assert two.columns == names and Counter(x["doc_id"] for x in two.collect()) == Counter(r[0] for r in best.values())

    three = stage(2, two)
    left = list(map(tuple, two.collect()))
    fps = [simhash.fingerprint(r[1], 3) for r in left]
    nodes = sorted(set(fps))
    root = closed([(a, b) for n, a in enumerate(nodes) for b in nodes[n + 1:] if (a ^ b).bit_count() <= 3], nodes)
    first = {}
    for r, f in zip(left, fps):
        if r[0] is not None:
            first[root[f]] = min(first.get(root[f], r[0]), r[0])
    assert three.columns == names and {x["doc_id"] for x in three.collect()} >= set(first.values())
    assert three.count() == len({root[f] for f in fps})

    four = stage(3, three)
    copies = Counter()
    for x in mixing.mix(three).collect():
        copies[x["doc_id"]] += x["copies"]
    assert four.columns == names and Counter(x["doc_id"] for x in four.collect()) == +copies

    five = stage(4, four)
    total = sum(x["length"] for x in five.collect())
    enc = packing.Encoder(queries.tokenizer_file("byte_bpe_50k.tiktoken"), queries.split_pattern(), queries.special_tokens())
    assert total == sum(len(enc.encode(x["text"] or "")) // enc.dtype.itemsize + 1 for x in four.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == five.count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(oracle.SQL[name])
    order = [d[0] for d in want.description]
    flat = lambda v: round(v, 6) if isinstance(v, float) else v
    a = Counter(tuple(flat(x[c]) for c in cols) for x in got.collect())
    b = Counter(tuple(flat(r[order.index(c)]) for c in cols) for r in want.fetchall())
    assert a == b
