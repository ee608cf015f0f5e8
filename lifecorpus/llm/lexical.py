"""Ranked lexical search over norm buckets, exact in integers.

A document is a sparse vector of its terms' impacts, an item a vector of its terms' weights,
and a score is their inner product, each coordinate scaled by the root of the term's weight
on either side. Document vectors are ordered by length over all tasks and read from long to
short in buckets. For an item whose k-th best score so far is t, with q its length and L the
longest vector of a bucket:

* Cauchy-Schwarz drops the bucket if q * L < t;
* inside, the item's coordinates are taken by weight until the length of the rest times L is
  under t: a document without any of these focus coordinates cannot reach t, so only their
  postings in the bucket are read;
* for each document found there, its score on the focus coordinates plus the lengths of both
  rests bounds the score; those below t go;
* survivors are scored exactly in integers over all terms.

The longest vectors (a fiftieth of the documents) are searched first. Their k-th best scores
are the thresholds with which all other tasks start, and raise as they go. Any subset gives
valid thresholds, so the result is exact. Bounds are widened by a rounding margin.

Items are taken in blocks of a bounded number of bytes; a block's terms, weights and
thresholds go to every task. Documents never meet a driver or each other.

Defined cases: a null or empty text has no terms, and such a document does not count; an
item without known terms has no rows; rows of one item id are one item with all their terms
(a null id is one item); equal document ids are ranked each, null ids last among equal
scores; empty tables give none; other columns are not read.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare, stored, word_blocks

#: Letters and digits of ASCII and all other characters make terms; A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of items whose terms are held at once; more items are taken block by block.
ITEM_BYTES = 16 << 20
#: Part of the documents, the longest vectors, from which the first thresholds come.
FIRST = 0.02
MARGIN = 1e-9
LAST = np.iinfo(np.int64).max


def term_counts(text: bytes, known: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """(number of terms, occurrences of each known term by its number)."""
    n, counts = 0, Counter()
    for ws in word_blocks(text.translate(TERM_BYTES)):
        n += len(ws)
        counts.update(map(known.get, ws))
    counts.pop(None, None)
    return n, counts


def lists(rows: list[list[int]]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array([x for r in rows for x in r], pa.int64()))


def counted(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """Documents with at least one term: doc_id, n, and numbers and occurrences of known terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, terms, times = [], [], [], []
            for i, t in zip(b.column(0), b.column(1)):
                if (text := t.as_buffer()) is None:
                    continue
                n, c = term_counts(text.to_pybytes(), known)
                if n:
                    order = sorted(c)
                    ids.append(i.as_py())
                    ns.append(n)
                    terms.append(order)
                    times.append([c[k] for k in order])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), lists(terms), lists(times)],
                                             ["doc_id", "n", "terms", "times"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<long>, times array<long>")


def flat(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list array."""
    return a.offsets.to_numpy() - a.offsets[0].as_py(), a.flatten().to_numpy(zero_copy_only=False)


def vectors(counts: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """doc_id, length, terms and impacts of every document that has a weighed term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, terms = flat(b.column(2))
            times = flat(b.column(3))[1]
            m = np.array([50 + 50 * n * n_docs // n_terms for n in b.column(1).to_pylist()], np.int64)
            impacts = 1_000_000_000 * times // (1000 * times + 20 * np.repeat(m, np.diff(at)))
            squares = np.concatenate([[0.0], np.cumsum(weights[terms] * impacts.astype(np.float64) ** 2)])
            lengths = np.array([math.sqrt(math.fsum(weights[terms[s:e]] * impacts[s:e].astype(np.float64) ** 2))
                                for s, e in zip(at[:-1], at[1:])]) if len(at) > 1 else squares[:0]
            out = pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths), lists_of(at, terms), lists_of(at, impacts)],
                                             ["doc_id", "length", "terms", "impacts"])
            yield out.filter(pa.array(lengths > 0))

    return counts.mapInArrow(run, "doc_id long, length double, terms array<long>, impacts array<long>")


def lists_of(at: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int64)))


class Item:
    """An item's weighed terms, heaviest first, and the lengths of what follows each of them."""

    def __init__(self, terms: list[int], weights: np.ndarray) -> None:
        t = np.array(sorted(terms, key=lambda k: (-weights[k], k)), np.int64)
        self.terms = t[weights[t] > 0]
        self.weights = weights[self.terms]
        self.roots = np.sqrt(self.weights.astype(np.float64))
        self.rest = np.sqrt(np.concatenate([np.cumsum(self.weights[::-1].astype(np.float64))[::-1], [0.0]]))


class Best:
    """The k best (score, id) of an item so far, and the score that others must reach; at that
    score itself only ids up to ``last`` count."""

    def __init__(self, k: int, threshold: int, last: int) -> None:
        self.k, self.threshold, self.last = k, threshold, last
        self.scores, self.ids, self.none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        s, i, z = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.none, none)))
        order = np.lexsort((i, z, -s))[:self.k]
        self.scores, self.ids, self.none = s[order], i[order], z[order]
        if len(order) == self.k and (int(self.scores[-1]), -int(self.ids[-1])) >= (self.threshold, -self.last):
            self.threshold, self.last = int(self.scores[-1]), int(self.ids[-1])


class Bucket:
    """Documents of neighbouring lengths, by row and by term."""

    def __init__(self, lengths: np.ndarray, at: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray) -> None:
        self.lengths, self.longest = lengths, float(lengths.max())
        self.at, self.terms, self.impacts = at, terms, impacts
        row = np.repeat(np.arange(len(lengths)), np.diff(at))
        order = np.argsort(terms, kind="stable")
        self.row = row[order]
        self.value = np.sqrt(weights[terms[order]].astype(np.float64)) * impacts[order]
        self.begin = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def reach(self, item: Item, threshold: int) -> np.ndarray:
        """Rows that may score ``threshold``, by the bounds."""
        far = self.longest * (1 + MARGIN)
        if threshold > 0 and item.rest[0] * far < threshold:
            return np.empty(0, np.int64)
        focus = int(np.searchsorted(-item.rest * far, -threshold, "right")) if threshold > 0 else len(item.terms)
        focus = min(focus, len(item.terms))
        begin = self.begin[item.terms[:focus]]
        size = self.begin[item.terms[:focus] + 1] - begin
        total = int(size.sum())
        if not total:
            return np.empty(0, np.int64)
        entry = np.arange(total) + np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        row, value = self.row[entry], self.value[entry]
        score = np.bincount(row, value * np.repeat(item.roots[:focus], size), len(self.lengths))
        square = np.bincount(row, value * value, len(self.lengths))
        rows = np.flatnonzero(square)
        most = score[rows] + item.rest[focus] * np.sqrt(np.maximum(self.lengths[rows] ** 2 * (1 + MARGIN) - square[rows], 0))
        return rows[most * (1 + MARGIN) >= threshold]

    def scores(self, item: Item, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Exact scores of rows; ``table`` holds a zero for every term and is given back so."""
        table[item.terms] = item.weights
        size = self.at[rows + 1] - self.at[rows]
        first = np.concatenate([[0], np.cumsum(size)])
        entry = np.arange(first[-1]) + np.repeat(self.at[rows] - first[:-1], size)
        sums = np.concatenate([[0], np.cumsum(table[self.terms[entry]] * self.impacts[entry])])
        table[item.terms] = 0
        return sums[first[1:]] - sums[first[:-1]]


def search(rows: DataFrame, items: list[list[int]], ids: list, kind: pa.DataType, kind_sql: str, weights: np.ndarray,
           thresholds: list[tuple[int, int]], k: int) -> DataFrame:
    """(item_id, doc_id, score): every task's best k of each item, from its rows, longest first."""
    ordered = rows.repartitionByRange(F.col("length").desc(), "doc_id").sortWithinPartitions(F.col("length").desc(), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [Item(t, weights) for t in items]
        best = [Best(k, *t) for t in thresholds]
        table = np.zeros(len(weights), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            at, terms = flat(b.column(2))
            bucket = Bucket(b.column(1).to_numpy(), at, terms, flat(b.column(3))[1], weights)
            doc = b.column(0)
            none = doc.is_null().to_numpy(zero_copy_only=False)
            doc = doc.fill_null(LAST).to_numpy(zero_copy_only=False)
            for item, top in zip(asked, best):
                found = bucket.reach(item, top.threshold)
                if len(found):
                    scores = bucket.scores(item, found, table)
                    good = (scores > 0) & ((scores > top.threshold) | (scores == top.threshold) & (doc[found] <= top.last))
                    if good.any():
                        top.add(scores[good], doc[found[good]], none[found[good]])
        for start in range(0, len(best), 1000):
            part = list(zip(ids, best))[start:start + 1000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, t in part for _ in range(len(t.scores))], kind),
                 pa.array([None if z else int(d) for _, t in part for d, z in zip(t.ids, t.none)], pa.int64()),
                 pa.array([int(s) for _, t in part for s in t.scores], pa.int64())], ["item_id", "doc_id", "score"])

    return ordered.mapInArrow(run, f"item_id {kind_sql}, doc_id long, score long")


def ranked(found: DataFrame, k: int, *by: str | Column) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, in two levels, so that no task meets all tasks' rows of an item."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(32)).alias("part")
    return ranked(ranked(found.withColumn("part", part), k, "item_id", "part").drop("rank", "part"), k, "item_id")


def rank(docs: DataFrame, items: DataFrame, *, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    prepare(spark)
    src = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    asked = items.select(col(item_col).alias("item_id"), col(item_text_col).alias("text"))
    total = asked.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    blocks = max(1, math.ceil(total / item_bytes))
    kind_sql = asked.schema["item_id"].dataType.simpleString()
    out = None
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        found = ranked_block(src, block, k).withColumn("item_id", F.col("item_id").cast(kind_sql))
        out = found if out is None else out.unionByName(found)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_block(src: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """``rank`` for items that fit in memory."""
    table = block.toArrow()
    kind, kind_sql = table.schema.field(0).type, block.schema["item_id"].dataType.simpleString()
    terms_of: dict[object, dict[bytes, None]] = {}
    for i, t in zip(table["item_id"].to_pylist(), table["text"].to_pylist()):
        terms_of.setdefault(i, {}).update(dict.fromkeys((t or "").encode().translate(TERM_BYTES).split()))
    known = {t: n for n, t in enumerate(dict.fromkeys(t for ts in terms_of.values() for t in ts))}
    ids, items = list(terms_of), [[known[t] for t in ts] for ts in terms_of.values()]
    counts = stored(counted(src, known), "term-counts")
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term of the block
    weights = np.zeros(len(known), np.int64)
    for term, df in holding:
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    rows = stored(vectors(counts, weights, n_docs, n_terms or 1), "impacts")
    first = rows.approxQuantile("length", [1 - FIRST], 0.005)
    cut = first[0] if first else 0.0
    args = (items, ids, kind, kind_sql, weights)
    long = stored(best_of(search(rows.where(F.col("length") >= cut), *args, [(0, LAST)] * len(ids), k), k), "longest")
    # a row an item of the block; a null id is the last
    reached = {r.item_id: (r.score, LAST if r.doc_id is None else r.doc_id) for r in long.where(F.col("rank") == k).collect()}
    rest = search(rows.where(F.col("length") < cut), *args, [reached.get(i, (0, LAST)) for i in ids], k)
    return best_of(rest.unionByName(long.drop("rank")), k)
