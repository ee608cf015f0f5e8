"""Exact top-k search by integer inner product, pruned by segment statistics.

Vectors are cut into equal segments. With a segment's mean m and deviation s, the squared
distance of two vectors is at least ``sum of width * ((m1 - m2)^2 + (s1 - s2)^2)`` over the
segments. Twice the inner product is both squared norms less that distance, so every
resolution gives an upper bound of the score. Resolutions go from coarse to fine: a pair
whose bound is under the query's k-th best score so far is dropped, the others go on, and
the survivors of the finest are scored exactly. Bounds are widened by a rounding margin;
a pair that could tie is kept, so the result is exact.

Queries are packed into blocks, candidates too, and candidate blocks are dealt into groups.
Each query block meets each group once, by an equality join on the group's number (a stated
query set against all rows, in blocks). A task keeps the best k of its query block from one
candidate block to the next; the k best per task are merged by rank.

Defined cases: a vector that is null, or holds a null or a non-finite component, takes no
part, nor does a row without an id; vectors meet only those of their own length; a query's
own id is no candidate; of rows that repeat a queried id the smallest vector asks, and all
rows are candidates; ties go to the smaller id; fewer candidates than k give all; a vector
whose scaled length may pass 2^31 ends the search with an error, as scores could leave 64 bits.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare

BLOCK = 2048
QUERY_BLOCK = 256
#: Above this share of survivors a block is scored whole: the same scores, without picking.
DENSE = 0.05


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


#: The largest length of a quantised vector: two such have an inner product within 64 bits.
LONGEST = float(1 << 31)


def checked(vector: Column, scale: int) -> Column:
    """The quantised vector, or an error for one that may be longer than ``LONGEST``."""
    largest = F.coalesce(F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double") * scale))), F.lit(0.0))
    fits = (largest + 1) * F.sqrt(F.size(vector)) <= LONGEST
    return F.when(fits, quantised(vector, scale)).otherwise(
        F.raise_error(F.lit("a vector is too long for 64-bit scores")).cast("array<long>"))


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return vector.isNotNull() & F.coalesce(ok, F.lit(False))


def segment_statistics(x: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Coarse to fine: (width, means, deviations); widths halve from the whole vector down to 4."""
    out, d = [], x.shape[1]
    width = d
    while width >= 4 and d % width == 0:
        seg = x.reshape(len(x), d // width, width)
        out.append((width, seg.mean(2), seg.std(2)))
        if width % 2:
            break
        width //= 2 if width // 2 < 8 else 4
    return out


def bound(q: tuple, x: tuple, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Upper bound of the inner product at one resolution: of the lower bound of the distance,
    the norms cancel and width * (m1 m2 + s1 s2) is left."""
    width, qm, qs = q
    _, xm, xs = x
    if pairs is None:
        return width * (qm @ xm.T + qs @ xs.T)
    i, j = pairs
    return width * (np.einsum("ij,ij->i", qm[i], xm[j]) + np.einsum("ij,ij->i", qs[i], xs[j]))


class Best:
    """The k best (score, id) of every query of a block, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.id: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.least = np.full(n, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else []
        for a, b in zip(first, [*first[1:], len(query)]):
            q = query[a]
            s = np.concatenate([self.score[q], score[a:min(b, a + self.k)]])
            i = np.concatenate([self.id[q], ids[a:min(b, a + self.k)]])
            top = np.lexsort((i, -s))[:self.k]
            self.score[q], self.id[q] = s[top], i[top]
            if len(top) == self.k:
                self.least[q] = s[top[-1]]


def search_block(best: Best, q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray) -> None:
    """Let the candidates ``x`` into the best of the queries ``q``."""
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    peak = (np.abs(qf).max(initial=0) * np.abs(xf).max(initial=0)) * max(q.shape[1], 1)
    exact = (lambda a, b: (a @ b.T).astype(np.int64)) if peak < 2 ** 53 else None  # sums of doubles are exact there
    other = q_ids[:, None] != x_ids[None, :]
    qs, xs = segment_statistics(qf), segment_statistics(xf)
    slack = 1e-9 * peak + 1e-6
    unfilled = ~np.isfinite(best.least)
    if qs and unfilled.any():  # a first threshold: exact scores of the pairs with the best coarse bounds
        coarse = np.where(other, bound(qs[0], xs[0]), -np.inf)
        k = min(best.k, x.shape[0])
        near = np.argpartition(-coarse, k - 1, axis=1)[:, :k]
        i = np.repeat(np.flatnonzero(unfilled), k)
        j = near[unfilled].ravel()
        ok = other[i, j]
        scores = np.einsum("ij,ij->i", q[i[ok]], x[j[ok]])
        floor = np.full((len(q), k), -np.inf)
        floor[i[ok], np.tile(np.arange(k), int(unfilled.sum()))[ok]] = scores
        least = np.where(unfilled & (k == best.k), floor.min(1), best.least)
    else:
        least = best.least
    i = j = None
    for level, (a, b) in enumerate(zip(qs, xs)):
        if i is None:
            keep = other & (bound(a, b) + slack >= least[:, None])
            if keep.mean() > DENSE and level + 1 < len(qs):
                continue  # nearly all go on: the next resolution looks at the whole block again
            i, j = np.nonzero(keep)
        else:
            go = bound(a, b, (i, j)) + slack >= least[i]
            i, j = i[go], j[go]
    if i is None:
        i, j = np.nonzero(other)
    if exact and len(i) > DENSE * other.size:
        scores = exact(qf, xf)[i, j]
    else:
        scores = np.concatenate([np.einsum("ij,ij->i", q[i[s:s + 65536]], x[j[s:s + 65536]])
                                 for s in range(0, len(i), 65536)] or [np.empty(0, np.int64)])
    good = scores >= least[i]
    best.add(i[good], scores[good], x_ids[j[good]])


def _packed(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Blocks of up to ``size`` vectors of one length: dim, count, ids, values (bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.asarray(b.column(0))
            vec = b.column(1)
            ends = vec.offsets.to_numpy()
            lens = np.diff(ends)
            flat = vec.values.to_numpy(zero_copy_only=False)
            for d in np.unique(lens):
                at = np.flatnonzero(lens == d)
                for s in range(0, len(at), size):
                    some = at[s:s + size]
                    x = np.stack([flat[ends[i]:ends[i + 1]] for i in some]).astype("<i8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(d)], pa.int32()), pa.array([ids[some].astype("<i8").tobytes()], pa.binary()),
                         pa.array([x.tobytes()], pa.binary())], [f"{prefix}dim", f"{prefix}ids", f"{prefix}values"])
    return rows.mapInArrow(run, f"{prefix}dim int, {prefix}ids binary, {prefix}values binary")


def search(vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding", groups: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    prepare(spark)
    groups = groups or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (vectors.select(col(id_col).cast("long").alias("id"), col(vector_col).alias("v"))
            .where(F.col("id").isNotNull() & usable(F.col("v"))).select("id", checked(F.col("v"), scale).alias("v")))
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.repartitionByRange("id")
    q = _packed(asked, QUERY_BLOCK, "q").withColumn("block", F.monotonically_increasing_id()).checkpoint()
    x = _packed(rows, BLOCK, "x").withColumn("g", F.pmod(F.xxhash64("xids"), F.lit(groups)).cast("int"))
    dealt = q.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = (dealt.join(x, (dealt["g"] == x["g"]) & (dealt["qdim"] == x["xdim"]))
           .select("block", "qdim", "qids", "qvalues", "xids", "xvalues").sortWithinPartitions("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, q_ids, q_vec = None, None, None, None

        def result():
            n = [len(s) for s in best.score]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, n), pa.int64()),
                                               pa.array(np.concatenate([*best.id, np.empty(0, np.int64)]), pa.int64()),
                                               pa.array(np.concatenate([*best.score, np.empty(0, np.int64)]), pa.int64())],
                                              ["query_id", "vec_id", "score"])
        for b in batches:
            for r in range(b.num_rows):
                here = b.column(0)[r].as_py()
                if here != block:
                    if best is not None:
                        yield result()
                    block, dim = here, b.column(1)[r].as_py()
                    q_ids = np.frombuffer(b.column(2)[r].as_py(), "<i8")
                    q_vec = np.frombuffer(b.column(3)[r].as_py(), "<i8").reshape(len(q_ids), dim)
                    best = Best(len(q_ids), k)
                x_ids = np.frombuffer(b.column(4)[r].as_py(), "<i8")
                search_block(best, q_ids, q_vec, x_ids, np.frombuffer(b.column(5)[r].as_py(), "<i8").reshape(len(x_ids), dim))
        if best is not None:
            yield result()

    near = met.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
