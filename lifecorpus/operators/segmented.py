"""Ordered scans over groups that may be huge (one thread holding a third of all
rows), without putting a group into a single task.

Rows are range-partitioned on (group keys, order keys); Spark samples the sort
keys, so a hot group is spread over many contiguous segments. Scans (running
sums, last-non-null, lag) run per (segment, group) with ordinary window
functions, and each segment's contribution is carried to the next through a
summary table. Only groups that cross a segment boundary need a carry, and
there are at most two per segment, so the carry table is bounded by twice the
number of segments.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

SEG = "_seg"
POS = "_pos"
#: The tables kept by the job that is running (see ``job``), or by calls outside of any.
_KEPT: ContextVar[list[DataFrame]] = ContextVar("kept", default=[])


@contextmanager
def job() -> Iterator[list[DataFrame]]:
    """Tables kept inside are released at its end, and no others: jobs of one process, also on
    other threads, do not drop each other's."""
    own: list[DataFrame] = []
    token = _KEPT.set(own)
    try:
        yield own
    finally:
        release()
        _KEPT.reset(token)


def add_segments(df: DataFrame, keys: list[str], order: list[str], n: int | None = None) -> DataFrame:
    """Range-partition by (keys, order) and tag rows with their segment id and
    their position inside (segment, group). (segment, position) orders a group
    exactly, so it doubles as a compact sort key later on.

    The result is persisted: every later branch (row scans, segment summaries,
    boundary lists) must see the same segment ids. A second range exchange
    would sample with another seed and draw other bounds, so the branches share
    this one materialisation instead. Blocks lost with an executor are rebuilt
    through the same shuffle dependency, hence with the same bounds."""
    # Without an explicit count there are spark.sql.shuffle.partitions ranges, the most segments
    # there can be: adaptive execution merges adjacent small ones, and never splits one.
    ranged = df.repartitionByRange(n, *keys, *order) if n else df.repartitionByRange(*keys, *order)
    out = ranged.withColumn(SEG, F.spark_partition_id())
    w = Window.partitionBy(SEG, *keys).orderBy(*order)
    return keep(out.withColumn(POS, F.row_number().over(w)))


def keep(df: DataFrame) -> DataFrame:
    """Persist an intermediate that several branches consume (released with
    the segment tables by ``release``)."""
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.get().append(out)
    return out


def release() -> int:
    """Unpersist the tables that the running job kept so far (call after its action)."""
    kept, n = _KEPT.get(), 0
    while kept:
        kept.pop().unpersist()
        n += 1
    return n


def local_window(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(SEG, *keys).orderBy(*order)


def boundary_summaries(df: DataFrame, keys: list[str], summary: list[Column]) -> DataFrame:
    """One summary row per (segment, group) that sits on a segment boundary.

    ``summary`` aggregates one (segment, group) in the same pass that serves the
    row-level scan's partitioning (no exchange); whether a group is the first or
    last of its segment is decided on that summary table, so the rows are read
    once more and no further. At most two rows per segment remain."""
    summ = df.groupBy(SEG, *keys).agg(*summary)
    k = F.struct(*[F.col(c) for c in keys])
    per_seg = Window.partitionBy(SEG)
    return (summ.withColumn("_lo", F.min(k).over(per_seg)).withColumn("_hi", F.max(k).over(per_seg))
            .where((k == F.col("_lo")) | (k == F.col("_hi"))).drop("_lo", "_hi"))


def carry_windows(keys: list[str]) -> tuple[WindowSpec, WindowSpec]:
    """(earlier segments of the group, all segments of the group) over boundary summaries."""
    return (Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1),
            Window.partitionBy(*keys))


def boundary_carry(df: DataFrame, keys: list[str], summary: list[Column],
                   carry: dict[str, Callable[[WindowSpec, WindowSpec], Column]]) -> DataFrame:
    """Carry values for the (segment, group) pairs on a segment boundary:
    ``carry[name](prev, whole)`` combines the summaries of the group's earlier
    segments (``prev``) or of all its segments (``whole``). Returns (segment,
    keys..., carry columns), at most two rows per segment."""
    edge = boundary_summaries(df, keys, summary)
    prev, whole = carry_windows(keys)
    return edge.select(SEG, *keys, *[fn(prev, whole).alias(name) for name, fn in carry.items()])


def attach_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join the carry table (<= 2 rows per segment) onto the rows. They lie by (segment, keys) already,
    so only the carry moves; it is broadcast where its measured size is under Spark's own threshold."""
    return df.join(carry, [SEG, *keys], "left")


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column],
                 segments: int | None = None) -> DataFrame:
    """For each name in ``sums`` the running sum of an integer expression over each group in
    ``order`` (inclusive), all from one scan: computed per segment plus the carried prefixes."""
    x = add_segments(df, keys, order, segments)
    w = local_window(keys, [POS]).rowsBetween(Window.unboundedPreceding, 0)
    c = boundary_carry(x, keys, [F.sum(v).alias(f"_s_{n}") for n, v in sums.items()],
                       {f"_c_{n}": (lambda prev, all_, n=n: F.sum(f"_s_{n}").over(prev)) for n in sums})
    x = attach_carry(x.withColumns({f"_r_{n}": F.sum(v).over(w) for n, v in sums.items()}), c, keys)
    x = x.withColumns({n: (F.col(f"_r_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).cast("long") for n in sums})
    return x.drop(*[f"{p}{n}" for p in ("_r_", "_c_") for n in sums])


def running_sum(df: DataFrame, keys: list[str], order: list[str], flag: str, out: str,
                segments: int | None = None) -> DataFrame:
    """``out`` = running sum of the integer column ``flag``."""
    return running_sums(df, keys, order, {out: F.col(flag)}, segments)
