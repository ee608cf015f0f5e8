"""Mixing sources to target weights by hash thresholds.

Every row gets a 60-bit hash of its id and text. A source whose target is T and
whose size is S takes ``floor(T / S)`` whole copies of all its rows and, of one
further copy, the rows whose hash lies under a threshold; the copies are nested,
since whoever is in the second is in the first. The threshold is found on
histograms: sizes summed by source and leading hash bits, a running sum to the
bucket in which the budget ends, and the same again on the rows of that bucket
alone, until it holds one row (or rows with one hash). Nothing is sorted, and a
last pass over the rows filters by the threshold of their source.

Defined cases: a null or empty text has size 0; a null source is a source of its
own, last in order; rows equal in id and text share a hash, so both are taken
the same number of times; the row on the threshold is taken if that brings the
sum nearer to the budget; an empty table gives an empty result. Size-0 rows cost
nothing and follow their hash.

The table of sources (a row each) passes through one task for its order and the
resharing; it grows with the number of sources, not of rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import WORD, bounded, col, prepare, stored

HASH_BITS = 60
ROUND_BITS = 12


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the md5 of id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_key(source: Column) -> tuple[Column, Column]:
    """(is null, text): orders by code point with null last, and joins null to null."""
    return source.isNull().alias("no_source"), F.coalesce(source.cast("string"), F.lit("")).alias("source_text")


KEY = ["no_source", "source_text"]


def targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: int) -> DataFrame:
    """Per source its target: the budget by weight, no more than ``most`` times the size,
    the excess reshared by weight. Sources in order of the level at which they are full:
    those below the common level stop there, the others share what is left."""
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = len(weights)
    rank = F.row_number().over(Window.orderBy(*KEY)) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank % n + 1).cast("int")).cast("long")
    s = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(int(most)))
    s = s.withColumn("full_at", F.col("most").cast("double") / F.col("weight"))
    before = Window.orderBy("full_at", *KEY).rowsBetween(Window.unboundedPreceding, -1)
    all_ = F.sum("source_size").over(everyone).cast("double") * F.lit(float(budget))
    spent = F.coalesce(F.sum("most").over(before), F.lit(0))
    left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", (all_ - spent) / left)
    # full sources are those before the first whose own level is not reached
    first = F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "level"))).over(everyone)
    even = F.col("weight") * first["level"]
    target = F.when(first.isNull(), F.col("most").cast("double")).otherwise(F.least(even, F.col("most").cast("double")))
    return s.withColumn("target", target).select(*KEY, "source_size", "target")


def thresholds(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source: whole copies of every row, and the hash below which a row gets one more.

    ``rows``: KEY, h, size. ``goal``: KEY, source_size, target."""
    size = F.col("source_size")
    whole = F.when(size == 0, F.lit(1)).otherwise(F.floor(F.col("target") / size)).cast("long")
    rest = F.when(size == 0, F.lit(0.0)).otherwise(F.col("target") - F.col("whole") * size)
    state = (goal.withColumn("whole", whole).withColumn("rest", rest)
             .withColumn("prefix", F.lit(0).cast("long")).withColumn("limit", F.lit(0).cast("long")))
    done = state.where(F.col("rest") <= 0)
    state = state.where(F.col("rest") > 0).checkpoint()
    kept = [*KEY, "source_size", "target", "whole", "limit"]
    out = [done.select(*kept)]
    bits = 0
    while (n := state.count()):
        bits += ROUND_BITS
        inside = rows.withColumn("prefix", F.shiftright("h", HASH_BITS - bits + ROUND_BITS))
        inside = inside.join(bounded(state.select(*KEY, "prefix"), n), [*KEY, "prefix"], "left_semi")
        hist = (inside.groupBy(*KEY, F.shiftright("h", HASH_BITS - bits).alias("bucket"))
                .agg(F.sum("size").alias("held"), F.count("*").alias("members")))
        upto = Window.partitionBy(*KEY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        run = hist.withColumn("upto", F.sum("held").over(upto)).join(bounded(state.select(*KEY, "rest"), n), KEY)
        edge = (run.where(F.col("upto") > F.col("rest"))
                .groupBy(*KEY).agg(F.min(F.struct("bucket", "held", "members", "upto")).alias("edge")))
        nxt = (bounded(state.drop("prefix", "limit"), n).join(edge, KEY, "left")
               .withColumn("left", F.col("rest") - (F.col("edge.upto") - F.col("edge.held"))))
        width = 1 << (HASH_BITS - bits)
        near = (F.col("left") * 2 > F.col("edge.held")).cast("long")  # the last row: in, if nearer so
        nxt = nxt.select(*KEY, "source_size", "target", "whole", F.col("left").alias("rest"),
                         F.col("edge.bucket").alias("prefix"), F.col("edge.members").alias("members"),
                         F.when(F.col("edge").isNull(), F.lit(1 << HASH_BITS))
                         .otherwise((F.col("edge.bucket") + near) * F.lit(width)).cast("long").alias("limit")).checkpoint()
        end = F.col("members").isNull() | (F.col("members") == 1) | F.lit(bits >= HASH_BITS)
        out.append(nxt.where(end).select(*kept))
        state = nxt.where(~end).select(*kept, "rest", "prefix")
    table = out[0]
    for t in out[1:]:
        table = table.unionByName(t)
    return table


def _copies() -> Column:
    return (F.col("whole") + (F.col("h") < F.col("limit")).cast("long")).cast("long")


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, most: int = 2) -> tuple[DataFrame, DataFrame]:
    """(narrow rows: doc_id, KEY, size, h; per source: size, target, whole copies, limit)."""
    prepare(docs.sparkSession)
    rows = stored(docs.select(col(id_col).alias("doc_id"), *source_key(col(source_col)),
                              word_count(col(text_col)).alias("size"),
                              row_hash(col(id_col), col(text_col)).alias("h")), "mixing-rows")
    sizes = rows.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    return rows, thresholds(rows, targets(sizes, weights, budget, most)).checkpoint()


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    rows, table = plan(docs, **how)
    out = rows.join(bounded(table), KEY).withColumn("copies", _copies())
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **how) -> DataFrame:
    """The documents of the mix with their columns as they are, each as often as it is taken."""
    _, table = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    names = docs.columns
    rows = docs.select(F.struct(*[col(c) for c in names]).alias("row"), *source_key(col(source_col)),
                       row_hash(col(id_col), col(text_col)).alias("h"))
    out = rows.join(bounded(table), KEY).withColumn("copies", _copies()).where(F.col("copies") > 0)
    out = out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return out.select(*[F.col("row")[c].alias(c) for c in names])
