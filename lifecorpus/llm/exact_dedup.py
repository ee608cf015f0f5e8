"""Exact dedup by a tree of merges over sorted digest runs.

Each input partition is a leaf. Its run is one entry per digest: the identifier
that stays, the number of rows, and the SHA-256 and length that verify the short
digest the run is sorted by. In round after round a node sends its run, cut by
the next leading digest bits, to the nodes that share those bits, and every node
merges what its ``fan_in`` partners sent: entries of one verified digest become
one, keeping the winning identifier and the sum of the counts. After the last
round a node is known by digest bits alone, so it holds each of its digests
once. The number of nodes follows the session's shuffle partitions.

A digest shared by a third of all rows is one entry per leaf after the first
step, so no node meets its rows. Rows learn their winner back through the leaf
runs: (leaf, digest), so that no task gathers the copies either.

Defined cases: a null text counts as empty; texts are equal after lower-casing
A-Z only; of equal texts the row with the largest id stays (``keep="smallest"``
for the smallest), a null id loses to any other; of repeated rows with one id and
text, one stays; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifecorpus.llm.common import bounded, col, lower_ascii, prepare, stored

DIGEST = ["short", "sha", "length"]
#: Partners of a node in one round, as bits: 16 runs are merged at once.
FAN_BITS = 4


def digests(docs: DataFrame, id_col: str, text_col: str, node_bits: int) -> DataFrame:
    """doc_id, place (a number of its own for every row), leaf and digest of every row."""
    text = lower_ascii(col(text_col))
    d = docs.select(col(id_col).alias("doc_id"), F.spark_partition_id().alias("leaf"),
                    F.monotonically_increasing_id().alias("place"),
                    F.sha2(text.cast("binary"), 256).alias("sha"), F.length(text).alias("length"))
    d = d.withColumn("short", F.conv(F.substring("sha", 1, 15), 16, 10).cast("long"))
    return d.withColumn("leaf", (F.col("leaf") % (1 << node_bits)).cast("long"))


def merge_runs(runs: DataFrame, keep: str) -> DataFrame:
    best = F.max if keep == "largest" else F.min
    return runs.groupBy("node", *DIGEST).agg(best("best").alias("best"), F.sum("rows").alias("rows"))


def tree(leaves: DataFrame, node_bits: int, keep: str) -> DataFrame:
    """Merge the leaf runs (node, DIGEST, best, rows) until each digest is in one node."""
    runs, done = leaves, 0
    while done < node_bits:
        done = min(done + FAN_BITS, node_bits)
        rest = node_bits - done
        # a node: the digest's first ``done`` bits, then the leaf's last ``rest`` bits
        lead = F.shiftleft(F.shiftright("short", 60 - done), rest)
        runs = runs.withColumn("node", lead + F.col("node") % (1 << rest))
        runs = runs.repartition(1 << node_bits, "node").sortWithinPartitions("node", *DIGEST)
        runs = merge_runs(runs, keep)
    return runs


def resolve(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    prepare(spark)
    node_bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    rows = stored(digests(docs, id_col, text_col, node_bits), "dedup-digests")
    # among ids the largest or smallest wins, and a null never does; then the first place
    sign = F.lit(1 if keep == "largest" else -1)
    best = F.struct((F.col("doc_id").isNotNull().cast("int") * sign).alias("known"), "doc_id",
                    (-F.col("place") * sign).alias("place"))
    leaves = merge_runs(rows.select(F.col("leaf").alias("node"), *DIGEST, best.alias("best"),
                                    F.lit(1).cast("long").alias("rows")), keep).withColumnRenamed("node", "leaf")
    merged = tree(leaves.withColumnRenamed("leaf", "node"), node_bits, keep).drop("node")
    found = leaves.select("leaf", *DIGEST).join(merged, DIGEST)
    out = rows.join(found, ["leaf", *DIGEST])
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("rows").alias("group_size"),
                      (-F.col("best.place") * sign == F.col("place")).alias("kept"), F.col("sha").alias("text_sha256"))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The documents that stay, with their columns as they are.

    Only (id, digest) pairs that lose a row are looked up: an anti join takes them out.
    Of a pair that loses some rows but stays (repeated rows), the smallest as a record stays."""
    names = docs.columns
    pairs = resolve(docs, id_col=id_col, text_col=text_col, keep=keep).groupBy("doc_id", "text_sha256")
    hit = stored(pairs.agg(F.max("kept").alias("stays"), F.count("*").alias("n")).where("not (stays and n = 1)"),
                 "dedup-dropped")
    sha = F.sha2(lower_ascii(col(text_col)).cast("binary"), 256)
    rows = docs.select(F.struct(*[col(c) for c in names]).alias("row"), col(id_col).alias("doc_id"), sha.alias("text_sha256"))

    def same(other: DataFrame):
        return rows["doc_id"].eqNullSafe(other["doc_id"]) & (rows["text_sha256"] == other["text_sha256"])

    out = rows.join(bounded(hit), same(hit), "left_anti").select("row")
    partly = hit.where("stays")
    if (n := partly.count()):
        one_each = (rows.join(bounded(partly, n), same(partly), "left_semi").groupBy("doc_id", "text_sha256")
                    .agg(F.min("row").alias("row")).select("row"))
        out = out.unionByName(one_each)
    return out.select(*[F.col("row")[c].alias(c) for c in names])
