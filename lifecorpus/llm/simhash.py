"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has 64 bits. Two that differ in three bits or fewer, cut into
two segments of 32 bits, differ by at most one bit in one segment. So each distinct
fingerprint is indexed under its 64 one-wildcard variants, (segment, wildcard
position, the other 31 bits); two segments within one bit of each other share a
variant, an equality join finds them, and the full distance verifies the pair.

Copies never meet as pairs. Documents of one fingerprint are one node. Under a
variant with two fingerprints the pair is checked at once. Under one with more, each
is checked against the smallest, which makes a star; components of these links are
formed, and then only fingerprints of one variant that are still in different
components are compared. Where a variant still has more than ``CUT_AGAIN``, their other
segment is first cut and indexed in the same way (two halves of 16 bits, one within a
bit). A pair in one component needs no comparison: nothing is added by its link. So no
link between components is lost.

Words are runs of anything but space and tab to carriage return, shingles are
``shingle`` words with repeats, and a bit is set if it is set in over half of the
shingles' XXH64 (seed 42) of UTF-8.

Defined cases: a null or empty text, or one without words, has fingerprint zero and
links like any other; fewer words than a shingle are one shingle; repeated rows are
one node; a component's id is the smallest id that is not null, null if there is none.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import bounded, col, prepare, stored, word_blocks
from lifecorpus.llm.components import components

SEED = 42
SEGMENT = 32
#: Fingerprints still to be compared under one variant beyond which their other segment is indexed as well.
CUT_AGAIN = 64
#: Bytes of words hashed at once: bounds the memory of a very long text.
BLOCK = 1 << 18
SPREAD = np.array([[(v >> (7 - k)) & 1 for k in range(8)] for v in range(256)], dtype=np.int64)


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    counts = np.zeros((8, 256), dtype=np.int64)
    n, carry = 0, []

    def add(joined) -> int:
        octets = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), dtype=">u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):  # how often each octet has each value; its bits are counted from that
            counts[k] += np.bincount(octets[:, k], minlength=256)
        return len(octets)

    for block in word_blocks((text or "").encode("utf-8", "surrogatepass").lower(), BLOCK):  # bytes: A-Z only
        words = carry + block
        n += add(map(b" ".join, zip(*[words[k:] for k in range(shingle)])))
        carry = words[max(len(words) - shingle + 1, 0):]
    if n == 0 and carry:
        n = add([b" ".join(carry)])
    ones = (counts @ SPREAD).ravel()
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            signed = pa.array(np.array(fp, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), signed], ["doc_id", "fp"])

    return src.mapInArrow(run, f"doc_id {kind}, fp long")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _wildcards(bits: Column, width: int, tag: int) -> Column:
    """Array of (tag, position, bits without that position) packed in a long."""
    lead = tag << 38
    return F.array(*[F.lit(lead | (i << 32)).bitwiseOR(bits.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << i))))
                     for i in range(width)])


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): the one-wildcard variants of both segments of every fingerprint."""
    mask = F.lit((1 << SEGMENT) - 1)
    low = F.col("fp").bitwiseAND(mask)
    high = F.shiftrightunsigned("fp", SEGMENT).bitwiseAND(mask)
    keys = F.concat(_wildcards(low, SEGMENT, 1), _wildcards(high, SEGMENT, 2))
    return fps.select(F.explode(keys).alias("key"), "fp")


def _other_half_variants() -> Column:
    """Variants of the segment that ``key`` does not index, cut into two halves of 16 bits."""
    rest = F.when(F.shiftright("key", 38) == 1, F.shiftrightunsigned("fp", SEGMENT)).otherwise(F.col("fp"))
    half = F.lit(0xFFFF)
    return F.concat(_wildcards(rest.bitwiseAND(half), 16, 1), _wildcards(F.shiftright(rest, 16).bitwiseAND(half), 16, 2))


def _close(most: int) -> Column:
    return hamming(F.col("a"), F.col("b")) <= most


def stars(fps: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) of distinct fingerprints that share a variant: the pair, or each with the
    smallest; (key, fp) of the variants with more than two)."""
    if not 0 <= most <= 3:
        raise ValueError("two segments with one wildcard find distances up to 3")
    # one exchange of the index, at every size: each variant's smallest fingerprint and their number beside every row
    w = Window.partitionBy("key")
    shared = stored(variants(fps).withColumn("lo", F.min("fp").over(w)).withColumn("n", F.count("*").over(w)).where("n > 1"),
                    "simhash-keys")
    star = shared.where("fp != lo").select(F.col("lo").alias("a"), F.col("fp").alias("b"))
    return star.where(_close(most)), shared.where("n > 2").select("key", "fp")


def between(members: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """(a, b, ra, rb): links of fingerprints that share a variant and have different roots."""
    joined = (members.join(roots, members["fp"] == roots["node"], "left")
              .select("key", "fp", F.coalesce("root", "fp").alias("root")))
    split = (joined.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
             .where("r0 != r1").select("key", "n"))
    open_ = stored(joined.join(split, "key"), "simhash-open")
    whole = open_.where(F.col("n") <= CUT_AGAIN).select("key", F.lit(0).cast("long").alias("sub"), "fp", "root")
    cut = open_.where(F.col("n") > CUT_AGAIN).select("key", F.explode(_other_half_variants()).alias("sub"), "fp", "root")
    fine = whole.unionByName(cut)
    left = fine.select("key", "sub", F.col("fp").alias("a"), F.col("root").alias("ra"))
    right = fine.select(F.col("key").alias("k"), F.col("sub").alias("s"), F.col("fp").alias("b"), F.col("root").alias("rb"))
    near = (F.col("key") == F.col("k")) & (F.col("sub") == F.col("s")) & (F.col("ra") < F.col("rb")) & _close(most)
    return left.join(right, near).select("a", "b", "ra", "rb")


def links(fps: DataFrame, most: int) -> DataFrame:
    """(a, b) pairs of distinct fingerprints within ``most`` bits that join up every
    component: not all pairs within one."""
    first, members = stars(fps, most)
    first = stored(first.distinct(), "simhash-links")
    return first.unionByName(between(members, components(first), most).select("a", "b").distinct())


def roots_of(fps: DataFrame, most: int) -> DataFrame:
    """(node, root) of every fingerprint that is within ``most`` bits of another one: root is the
    smallest fingerprint of its component. Components of the first links are formed, then, of the
    links between those, components with a node for each of them."""
    first, members = stars(fps, most)
    roots = components(first)
    late = stored(between(members, roots, most).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "simhash-late")
    if late.isEmpty():
        return roots
    above = components(late).select(F.col("node").alias("below"), F.col("root").alias("top"))
    ends = late.select(F.explode(F.array("a", "b")).alias("node"))  # a fingerprint without first links is its own component
    nodes = roots.unionByName(ends.select("node", F.col("node").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
    return nodes.join(above, nodes["root"] == above["below"], "left").select("node", F.coalesce("top", "root").alias("root"))


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
            most: int = 3) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id, root (the component's smallest fp)."""
    prepare(docs.sparkSession)
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    spread = nodes.select("fp").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    roots = roots_of(spread.checkpoint(), most)
    known = stored(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                   .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    table = known.join(smallest, "root").select("fp", "component_id", "root")
    return rows.join(table, "fp").select("doc_id", "fp", "component_id", "root")


def with_hex(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that stay, with their columns as they are: those whose id is their component's.

    Rows without an id, and repeated rows of the id that stays, are settled as follows: of
    the rows of one id the smallest as a record stays, and a component without any id keeps
    its smallest record."""
    names = docs.columns
    found = stored(classes(docs, id_col=id_col, text_col=text_col, **how), "simhash-classes")
    ids = stored(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max((F.col("doc_id") == F.col("component_id"))
                                             .cast("int")).alias("stays")), "simhash-stays")
    nameless = found.where("component_id is null").groupBy("fp").agg(F.min("root").alias("root")).checkpoint()
    rows = docs.select(F.struct(*[col(c) for c in names]).alias("row"), col(id_col).alias("doc_id"))
    drop = ids.where("n > 1 or stays is null or stays = 0").select("doc_id")
    out = rows.join(bounded(drop), rows["doc_id"].eqNullSafe(drop["doc_id"]), "left_anti").select("row")
    several = ids.where("n > 1 and stays = 1").select("doc_id")
    if (n := several.count()):
        more = rows.join(bounded(several, n), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("row").alias("row"))
        out = out.unionByName(more.select("row"))
    if (n := nameless.count()):
        own = F.pandas_udf(lambda s: s.map(lambda t: int(np.uint64(fingerprint(t, how.get("shingle", 3))).astype(np.int64))), "long")
        lost = rows.where("doc_id is null").select("row", own(F.coalesce(F.col("row")[text_col], F.lit(""))).alias("fp"))
        one = lost.join(bounded(nameless, n), "fp").groupBy("root").agg(F.min("row").alias("row"))
        out = out.unionByName(one.select("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in names])
