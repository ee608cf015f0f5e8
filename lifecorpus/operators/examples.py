"""Writing examples (A15, P6, T12), keep-first dedup (A2, T15), train/val split
(A4, T16), per-source counts (A3) and the seeded train shuffle (A5)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifecorpus.functions.hashing import example_digest, md5_mod_1000
from lifecorpus.operators.conversations import system_prompt
from lifecorpus.session import written
from lifecorpus.settings import Settings

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# Writing prompt per document source; {kind} defaults to "post", {subreddit} to "".
WRITING_PROMPTS = {
    "twitter": "Write a tweet.",
    "reddit": "Write a Reddit {kind} in r/{subreddit}.",
    "facebook": "Write a Facebook {kind}.",
    "linkedin": "Write a LinkedIn post.",
}
# Minimum document length for a writing example.
MIN_WRITING_CHARS = 20
# Default validation share (by thread/document key).
VAL_FRACTION = 0.03
# End of fixed values
# ---------------------------------------------------------------------------


def _meta(key: str, default: str) -> Column:
    v = F.col("meta")[key]
    return F.when(v.isNotNull() & (v != ""), v).otherwise(F.lit(default))


def writing_prompt(source: Column) -> Column:
    """The template filled from meta (empty values fall back to defaults)."""
    kind, sub = _meta("kind", "post"), _meta("subreddit", "")
    return (F.when(source == "twitter", F.lit(WRITING_PROMPTS["twitter"]))
            .when(source == "reddit", F.concat(F.lit("Write a Reddit "), kind, F.lit(" in r/"), sub, F.lit(".")))
            .when(source == "facebook", F.concat(F.lit("Write a Facebook "), kind, F.lit(".")))
            .when(source == "linkedin", F.lit(WRITING_PROMPTS["linkedin"])))


def writing_examples(docs: DataFrame, s: Settings) -> DataFrame:
    """A15 with P6: owner-written docs of a known source, >= 20 characters, become
    (system, user prompt, assistant text). The channel is the raw source name."""
    d = docs.where(F.col("authored_by_me") & F.col("source").isin(list(WRITING_PROMPTS))
                   & (F.length("text") >= MIN_WRITING_CHARS))
    sysmsg = system_prompt(s.name, F.col("source"), F.array().cast("array<string>"),
                           F.substring("timestamp", 1, 10))
    messages = F.array(
        F.struct(F.lit("system").alias("role"), sysmsg.alias("content")),
        F.struct(F.lit("user").alias("role"), writing_prompt(F.col("source")).alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content")))
    return d.select(
        "source", F.col("doc_id").alias("example_key"), messages.alias("messages"),
        F.struct(F.lit(1).alias("kind"), F.col("ord").alias("ord"), F.lit(0).cast("long").alias("session_no"),
                 F.lit(0).cast("long").alias("chunk_no")).alias("priority"))


def dedup_examples(examples: DataFrame) -> DataFrame:
    """A2: keep the first example (by priority) of every digest.

    Examples are written once, with their digest. The first ones are elected on
    (digest, priority) alone, a minimum that is combined map-side, and only the others'
    pairs are matched with the examples, to leave those out: where few examples repeat,
    Spark broadcasts the pairs and no text moves; otherwise rows are dealt by digest and
    priority together, so copies of one example lie apart. Priorities are unique."""
    d = written(examples.withColumn("digest", example_digest(F.col("messages"))), "examples")
    pairs = d.select("digest", "priority")
    repeated = pairs.groupBy("digest").agg(F.min("priority").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = pairs.join(repeated, "digest").where(F.col("priority") != F.col("first")).select("digest", "priority")
    return d.join(later, ["digest", "priority"], "left_anti").select("source", "example_key", "messages", "priority", "digest")


def assign_split(examples: DataFrame, val_fraction: float = VAL_FRACTION) -> DataFrame:
    """bucket = md5('source/key') mod 1000; validation below the share."""
    bucket = md5_mod_1000(F.concat(F.col("source"), F.lit("/"), F.col("example_key")))
    return (examples.withColumn("bucket", bucket)
            .withColumn("split", F.when(F.col("bucket") < F.lit(val_fraction * 1000), F.lit("val"))
                        .otherwise(F.lit("train"))))


def per_source_counts(examples: DataFrame) -> DataFrame:
    """A3: number of kept examples per source, largest first."""
    return examples.groupBy("source").agg(F.count(F.lit(1)).alias("n_examples")) \
        .orderBy(F.desc("n_examples"), F.asc("source"))


def shuffled_train(examples: DataFrame, seed: int = 0) -> DataFrame:
    """A5: reproducible seeded order of the training split (a range sort)."""
    return examples.where(F.col("split") == "train").orderBy(F.xxhash64("digest", F.lit(seed)))


def build_examples(conv: DataFrame, writing: DataFrame, val_fraction: float = VAL_FRACTION) -> DataFrame:
    """Union conversation and writing examples, dedup keep-first, split."""
    return assign_split(dedup_examples(conv.unionByName(writing)), val_fraction)
