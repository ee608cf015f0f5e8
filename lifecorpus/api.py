"""The three data commands of the reference as functions: ingest, stats, build."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lifecorpus.operators import conversations, examples, report, segmented
from lifecorpus.settings import Settings
from lifecorpus.sources import store


def ingest(spark: SparkSession, raw_root: str, processed: str, s: Settings, only: list[str] | None = None):
    with segmented.job():
        return store.ingest(spark, raw_root, processed, s, only)


def stats(spark: SparkSession, processed: str) -> dict[str, DataFrame]:
    msgs = store.read_table(spark, processed, "messages")
    docs = store.read_table(spark, processed, "docs")
    return {"per_source": report.corpus_stats(msgs, docs), "total": report.my_tokens(msgs, docs),
            "unknown_senders": report.unknown_senders(msgs)}


def build_examples(spark: SparkSession, processed: str, s: Settings, val_fraction: float = examples.VAL_FRACTION
                   ) -> DataFrame:
    msgs = store.read_table(spark, processed, "messages")
    docs = store.read_table(spark, processed, "docs")
    conv = conversations.conversation_examples(msgs, s)
    wr = examples.writing_examples(docs, s)
    return examples.build_examples(conv, wr, val_fraction)


def build(spark: SparkSession, processed: str, s: Settings, val_fraction: float = examples.VAL_FRACTION,
          seed: int = 0) -> tuple[int, int, DataFrame]:
    """Write sft_train/ and sft_val/ JSON lines; returns counts and per-source counts."""
    with segmented.job():
        ex = build_examples(spark, processed, s, val_fraction)  # written examples, read by both sinks and the counts
    n_train, n_val = store.write_sft(ex, processed, seed)
    return n_train, n_val, examples.per_source_counts(ex)
