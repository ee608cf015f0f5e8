"""Dataset I/O: JSONL scan and sink (IO1, IO2), the normalized tables as Parquet
by source, written in one pass and made visible in one step, with partial
re-ingest (IO5, IO6, A12), and the SFT train/validation sinks (IO12)."""
from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifecorpus.schema import DOC, DOCS, MESSAGE, MESSAGES, SCHEMAS, TAGS, conform_docs, conform_messages, empty
from lifecorpus.sources.registry import owned_sources, run_records
from lifecorpus.settings import Settings


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """IO1: JSON lines with an explicit schema; blank lines are skipped and
    absent fields become the record defaults."""
    df = spark.read.schema(schema).json(path)
    if schema == MESSAGE:
        return conform_messages(df)
    if schema == DOC:
        return conform_docs(df)
    return df


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """IO2: write JSON lines (UTF-8, not ASCII-escaped) and return the row count,
    counted while writing (no second pass)."""
    obs = Observation("rows")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).json(path)
    return int(obs.get["n"])


# --- the corpus: runs and manifests --------------------------------------------------
#
# processed/runs/<run>/tag=messages|docs|rejects/part=<source>/*.parquet
# processed/manifest/<number>.json: for every tag and source, the run that holds its rows
#
# A run is one write of all tables. It becomes visible when the next manifest is created, in
# one step; a run that failed on the way is never read.

RUNS, MANIFESTS = "runs", "manifest"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifests(spark: SparkSession, processed: str) -> list[int]:
    """The numbers of the corpus's manifests, the current one last."""
    fs, p = _fs(spark, os.path.join(processed, MANIFESTS))
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-len(".json")]) for n in names if n.endswith(".json") and n[:-len(".json")].isdigit())


def _manifest(spark: SparkSession, processed: str, number: int) -> dict[str, dict[str, str]]:
    """tag -> source -> run."""
    lines = spark.read.text(os.path.join(processed, MANIFESTS, f"{number}.json"), wholetext=True).collect()
    return json.loads(lines[0].value)


def current(spark: SparkSession, processed: str) -> dict[str, dict[str, str]]:
    known = _manifests(spark, processed)
    return _manifest(spark, processed, known[-1]) if known else {}


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name, then give it its own, which must be free."""
    fs, p = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(f"{path}: another ingest was committed meanwhile")


def write_records(spark: SparkSession, recs: DataFrame, processed: str, only: list[str] | None = None) -> dict[str, int]:
    """IO5, IO6: one write of messages, docs and rejects, then one commit. A full ingest replaces the
    corpus. One of ``only`` some sources replaces what they own, also where they gave no rows (quirk
    Q10), and keeps the rest as it lies. Returns the rows written per table."""
    run, before = uuid.uuid4().hex, _manifests(spark, processed)
    seen = Observation("records")
    # a few names per table: the sources present are bounded by the registry
    counts = [F.count_if(F.col("tag") == t).alias(t) for t in TAGS]
    present = F.collect_set(F.struct("tag", "source")).alias("present")
    recs.withColumn("part", F.col("source")).observe(seen, *counts, present) \
        .write.partitionBy("tag", "part").parquet(os.path.join(processed, RUNS, run))
    got = seen.get
    old = _manifest(spark, processed, before[-1]) if only and before else {}
    owned = set(owned_sources(only)) if only else set()
    new = {t: {s: r for s, r in old.get(t, {}).items() if s not in owned} for t in TAGS}
    for r in got["present"]:
        new[r["tag"]][r["source"]] = run
    number = before[-1] + 1 if before else 1
    _create(spark, os.path.join(processed, MANIFESTS, f"{number}.json"), json.dumps(new, sort_keys=True))
    return {t: int(got[t]) for t in TAGS}


def vacuum(spark: SparkSession, processed: str) -> None:
    """Delete runs that neither the current manifest nor the one before it names (readers of that one
    may still be at work), and older manifests."""
    known = _manifests(spark, processed)
    kept = {r for n in known[-2:] for by_source in _manifest(spark, processed, n).values() for r in by_source.values()}
    fs, p = _fs(spark, os.path.join(processed, RUNS))
    for f in (fs.listStatus(p) if fs.exists(p) else []):
        if f.getPath().getName() not in kept:
            fs.delete(f.getPath(), True)
    for n in known[:-2]:
        fs.delete(_fs(spark, os.path.join(processed, MANIFESTS, f"{n}.json"))[1], False)


def ingest(spark: SparkSession, raw_root: str, processed: str, s: Settings, only: list[str] | None = None
           ) -> dict[str, int]:
    """Run the selected source jobs and commit their messages, docs and rejects; rows written per table."""
    counts = write_records(spark, run_records(spark, raw_root, s, only), processed, only)
    vacuum(spark, processed)
    return counts


def read_table(spark: SparkSession, processed: str, name: str) -> DataFrame:
    """A table of the corpus (messages, docs or rejects); empty if it has no rows (IO5)."""
    schema = SCHEMAS[name]
    parts = current(spark, processed).get(name, {})
    if not parts:
        return empty(spark, schema)
    paths = [os.path.join(processed, RUNS, run, f"tag={name}", f"part={source}") for source, run in sorted(parts.items())]
    df = spark.read.schema(schema).parquet(*paths)
    return conform_messages(df) if name == MESSAGES else conform_docs(df) if name == DOCS else df


def write_sft(examples: DataFrame, processed: str, seed: int = 0) -> tuple[int, int]:
    """IO12 + A5: training examples in a seeded shuffled order and validation
    examples, as JSON lines of {messages, source}."""
    from lifecorpus.operators.examples import shuffled_train
    train = shuffled_train(examples, seed).select("messages", "source")
    val = examples.where(F.col("split") == "val").select("messages", "source")
    return (write_jsonl(train, os.path.join(processed, "sft_train")),
            write_jsonl(val, os.path.join(processed, "sft_val")))
