"""Shared pieces of the training-data operators."""
from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.session import ensure_checkpoint_dir, ship_package

#: A word: a run of anything but space and the five ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A table of at most this many rows may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Rows handed to Python at once; documents may be long, so batches are kept small.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """What every job here needs: small batches, the shared checkpoint folder, the package on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (names may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read it back.

    Later branches read the written rows, so a lost executor repeats a scan and
    never the work above it. The folder is the cluster's to clean, as with any
    checkpoint."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/lifecorpus-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it was counted and is small, else as it is
    (then the join shuffles, and adaptive execution splits skewed partitions)."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def lower_ascii(text: Column) -> Column:
    """Null as empty, A-Z lower-cased, everything else untouched."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod).cast("int")


def rows_in(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)


SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of UTF-8 bytes in lists, each of about ``size`` bytes, so that a very long
    text is never a list of all its words. No word is cut."""
    at = 0
    while len(data) - at > size:
        gap = SPACE.search(data, at + size)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()  # on bytes: ASCII white space only
        at = end
    yield data[at:].split() if at else data.split()
