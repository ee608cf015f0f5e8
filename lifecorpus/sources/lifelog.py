"""Lifelog feeds (S5-S9) from a Takeout tree, rolled up per day.

Feeds: YouTube watch and search history, Chrome history, Maps Timeline in the
new (semanticSegments) and legacy (timelineObjects) shapes. Each becomes rows
(day, kind, item, seq) where seq is the feed order; the rollup is
``operators.lifelog.daily_rollup``. A file that cannot be read is a row without a
day, of kind ``UNREADABLE``, whose item is its path."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions.times import iso
from lifecorpus.operators.filters import keep_if
from lifecorpus.operators.lifelog import distinct_items, rollup
from lifecorpus.schema import DOCS, REJECTS, SOURCE_RANK, of_kind, records
from lifecorpus.sources.common import BAD_JSON, json_error, relative, whole_files

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
KIND_WATCHED = "Watched on YouTube"
KIND_SEARCHED = "Searched YouTube"
KIND_BROWSED = "Browsed"
KIND_VISITED = "Visited"
WATCH_PREFIXES = ["Watched ", "Obejrzano: "]
URL_PREFIX = "https://"
# End of fixed values
# ---------------------------------------------------------------------------

ENTRIES = "array<struct<title: string, time: string>>"
CHROME = "struct<`Browser History`: array<struct<title: string, time_usec: long>>, _corrupt_record: string>"
TIMELINE = ("struct<semanticSegments: array<struct<startTime: string, visit: struct<topCandidate: struct<"
            "semanticType: string, placeLocation: struct<latLng: string>>>>>, _corrupt_record: string>")
LEGACY = ("struct<timelineObjects: array<struct<placeVisit: struct<location: struct<name: string, address: string>,"
          " duration: struct<startTimestamp: string>>>>, _corrupt_record: string>")
#: Kind of the rows that stand for unreadable files.
UNREADABLE = "unreadable"


def _nz(c: Column) -> Column:
    return F.when(c != "", c)


def _seq(feed: int, root: str, i: Column) -> Column:
    return F.struct(F.lit(feed).alias("feed"), F.split(relative(F.col("path"), root), "/").alias("path"),
                    i.cast("long").alias("i"))


def read_feeds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {
        "watch": whole_files(spark, root, "watch-history.json"),
        "search": whole_files(spark, root, "search-history.json"),
        "chrome": whole_files(spark, root, "History.json"),
        "timeline": whole_files(spark, root, "Timeline.json"),
        "legacy": whole_files(spark, root, "*.json").where(F.col("path").contains("/Semantic Location History/")),
    }


def _items(raw: DataFrame, schema: str, field: str | None = None) -> DataFrame:
    """(path, i, e, error): the items of every file, or one row with an error."""
    d = raw.select("path", F.from_json("content", schema).alias("d"))
    if field is None:
        d = d.select("path", F.col("d").alias("items"), F.when(F.col("d").isNull(), F.lit(BAD_JSON)).alias("error"))
    else:
        items = F.col("d")[field]
        d = d.select("path", items.alias("items"), json_error(F.col("d"), F.coalesce(items.isNotNull(), F.lit(False))).alias("error"))
    return d.select("path", "error", F.posexplode_outer("items").alias("i", "e")) \
        .where(F.col("error").isNotNull() | F.col("e").isNotNull())


def _rows(items: DataFrame, feed: int, root: str, kind: str, day: Column, item: Column, keep: Column) -> DataFrame:
    """(day, kind, item, seq) of the items to ``keep``, and one row for each unreadable file."""
    failed = F.col("error").isNotNull()
    x = items.select("path", "i", "error", day.alias("day"), item.alias("item"), keep.alias("keep"))
    return x.where(failed | F.col("keep")).select(
        F.when(~failed, F.col("day")).alias("day"), F.when(failed, F.lit(UNREADABLE)).otherwise(F.lit(kind)).alias("kind"),
        F.when(failed, F.col("path")).otherwise(F.col("item")).alias("item"), _seq(feed, root, F.col("i")).alias("seq"))


def feed_rows(raw: dict[str, DataFrame], root: str = "") -> DataFrame:
    """-> (day, kind, item, seq), unreadable files included."""
    def given(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) != ""

    title = F.coalesce(F.col("e.title"), F.lit(""))
    watched = title
    for p in WATCH_PREFIXES:
        watched = F.when(watched.startswith(p), F.substr(watched, F.lit(len(p) + 1))).otherwise(watched)
    cand = F.col("e.visit.topCandidate")
    place = F.coalesce(_nz(cand["semanticType"]), cand["placeLocation"]["latLng"], F.lit(""))
    start = F.coalesce(F.col("e.placeVisit.duration.startTimestamp"), F.lit(""))
    name = F.coalesce(_nz(F.col("e.placeVisit.location.name")), F.col("e.placeVisit.location.address"), F.lit(""))
    out = [
        _rows(_items(raw["watch"], ENTRIES), 0, root, KIND_WATCHED, F.substring("e.time", 1, 10), watched,
              given("e.time") & (watched != "") & ~watched.startswith(URL_PREFIX)),
        _rows(_items(raw["search"], ENTRIES), 1, root, KIND_SEARCHED, F.substring("e.time", 1, 10),
              F.regexp_replace("e.title", "^[^ ]* ", ""), given("e.time") & given("e.title")),
        _rows(_items(raw["chrome"], CHROME, "Browser History"), 2, root, KIND_BROWSED,
              F.substring(iso(F.timestamp_micros(F.col("e.time_usec"))), 1, 10), F.col("e.title"),
              given("e.title") & (F.coalesce(F.col("e.time_usec"), F.lit(0)) != 0)),
        _rows(_items(raw["timeline"], TIMELINE, "semanticSegments"), 3, root, KIND_VISITED,
              F.substring("e.startTime", 1, 10), place, cand.isNotNull() & given("e.startTime")),
        _rows(_items(raw["legacy"], LEGACY, "timelineObjects"), 4, root, KIND_VISITED, F.substring(start, 1, 10), name,
              F.col("e.placeVisit").isNotNull() & (start != "") & (name != "")),
    ]
    return reduce(lambda a, b: a.unionByName(b), out)


def parse_feeds(raw: dict[str, DataFrame], root: str = "") -> DataFrame:
    """-> (day, kind, item, seq)."""
    return feed_rows(raw, root).where(F.col("kind") != UNREADABLE)


def lifelog_records(raw: dict[str, DataFrame], root: str = "", max_items: int | None = None) -> DataFrame:
    """Daily documents and unreadable files from one pass over the feeds: both are taken from
    the distinct items, whose shuffle is read twice."""
    items = distinct_items(feed_rows(raw, root))
    bad = F.col("kind") == UNREADABLE
    # through generators: a plain filter would move below the shuffle and make two of it
    days = rollup(keep_if(items, ~bad), SOURCE_RANK["lifelog"], max_items)
    failed = keep_if(items, bad).select(F.lit("lifelog").alias("source"), F.col("item").alias("path"),
                                        F.lit(BAD_JSON).alias("error"))
    return records(days, DOCS).unionByName(records(failed, REJECTS))


def lifelog_job(spark: SparkSession, root: str, s=None) -> DataFrame:
    return lifelog_records(read_feeds(spark, root), root, s.max_lifelog_items if s else None)


def ingest_lifelog(spark: SparkSession, root: str, s=None) -> DataFrame:
    return of_kind(lifelog_job(spark, root, s), DOCS)
