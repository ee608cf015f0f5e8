"""Resolution of not-modified revisit records.

A crawler that asks a server again with validators and hears "304 Not Modified" writes a
revisit record: no body, and the headers of the short answer. To read it as a page, the
latest earlier full response of the same canonical URL is found (an as-of join), the
validators of both are compared, and the stored headers are updated by those that a 304 may
carry. The body is the full response's, referred to by its record id.

The as-of join does not gather a URL's captures: rows are range-partitioned by (URL, time),
so a URL with a third of all captures is cut into many segments. In a segment the last
full response is found by a window over (segment, URL); the last one of each segment is
carried to the later segments of its URL through a table of one row per (segment, URL)
that lies on a segment's border, at most two a segment.

Validators match if both have an entity tag and the tags are equal by weak comparison, or,
if either has none, if both have equal Last-Modified values. Without such a pair the
payload digest decides; with nothing to compare the revisit is unverified.

Defined cases: a null URL or time, or no earlier response, is ``no_response``; a response of
the same time counts as earlier if its record id is smaller (null first); of responses equal
in URL, time and id the one with the largest digest, then headers as sorted pairs, is taken;
repeated rows are resolved each; header names are compared in lower case, null headers are none; an empty
table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifecorpus.llm.common import col, prepare, stored

#: Headers that a 304 response may carry (RFC 9110, section 15.4.5).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]


def canonical_url(url: Column) -> Column:
    """Host in lower case without a leading "www." or "m.", no scheme, default port, fragment,
    tracking parameters or closing slash."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^(?:www|m)[.]", "")
    host = F.regexp_replace(host, ":(?:80|443)$", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/+$", "")
    kept = F.filter(F.split(F.regexp_extract(rest, r"[?](.*)$", 1), "&"),
                    lambda p: (p != "") & ~p.rlike("^(?:utm_[a-z]+|ref|fbclid|gclid)="))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _names_lower(headers: Column) -> Column:
    """The map with names in lower case; of names that differ in case only, the last value."""
    pairs = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    low = F.transform(pairs, lambda p: F.struct(F.lower(p["key"]).alias("key"), p["value"].alias("value")))
    last = F.aggregate(low, F.create_map().cast("map<string,string>"),
                       lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["key"]),
                                                 F.map_from_entries(F.array(p))))
    return last


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def _verdict(old: Column, new: Column, old_digest: Column, new_digest: Column) -> Column:
    a, b = _tag(old), _tag(new)
    c, d = old["last-modified"], new["last-modified"]
    tags, dates, digests = a.isNotNull() & b.isNotNull(), c.isNotNull() & d.isNotNull(), \
        old_digest.isNotNull() & new_digest.isNotNull()
    same = F.when(tags, a == b).when(dates, c == d).when(digests, old_digest == new_digest)
    return F.when(same, "resolved").when(~same, "validator_mismatch").otherwise("unverified")


def merged_headers(old: Column, new: Column) -> Column:
    """The stored headers with those of the 304 that may replace them."""
    put = F.map_filter(new, lambda k, _: k.isin(PERMITTED))
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(put, k)), put)


def resolve(captures: DataFrame, *, id_col: str = "record_id", url_col: str = "url", time_col: str = "time",
            kind_col: str = "kind", headers_col: str = "headers", digest_col: str = "digest") -> DataFrame:
    """One row per revisit (kind 'revisit'; full responses are 'response'): record_id, canonical_url, time,
    refers_to (the full response's id), status, headers (merged, null unless resolved or unverified)."""
    prepare(captures.sparkSession)
    c = captures.where(col(kind_col).isin("response", "revisit")).select(
        col(id_col).alias("id"), canonical_url(col(url_col)).alias("url"), col(time_col).alias("time"),
        (col(kind_col) == "response").alias("full"), _names_lower(col(headers_col)).alias("headers"),
        col(digest_col).alias("digest"))
    pairs = F.array_sort(F.map_entries("headers"))
    c = stored(c.withColumn("pairs", pairs).repartitionByRange("url", "time", "id").withColumn("seg", F.spark_partition_id()),
               "captures")
    known = F.col("full") & F.col("url").isNotNull() & F.col("time").isNotNull()
    page = F.when(known, F.struct("id", "pairs", "digest"))
    # rows equal in URL, time and id share a segment; of these, revisits come before responses
    order = ["time", "id", "full", "digest", "pairs"]
    before = Window.partitionBy("seg", "url").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = c.withColumn("near", F.last(page, ignorenulls=True).over(before))
    edge = c.groupBy("seg").agg(F.min("url").alias("lo"), F.max("url").alias("hi"))
    ends = (c.withColumn("known", known).join(edge, "seg")
            .where((F.col("url") == F.col("lo")) | (F.col("url") == F.col("hi")))
            .groupBy("seg", "url").agg(F.max(F.when(F.col("known"), F.struct("time", "id", "digest", "pairs"))).alias("end")))
    earlier = Window.partitionBy("url").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("far", F.last("end", ignorenulls=True).over(earlier)).where(F.col("far").isNotNull())
    far = stored(carried.select(F.col("seg").alias("s"), F.col("url").alias("u"),
                                F.struct("far.id", "far.pairs", "far.digest").alias("far_page")), "captures-carried")
    asked = near.where(~F.col("full"))
    out = asked.join(far, (asked["seg"] == far["s"]) & (asked["url"] == far["u"]), "left")
    old = F.when(F.col("time").isNotNull(), F.coalesce("near", "far_page"))
    out = out.withColumn("old", F.when(old.isNotNull(), F.struct(old["id"].alias("id"), F.map_from_entries(old["pairs"]).alias("headers"),
                                                                 old["digest"].alias("digest"))))
    status = (F.when(F.col("old").isNull(), "no_response")
              .otherwise(_verdict(F.col("old.headers"), F.col("headers"), F.col("old.digest"), F.col("digest"))))
    out = out.withColumn("status", status)
    found = F.col("status").isin("resolved", "unverified")
    return out.select(F.col("id").alias("record_id"), F.col("url").alias("canonical_url"), "time",
                      F.when(found, F.col("old.id")).alias("refers_to"), "status",
                      F.when(found, merged_headers(F.col("old.headers"), F.col("headers"))).alias("headers"))
