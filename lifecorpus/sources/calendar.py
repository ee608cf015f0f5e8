"""Calendar exports (*.ics) -> Doc 'calendar'.

Files are read as records split at 'BEGIN:VEVENT' (splittable); each record is
unfolded and its properties extracted with regexes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifecorpus.functions.text import py_strip
from lifecorpus.functions.times import iso
from lifecorpus.operators.filters import keep_if
from lifecorpus.schema import SOURCE_RANK, conform_docs, make_ord
from lifecorpus.sources.common import file_lines, relative, stem

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
TEXT_PROPERTIES = [("LOCATION", "Location: "), ("DESCRIPTION", "Description: ")]
ATTENDEES_PREFIX = "With: "
MAILTO = "mailto:"
# Zone names that some calendars write instead of those of the zone database.
ZONES = {"Eastern Standard Time": "America/New_York", "Central Standard Time": "America/Chicago",
         "Mountain Standard Time": "America/Denver", "Pacific Standard Time": "America/Los_Angeles",
         "GMT Standard Time": "Europe/London", "W. Europe Standard Time": "Europe/Berlin",
         "Romance Standard Time": "Europe/Paris", "Central Europe Standard Time": "Europe/Budapest",
         "Central European Standard Time": "Europe/Warsaw", "E. Europe Standard Time": "Europe/Chisinau",
         "India Standard Time": "Asia/Kolkata", "China Standard Time": "Asia/Shanghai",
         "Tokyo Standard Time": "Asia/Tokyo", "AUS Eastern Standard Time": "Australia/Sydney"}
# End of fixed values
# ---------------------------------------------------------------------------

_PARAMS = r'((?:;(?:[^:;"\r\n]|"[^"]*")*)*)'


def _prop(ev: Column, name: str) -> Column:
    """Raw value of the first ``name`` property (null when absent)."""
    pat = rf"(?m)^{name}{_PARAMS}:([^\r\n]*)"
    return F.when(ev.rlike(pat), F.regexp_extract(ev, pat, 2))


def _params(ev: Column, name: str) -> Column:
    return F.regexp_extract(ev, rf"(?m)^{name}{_PARAMS}:", 1)


def unescape(v: Column) -> Column:
    r"""iCalendar TEXT unescaping: \\ \n \N \, \;"""
    v = F.replace(v, F.lit("\\\\"), F.lit("\u0000"))
    for a, b in (("\\n", "\n"), ("\\N", "\n"), ("\\,", ","), ("\\;", ";")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return F.replace(v, F.lit("\u0000"), F.lit("\\"))


def known_zones(spark: SparkSession) -> list[str]:
    """The zone names that Spark converts from."""
    return sorted(spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds())


def dtstart(ev: Column, zones: list[str]) -> Column:
    """All-day dates -> midnight; 'Z' -> UTC; TZID=zone -> converted to UTC;
    floating times and unknown zones are taken as UTC, an impossible date is null."""
    v = _prop(ev, "DTSTART")
    params = _params(ev, "DTSTART")
    tzid = F.regexp_extract(params, r';TZID=("?)([^";:]*)\1', 2)
    named = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    tzid = F.coalesce(F.try_element_at(named, tzid), tzid)
    zone = F.when(tzid.isin(zones), tzid).otherwise("UTC")
    # read as UTC, whatever the session's zone is
    date_only = F.try_to_timestamp(F.concat(v, F.lit("T000000Z")), F.lit("yyyyMMdd'T'HHmmssX"))
    local = F.try_to_timestamp(F.concat(F.regexp_replace(v, "Z$", ""), F.lit("Z")), F.lit("yyyyMMdd'T'HHmmssX"))
    return (F.when(v.rlike(r"^\d{8}$"), date_only)
            .when(v.endswith("Z"), local)
            .otherwise(F.to_utc_timestamp(local, zone)))


def read_calendar(spark: SparkSession, root: str) -> DataFrame:
    return file_lines(spark, root, "*.ics", line_sep="BEGIN:VEVENT")


def parse_calendar(raw: DataFrame, root: str = "") -> DataFrame:
    """raw: (path, block, pos, value) records split at BEGIN:VEVENT."""
    ev = raw.where(F.col("value").contains("END:VEVENT")).withColumn(
        "ev", F.regexp_replace(F.split("value", "END:VEVENT", 2)[0], r"\r?\n[ \t]", ""))
    # properties of a nested alarm are the alarm's
    ev = ev.withColumn("ev", F.regexp_replace("ev", r"(?s)BEGIN:VALARM.*?(?:END:VALARM|\z)", ""))
    e = F.col("ev")
    summary = py_strip(F.coalesce(unescape(_prop(e, "SUMMARY")), F.lit("")))
    x = keep_if(ev.withColumn("summary", summary), F.col("summary") != "")
    parts = [F.col("summary")]
    for name, label in TEXT_PROPERTIES:
        v = unescape(_prop(e, name))
        parts.append(F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(label), v)))
    att = F.regexp_extract_all(e, F.lit(rf"(?m)^ATTENDEE{_PARAMS}:([^\r\n]*)"), F.lit(2))
    att = F.transform(att, lambda a: F.when(a.startswith(MAILTO), F.substr(a, F.lit(len(MAILTO) + 1)))
                      .otherwise(a))
    parts.append(F.when(F.size(att) > 0, F.concat(F.lit(ATTENDEES_PREFIX), F.array_join(att, ", "))))
    uid = unescape(_prop(e, "UID"))
    rel = relative(F.col("path"), root) if root else F.col("path")
    return conform_docs(x.select(
        F.lit("calendar").alias("source"), F.coalesce(uid, F.col("summary")).alias("doc_id"),
        iso(dtstart(e, known_zones(raw.sparkSession))).alias("timestamp"), F.col("summary").alias("title"),
        F.concat_ws("\n", *parts).alias("text"), F.lit(False).alias("authored_by_me"),
        F.create_map(F.lit("calendar"), stem(F.col("path"))).alias("meta"),
        make_ord(SOURCE_RANK["calendar"], F.split(rel, "/"), F.col("block"), F.col("pos")).alias("ord")))


def ingest_calendar(spark: SparkSession, root: str, s=None) -> DataFrame:
    return parse_calendar(read_calendar(spark, root), root)
