"""Time conversions: epoch/timestamps to the ISO strings the records carry (T6),
strict ISO parsing (T7) and chat date-time parsing (T8).

Records hold UTC. Everything here is arithmetic on epoch numbers or reads a written
offset, so results do not depend on the session's time zone."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings Python's datetime.fromisoformat accepts in the shapes exports use:
# date, date + time (minutes, seconds, fraction) and an optional offset or Z.
ISO_RE = (r"^\d{4}-\d{2}-\d{2}"
          r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?)?"
          r"(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)?$")


DAY = 86_400


def _two(n: Column) -> Column:
    return F.lpad(n.cast("int").cast("string"), 2, "0")


def iso(ts: Column) -> Column:
    """T6 for timestamps: UTC ISO-8601 with seconds precision (truncating), '' for null."""
    secs = F.unix_seconds(ts)
    of_day = F.pmod(secs, F.lit(DAY))
    date = F.date_from_unix_date(((secs - of_day) / DAY).cast("int")).cast("string")
    text = F.concat(date, F.lit("T"), _two(F.floor(of_day / 3600)), F.lit(":"), _two(F.floor(of_day / 60) % 60), F.lit(":"),
                    _two(of_day % 60), F.lit("+00:00"))
    return F.coalesce(text, F.lit(""))


def epoch_to_ts(x: Column) -> Column:
    """Seconds-or-milliseconds heuristic: values above 1e11 are milliseconds."""
    x = x.cast("double")
    return F.when(x > 1e11, F.timestamp_micros((x * 1000).cast("long"))) \
            .otherwise(F.timestamp_micros((x * 1000000).cast("long")))


def iso_epoch(x: Column) -> Column:
    """T6 for epoch numbers."""
    return iso(epoch_to_ts(x))


def parse_iso_micros(s: Column) -> Column:
    """Strict ISO string -> epoch microseconds (UTC for naive times), else null."""
    norm = F.regexp_replace(F.regexp_replace(s, "Z$", "+00:00"), ",", ".")
    norm = F.regexp_replace(norm, r"^(.{10}[T ]\d{2}:\d{2})(?=$|[+-])", "$1:00")
    norm = F.regexp_replace(norm, r"(:\d{2}(?:\.\d+)?[+-]\d{2})(\d{2})$", "$1:$2")
    naive = F.when(F.length(norm) == 10, F.concat(norm, F.lit("T00:00:00+00:00"))) \
        .when(~norm.rlike(r"[+-]\d{2}:?\d{2}(?::?\d{2})?$"), F.concat(norm, F.lit("+00:00"))).otherwise(norm)
    return F.when(s.rlike(ISO_RE), F.unix_micros(F.try_to_timestamp(naive)))


def day(s: Column) -> Column:
    """Day key = first 10 characters."""
    return F.substring(s, 1, 10)
