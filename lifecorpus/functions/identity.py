"""Owner identity predicates (P1, P2) as Column expressions."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lifecorpus.functions.text import py_strip
from lifecorpus.settings import Settings


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def is_me(sender: Column, s: Settings) -> Column:
    """Trimmed lower-case sender equals an own email or name, or contains an
    own email ("Name <addr>" form). Null/empty -> false."""
    low = F.lower(py_strip(sender))
    known = list(s.emails) + list(s.names)
    hit = low.isin(known) if known else F.lit(False)
    hit = hit | _any([low.contains(e) for e in s.emails])
    return F.coalesce(F.when(sender.isNull() | (sender == ""), F.lit(False)).otherwise(hit), F.lit(False))


def is_skipped(sender: Column, s: Settings) -> Column:
    """Lower-case sender contains any skip-listed fragment."""
    low = F.lower(F.coalesce(sender, F.lit("")))
    return _any([low.contains(p) for p in s.skip_senders])
