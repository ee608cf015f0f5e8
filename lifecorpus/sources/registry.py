"""IO3-IO5: the source registry (name -> export folder, job), skipping of
missing or empty folders, and routing of records: every job gives one frame of
messages, docs and rejected files, told apart by a tag."""
from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lifecorpus.schema import DOCS, MESSAGES, RECORD, empty, of_kind, records
from lifecorpus.settings import Settings
from lifecorpus.sources import calendar, commits, files, lifelog, mail, meta_chats, social, telegram, whatsapp
from lifecorpus.sources.common import exists_nonempty


def _as(tag: str, fn: Callable) -> Callable:
    """The job of a source that is read record by record and rejects no file."""
    return lambda spark, root, s: records(fn(spark, root, s), tag)


# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference): registry order and export folders.
SOURCES = {
    "gmail": ("google", _as(MESSAGES, mail.ingest_mail)),
    "calendar": ("google", _as(DOCS, calendar.ingest_calendar)),
    "drive": ("google", files.drive_job),
    "lifelog": ("google", lifelog.lifelog_job),
    "messenger": ("facebook", meta_chats.messenger_job),
    "facebook": ("facebook", social.facebook_job),
    "instagram": ("instagram", meta_chats.instagram_job),
    "whatsapp": ("whatsapp", _as(MESSAGES, whatsapp.ingest_whatsapp)),
    "telegram": ("telegram", telegram.telegram_job),
    "twitter": ("twitter", social.twitter_job),
    "reddit": ("reddit", social.reddit_job),
    "linkedin": ("linkedin", social.linkedin_job),
    "notes": ("notes", files.notes_job),
    "git": ("git", _as(DOCS, commits.ingest_commits)),
}
# A source that also owns records under another name.
OWNED = {"twitter": ["twitter_dm"]}
# End of fixed values
# ---------------------------------------------------------------------------


def run_records(spark: SparkSession, raw_root: str, s: Settings, only: list[str] | None = None) -> DataFrame:
    """The records of the selected sources (all when ``only`` is empty). Missing or empty folders
    contribute nothing (IO4)."""
    selected = set(only or SOURCES)
    jobs = [empty(spark, RECORD)]
    for name, (folder, job) in SOURCES.items():
        root = os.path.join(raw_root, folder)
        if name in selected and exists_nonempty(spark, root):
            jobs.append(job(spark, root, s))
    return reduce(DataFrame.unionByName, jobs)


def run_sources(spark: SparkSession, raw_root: str, s: Settings, only: list[str] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """The message and document frames of the selected sources."""
    recs = run_records(spark, raw_root, s, only)
    return of_kind(recs, MESSAGES), of_kind(recs, DOCS)


def owned_sources(only: list[str]) -> list[str]:
    """Record sources a re-ingest of ``only`` replaces (twitter also owns twitter_dm)."""
    return sorted(set(only) | {o for n in only for o in OWNED.get(n, [])})
