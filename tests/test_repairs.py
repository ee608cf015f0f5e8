"""Whole inputs by default, and readers and store on awkward corpora."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lifecorpus import Settings, api
from lifecorpus.operators.lifelog import daily_rollup
from lifecorpus.schema import conform_messages, DOC, make_ord, MESSAGE, MESSAGES, records
from lifecorpus.session import ensure_checkpoint_dir
from lifecorpus.sources import calendar, commits, files, mail, social
from lifecorpus.sources.store import read_table, write_records

OWNER = Settings.make("Ida Nowak", emails=["ida@example.org"], names=["ida"])


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")



def messages(spark, sources):
    df = spark.createDataFrame([(s, f"t{i}", "2024-01-01T00:00:00+00:00", "ida", True, f"text {i}") for i, s in enumerate(sources)],
                               "source string, thread_id string, timestamp string, sender string, is_me boolean, text string")
    return conform_messages(df.withColumn("thread_title", F.lit("")).withColumn("participants", F.array(F.lit("ida")))
                            .withColumn("ord", make_ord(0)))


@pytest.mark.parametrize("limit,kept", [(None, 90), (60, 60)])
def test_a_day_lists_all_items_unless_limited(spark, limit, kept):
    feed = spark.range(90).select(F.lit("2024-05-01").alias("day"), F.lit("Watched").alias("kind"),
                                  F.format_string("v%03d", "id").alias("item"), F.col("id").alias("seq"))
    (row,) = daily_rollup(feed, max_items=limit).collect()
    assert row.text == "Watched: " + "; ".join(f"v{i:03d}" for i in range(kept))


def test_documents_are_whole_unless_limited(spark, tmp_path):
    put(tmp_path / "notes/long.md", "word " * 60_000)
    whole = files.ingest_notes(spark, str(tmp_path / "notes"), OWNER).first().text
    assert len(whole) == 299_999
    short = Settings.make("Ida Nowak", max_doc_chars=200_000)
    assert files.ingest_notes(spark, str(tmp_path / "notes"), short).first().text == whole[:200_000]


def test_a_full_ingest_after_a_partial_one_replaces_the_table(spark, tmp_path):
    out = str(tmp_path)
    write = lambda names, **kw: write_records(spark, records(messages(spark, names), MESSAGES), out, **kw)
    write(["reddit", "gmail"])
    write(["telegram", "telegram"], only=["telegram"])
    sources = lambda: sorted(r.source for r in read_table(spark, out, "messages").collect())
    assert sources() == ["gmail", "reddit", "telegram", "telegram"]
    write(["gmail"])
    assert sources() == ["gmail"]


def test_a_corpus_without_documents(spark, tmp_path):
    put(tmp_path / "raw/whatsapp/Chat with Bo.txt", "02.01.2024, 10:00 - Bo: hello there\n02.01.2024, 10:01 - ida: good morning to you\n")
    api.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), OWNER)
    assert read_table(spark, str(tmp_path / "out"), "docs").count() == 0
    assert read_table(spark, str(tmp_path / "out"), "docs").schema.fieldNames() == DOC.fieldNames()
    assert read_table(spark, str(tmp_path / "out"), "messages").schema.fieldNames() == MESSAGE.fieldNames()
    api.stats(spark, str(tmp_path / "out"))
    api.build(spark, str(tmp_path / "out"), OWNER)


def test_a_folded_label_line_is_read_whole(spark, tmp_path):
    head = "From 1@xxx Mon Jan 01 00:00:00 +0000 2024\nFrom: ida@example.org\nTo: bo@example.org\nDate: Mon, 1 Jan 2024 10:00:00 +0000\n"
    put(tmp_path / "All.mbox", head + "X-Gmail-Labels: Unread,\n Spam\nSubject: a\n\nfirst body of a mail\n\n"
        + head + "X-Gmail-Labels: Sent,\n Opened\nSubject: b\n\nsecond body of a mail\n")
    assert [r.text for r in mail.ingest_mail(spark, str(tmp_path), OWNER).collect()] == ["second body of a mail"]


EVENTS = """BEGIN:VCALENDAR
BEGIN:VEVENT
UID:a
SUMMARY:Call
DTSTART;TZID=Eastern Standard Time:20240102T090000
BEGIN:VALARM
DESCRIPTION:This is an event reminder
ATTENDEE:mailto:alarm@example.org
END:VALARM
LOCATION:Room 1
END:VEVENT
BEGIN:VEVENT
UID:b
SUMMARY:Impossible day
DTSTART;VALUE=DATE:20240230
END:VEVENT
BEGIN:VEVENT
UID:c
SUMMARY:Own zone
DTSTART;TZID=My Zone:20240102T090000
END:VEVENT
END:VCALENDAR
"""


def test_alarms_zones_and_impossible_dates(spark, tmp_path):
    put(tmp_path / "c.ics", EVENTS)
    got = {r.title: r for r in calendar.parse_calendar(calendar.read_calendar(spark, str(tmp_path)), str(tmp_path)).collect()}
    assert got["Call"].timestamp == "2024-01-02T14:00:00+00:00" and got["Call"].text == "Call\nLocation: Room 1"
    assert got["Impossible day"].timestamp == "" and got["Own zone"].timestamp == "2024-01-02T09:00:00+00:00"


def test_every_csv_file_has_its_own_header(spark, tmp_path):
    put(tmp_path / "a/comments.csv", "﻿id,date,body\nx1,2024-01-01,\"one\nline\"\n")
    put(tmp_path / "b/comments.csv", "body,id,other,date\ntwo,x2,?,2024-01-02\nthree,x3\n")
    rows = social.read_csv_rows(spark, str(tmp_path), "comments.csv", ["id", "date", "body", "title"]).collect()
    assert sorted((r.id, r.date, r.body, r.title) for r in rows) == [
        ("x1", "2024-01-01", "one\nline", None), ("x2", "2024-01-02", "two", None), ("x3", "", "three", None)]


def test_csv_cells_of_any_column_are_read(spark, tmp_path):
    names = [f"n{i}" for i in range(150)]
    put(tmp_path / "a/Profile.csv", ",".join(names) + "\n" + ",".join(f'"v{i}, ""{i}""\n"' for i in range(150)) + ',more,"and, more"\n')
    put(tmp_path / "b/Profile.csv", 'x,y\n5" by 7,3" by 4\n\n"' + "a, " * 3000 + '",z\n')
    got = {r.x or r.n149: (r.n0, r.y) for r in social.read_csv_rows(spark, str(tmp_path), "Profile.csv", ["n0", "n149", "x", "y"]).collect()}
    assert got == {'v149, "149"\n': ('v0, "0"\n', None), '5" by 7': (None, '3" by 4'), "a, " * 3000: (None, "z")}
    texts = [r.text for r in social.parse_linkedin_profile(social.read_csv_records(spark, str(tmp_path), "Profile.csv")).collect()]
    assert any('n149: v149, "149"' in t for t in texts)


def test_commits_of_others_are_left_out(spark, tmp_path):
    rec = "\x1e".join(["h1\x1f2024-01-01T00:00:00Z\x1fIda@example.org\x1fmine", "h2\x1f2024-01-01T00:00:00Z\x1fbo@example.org\x1ftheirs",
                       "h3\x1f2024-01-01T00:00:00Z\x1fwithout an author", ""])
    put(tmp_path / "repo.gitlog", rec)
    assert sorted(r.doc_id for r in commits.ingest_commits(spark, str(tmp_path), OWNER).collect()) == ["h1", "h3"]


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session)
