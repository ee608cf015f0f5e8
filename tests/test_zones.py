"""Results do not depend on the session's time zone."""
from __future__ import annotations

import random
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lifecorpus import Settings, api
from lifecorpus.functions.times import iso, iso_epoch, parse_iso_micros
from lifecorpus.sources import store

ZONES = ["UTC", "America/New_York", "Asia/Kolkata", "Pacific/Chatham"]
ME = Settings.make("Ida Nowak", emails=["ida@example.org"], names=["ida"])


@contextmanager
def zone(spark, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", name)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode())


@pytest.mark.parametrize("name", ZONES)
def test_iso_strings_are_utc(spark, name):
    r = random.Random(2)
    # around clock changes and midnights, before 1970, and at the ends of years
    secs = [0, -1, -86_400, -86_401, 1_710_054_000, 1_710_057_599, 1_730_613_600, 1_730_617_200, 4_102_444_799, -2_208_988_801]
    secs += [r.randint(-5_000_000_000, 20_000_000_000) for _ in range(500)]
    base = datetime(1970, 1, 1, tzinfo=timezone.utc)
    with zone(spark, name):
        df = spark.createDataFrame([(s,) for s in secs], "s long")
        got = {x.s: (x.a, x.b) for x in df.select("s", iso(F.timestamp_micros(F.col("s") * 1_000_000 + 999_999)).alias("a"),
                                                  iso_epoch(F.col("s")).alias("b")).collect()}
    want = {s: (base + timedelta(seconds=s)).isoformat() for s in secs}
    assert {s: a for s, (a, _) in got.items()} == want
    assert {s: b for s, (_, b) in got.items() if 0 <= s} == {s: w for s, w in want.items() if 0 <= s}


@pytest.mark.parametrize("name", ZONES)
def test_naive_times_are_utc(spark, name):
    texts = ["2024-03-10T02:30:00", "2024-03-10 02:30", "2024-11-03T01:30:00.250000", "2024-11-03", "1999-12-31T23:59:59Z",
             "2024-03-10T02:30:00+02:00", "2024-03-10T02:30:00-0500", "2024-06-01T10:00:00,5", "not a time", "", "2024-02-30"]
    with zone(spark, name):
        got = [x.t for x in spark.createDataFrame(list(enumerate(texts)), "i int, s string").orderBy("i").select(parse_iso_micros(F.col("s")).alias("t")).collect()]
    want = []
    for t in texts:
        try:
            d = datetime.fromisoformat(t)
            want.append(round((d if d.tzinfo else d.replace(tzinfo=timezone.utc)).timestamp() * 1_000_000))
        except ValueError:
            want.append(None)
    assert got == want


def archive(raw):
    put(raw / "whatsapp/WhatsApp Chat with Bo.txt", "10.03.2024, 02:30 - Bo: at the clock change\n10.03.2024, 02:45 - ida: an answer to that\n"
        "3/11/24, 2:30 AM - Bo: a day later\n")
    put(raw / "telegram/result.json", '{"name": "Bo", "id": 5, "messages": [{"type": "message", "from": "Bo", "text": "hi there", "date": "2024-03-10T02:30:00"},'
        ' {"type": "message", "from": "ida", "text": "hello to you", "date": "x", "date_unixtime": "1710055800"}]}')
    put(raw / "google/Takeout/Calendar/c.ics", "BEGIN:VEVENT\r\nUID:a\r\nDTSTART:20240310T023000\r\nSUMMARY:floating\r\nEND:VEVENT\r\n"
        "BEGIN:VEVENT\r\nUID:b\r\nDTSTART;TZID=Europe/Warsaw:20240331T033000\r\nSUMMARY:zoned\r\nEND:VEVENT\r\n"
        "BEGIN:VEVENT\r\nUID:c\r\nDTSTART;VALUE=DATE:20240310\r\nSUMMARY:all day\r\nEND:VEVENT\r\n"
        "BEGIN:VEVENT\r\nUID:d\r\nDTSTART:20240310T070000Z\r\nSUMMARY:utc\r\nEND:VEVENT\r\n")
    put(raw / "google/Takeout/Chrome/History.json", '{"Browser History": [{"title": "a page", "time_usec": 1710041400000000}]}')
    put(raw / "google/Takeout/Mail/All.mbox", "From 1@xxx Mon Jan 01 00:00:00 +0000 2024\nFrom: ida@example.org\nTo: bo@example.org\n"
        "Date: Sun, 10 Mar 2024 02:30:00 -0500\nSubject: s\n\na mail about the hour\n")
    put(raw / "twitter/data/tweets.js", 'x = [{"tweet": {"id_str": "1", "full_text": "a tweet of some length", "created_at": "Sun Mar 10 02:30:00 +0000 2024"}}]')
    put(raw / "notes/a.md", "a note that is long enough to keep")


def test_an_archive_gives_the_same_corpus_in_every_zone(spark, tmp_path):
    archive(tmp_path / "raw")
    seen = []
    for name in ("UTC", "America/New_York"):
        out = str(tmp_path / name.replace("/", "-"))
        with zone(spark, name):
            api.ingest(spark, str(tmp_path / "raw"), out, ME)
            n_train, n_val, _ = api.build(spark, out, ME)
            msgs = sorted((r.source, r.timestamp, r.text) for r in store.read_table(spark, out, "messages").collect())
            docs = sorted((r.source, r.doc_id, r.timestamp, r.text) for r in store.read_table(spark, out, "docs").collect())
            sft = sorted(str(r.messages) for r in spark.read.json(f"{out}/sft_train").collect()) if n_train else []
        seen.append((msgs, docs, n_train, n_val, sft))
    assert seen[0] == seen[1]
    times = {(s, t) for s, t, _ in seen[0][0]}
    assert {("whatsapp", "2024-03-10T02:30:00+00:00"), ("whatsapp", "2024-11-03T02:30:00+00:00"),
            ("gmail", "2024-03-10T07:30:00+00:00"), ("telegram", "2024-03-10T02:30:00")} <= times
    starts = {d: t for s, d, t, _ in seen[0][1] if s == "calendar"}
    assert starts == {"a": "2024-03-10T02:30:00+00:00", "b": "2024-03-31T01:30:00+00:00", "c": "2024-03-10T00:00:00+00:00",
                      "d": "2024-03-10T07:00:00+00:00"}
