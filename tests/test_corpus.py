"""The corpus on disk: rejected files, folders with large files, CSV records of any width, and
writes that become visible at once or not at all."""
from __future__ import annotations

import csv
import io
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from lifecorpus import Settings, api
from lifecorpus.schema import DOCS, MESSAGE, MESSAGES, RECORD, REJECTS, of_kind, records
from lifecorpus.sources import common, files, social, store

ME = Settings.make("Ida Nowak", emails=["ida@example.org"], names=["ida"])


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def chat(text):
    return '{"participants": [{"name": "Bo"}], "messages": [{"sender_name": "Bo", "timestamp_ms": 1700000000000, "content": "%s"}]}' % text


def broken_archive(raw):
    put(raw / "facebook/messages/inbox/bo_1/message_1.json", chat("hello there"))
    put(raw / "facebook/messages/inbox/bo_1/message_2.json", chat("second page")[:60])
    put(raw / "facebook/messages/inbox/empty/message_1.json", " \\n")
    put(raw / "facebook/settings.json", '{"theme": "dark"}')           # valid JSON of another kind: no reject
    put(raw / "facebook/list.json", "[1, 2]")
    put(raw / "facebook/posts/your_posts_1.json", '[{"timestamp": 1700000000, "data": [{"post": "a post of mine"}]}]')
    put(raw / "facebook/posts/your_posts_2.json", '[{"timestamp": 1700000000, "data": [{"post"')
    put(raw / "instagram/inbox/x/message_1.json", chat("on instagram") + "")
    put(raw / "instagram/inbox/y/message_1.json", "{not json")
    put(raw / "telegram/a/result.json", '{"name": "Bo", "id": 5, "messages": [{"type": "message", "from": "Bo", "text": "hi", "date_unixtime": "1700000000"}]}')
    put(raw / "telegram/b/result.json", '{"name": "Bo", "id": 5, "messages": [{"type": "mess')
    put(raw / "twitter/data/tweets.js", 'window.YTD.tweets.part0 = [{"tweet": {"id_str": "1", "full_text": "a tweet", "created_at": "Mon Jan 01 10:00:00 +0000 2024"}}]')
    put(raw / "twitter/data/tweets-part1.js", 'window.YTD.tweets.part1 = [{"tweet": {"id_str"')
    put(raw / "twitter/data/direct-messages.js", "window.YTD.direct_messages.part0 = nothing")
    put(raw / "twitter/data/account.js", "window.YTD.account.part0 = [{")
    put(raw / "google/Takeout/YouTube/history/watch-history.json", '[{"title": "Watched a film", "time": "2024-01-02T10:00:00Z"}]')
    put(raw / "google/Takeout/YouTube2/history/watch-history.json", '[{"title": "Watched')
    put(raw / "google/Takeout/Chrome/History.json", '{"Browser History": [{"title"')
    put(raw / "google/Takeout/Drive/ok.md", "a document long enough to keep")
    put(raw / "google/Takeout/Drive/bad.docx", b"PK not a zip")
    put(raw / "notes/bad.DOCX", b"also no zip")
    put(raw / "reddit/comments.csv", "id,date,subreddit,title,body\na,2024,s,,fine words\nb,2024,s,,\"never closed" + ", x" * 30_000)
    put(raw / "reddit/old/comments.csv", "body,id\nother order,c\n")
    put(raw / "linkedin/Profile.csv", 'First Name,Headline\nIda,"says ""hi"""\n')
    put(raw / "linkedin/old/Profile.csv", 'First Name,Headline\nIda,"open')


def test_every_whole_file_format_writes_its_rejects(spark, tmp_path):
    broken_archive(tmp_path / "raw")
    out = str(tmp_path / "out")
    counts = api.ingest(spark, str(tmp_path / "raw"), out, ME)
    got = {(r.source, os.path.relpath(r.path, tmp_path / "raw"), r.reason) for r in store.read_table(spark, out, REJECTS).collect()}
    bad = common.BAD_JSON
    assert got == {
        ("messenger", "facebook/messages/inbox/bo_1/message_2.json", bad), ("messenger", "facebook/messages/inbox/empty/message_1.json", bad),
        ("facebook", "facebook/posts/your_posts_2.json", bad), ("instagram", "instagram/inbox/y/message_1.json", bad),
        ("telegram", "telegram/b/result.json", bad), ("twitter", "twitter/data/tweets-part1.js", bad),
        ("twitter_dm", "twitter/data/direct-messages.js", bad), ("twitter", "twitter/data/account.js", bad),
        ("lifelog", "google/Takeout/YouTube2/history/watch-history.json", bad), ("lifelog", "google/Takeout/Chrome/History.json", bad),
        ("drive", "google/Takeout/Drive/bad.docx", files.BAD_DOCX), ("notes", "notes/bad.DOCX", files.BAD_DOCX),
        ("reddit", "reddit/comments.csv", social.UNCLOSED), ("linkedin", "linkedin/old/Profile.csv", social.UNCLOSED)}
    assert counts[REJECTS] == len(got)
    assert sorted(r.text for r in store.read_table(spark, out, MESSAGES).collect()) == ["hello there", "hi", "on instagram"]
    texts = {(r.source, r.text) for r in store.read_table(spark, out, DOCS).collect()}
    assert {("facebook", "a post of mine"), ("twitter", "a tweet"), ("lifelog", "Watched on YouTube: a film"), ("reddit", "fine words"),
            ("reddit", "other order"), ("drive", "a document long enough to keep")} <= texts
    assert ("linkedin", 'First Name: Ida\nHeadline: says "hi"') in texts


def test_a_partial_ingest_replaces_the_rejects_of_its_sources(spark, tmp_path):
    put(tmp_path / "raw/telegram/result.json", "{")
    put(tmp_path / "raw/notes/x.docx", b"no")
    out = str(tmp_path / "out")
    api.ingest(spark, str(tmp_path / "raw"), out, ME)
    put(tmp_path / "raw/telegram/result.json", "{}")
    put(tmp_path / "raw/notes/x.docx", b"still no")
    api.ingest(spark, str(tmp_path / "raw"), out, ME, only=["telegram"])
    assert [r.source for r in store.read_table(spark, out, REJECTS).collect()] == ["notes"]


def test_one_open_quote_does_not_slow_the_reader(spark, tmp_path):
    put(tmp_path / "a/comments.csv", 'id,body\n1,"open' + "," * 30_000 + "\n" * 1000)
    put(tmp_path / "b/comments.csv", "id,body\n" + "".join(f"{i},word {i}\n" for i in range(5000)))
    began = time.monotonic()
    rows = social.read_csv_rows(spark, str(tmp_path), "comments.csv", ["id", "body"]).collect()
    assert time.monotonic() - began < 40
    assert sum(r.error is None for r in rows) == 5000 and [r.error for r in rows if r.error] == [social.UNCLOSED]


def test_records_split_as_the_csv_module_does(spark):
    r = random.Random(4)
    lines = ['a,"b ""c"" d",e', '"",x', ",,", '5" pipe,x', 'a"b"c,d', '"x"y,z', '""""', '"a\nb",c', "é,日本", '"one"', "a" + ",b" * 30_000,
             '"' + 'q""' * 3000 + '",z']
    lines += ["".join(r.choices(['"', ",", "a", "b c", '""', "\n"], k=r.randint(1, 14))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, record string").repartition(4)
    got = {x.i: x.r for x in df.select("i", social.split_record(F.col("record")).alias("r")).collect()}
    for i, line in enumerate(lines):
        try:
            want = next(csv.reader(io.StringIO(line, newline=""), strict=False))
        except csv.Error:
            continue
        if got[i].open or "\n" in line and got[i].cells != want:
            # an open quote takes all that follows; a bare line break ends a record before it gets here
            assert got[i].open == (state(line) == "in") or "\n" in line
            continue
        assert got[i].cells == want, line


def test_a_record_of_many_quotes_splits_in_linear_time(spark):
    n = 300_000
    df = spark.range(1).select(F.concat(F.lit('"'), F.repeat(F.lit('q""'), n), F.lit('",z,"'), F.repeat(F.lit('""'), n)).alias("record"))
    began = time.monotonic()
    r = df.select(social.split_record(F.col("record")).alias("r")).first().r
    assert time.monotonic() - began < 30
    assert r.open and r.cells == ['q"' * n, "z", '"' * n]


def test_csv_files_are_parsed_once(spark, tmp_path):
    put(tmp_path / "comments.csv", "id,body\n1,one\n")
    rows = social.read_csv_rows(spark, str(tmp_path), "comments.csv", ["id", "body"])
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 0  # read from what one pass wrote
    assert [(r.id, r.body) for r in rows.collect()] == [("1", "one")]


def state(line):
    """Whether a quote is open at the end of a record."""
    now, cell = "out", ""
    k = 0
    while k < len(line):
        c = line[k]
        if now == "in":
            if c == '"' and line[k + 1:k + 2] == '"':
                cell, k = cell + c, k + 1
            elif c == '"':
                now = "out"
                cell += "\0"
            else:
                cell += c
        elif c == '"' and cell == "":
            now = "in"
        else:
            cell = "" if c == "," else cell + c
        k += 1
    return now


def test_csv_files_of_any_width(spark, tmp_path):
    wide = 30_000
    put(tmp_path / "Profile.csv", ",".join(f"h{i}" for i in range(wide)) + "\n" + ",".join(f"v{i}" for i in range(wide)) + "\n")
    put(tmp_path / "old/Profile.csv", '\ufeffName,Note\r\nIda,"two\r\nlines"\r\nBo\r\n\r\n"single, quoted"\r\n')
    rows = sorted(social.read_csv_records(spark, str(tmp_path), "Profile.csv").collect(), key=lambda r: (r.path, r.row))
    assert [len(r.cells) for r in rows] == [wide, 2, 1, 1]
    assert rows[0].cells[-1] == f"v{wide - 1}" and rows[0].head[150] == "h150"
    assert [(r.head, r.cells) for r in rows[1:]] == [(["Name", "Note"], ["Ida", "two\r\nlines"]), (["Name", "Note"], ["Bo"]),
                                                     (["Name", "Note"], ["single, quoted"])]


def test_large_files_beside_notes_are_not_read(spark, tmp_path):
    notes = tmp_path / "notes"
    put(notes / "a.md", "a note that is long enough\rwith lone\rreturns\r\nand others")
    for name in ("film.mp4", "huge.TXT"):
        with open(notes / name, "wb") as f:
            f.truncate((2 << 30) + 12_345)  # sparse: no bytes on disk
    put(notes / "scan.pdf", b"%PDF")
    began = time.monotonic()
    job = files.notes_job(spark, str(notes))
    rows = job.collect()
    assert time.monotonic() - began < 30
    assert [(r.tag, r.doc_id if r.tag == DOCS else os.path.basename(r.path), r.reason) for r in sorted(rows, key=lambda r: r.tag)] == [
        (DOCS, "a.md", None), (REJECTS, "huge.TXT", files.TOO_LARGE)]
    assert [r.text for r in rows if r.tag == DOCS] == ["a note that is long enough\nwith lone\nreturns\nand others"]
    plan = files.read_files(spark, str(notes))._jdf.queryExecution().executedPlan().toString()
    assert "film.mp4" not in plan and "length" in plan
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True) \
        .option("pathGlobFilter", common.glob_of([".md", ".docx"])).load(str(notes))
    assert [os.path.basename(f) for f in listed.inputFiles()] == ["a.md"]


def some(spark, names, text="x"):
    rows = [(s, f"t{i}", "", "A", False, text, "", [], None) for i, s in enumerate(names)]
    return records(spark.createDataFrame(rows, MESSAGE), MESSAGES)


def read(spark, out):
    return sorted((r.source, r.text) for r in store.read_table(spark, out, MESSAGES).collect())


def test_a_failed_ingest_leaves_the_old_corpus(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    store.write_records(spark, some(spark, ["gmail", "reddit"], "old"), out)
    fails = some(spark, ["gmail"] * 50, "new").withColumn("text", F.when(F.col("thread_id") == "t49", F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        store.write_records(spark, fails, out)
    assert read(spark, out) == [("gmail", "old"), ("reddit", "old")]

    def no_commit(*_):
        raise OSError("no commit")
    with monkeypatch.context() as m:  # everything written, nothing visible
        m.setattr(store, "_create", no_commit)
        with pytest.raises(OSError):
            store.write_records(spark, some(spark, ["gmail"], "new"), out, only=["gmail"])
    assert read(spark, out) == [("gmail", "old"), ("reddit", "old")]
    store.write_records(spark, some(spark, ["gmail"], "new"), out, only=["gmail", "reddit"])
    assert read(spark, out) == [("gmail", "new")]  # reddit gave no rows: its old ones go


def test_of_two_ingests_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    store.write_records(spark, some(spark, ["gmail"], "first"), out)
    seen = store._manifests(spark, out)
    store.write_records(spark, some(spark, ["gmail"], "second"), out)
    monkeypatch.setattr(store, "_manifests", lambda *_: seen)
    with pytest.raises(FileExistsError):
        store.write_records(spark, some(spark, ["gmail"], "third"), out)
    monkeypatch.undo()
    assert read(spark, out) == [("gmail", "second")]


def test_vacuum_keeps_what_readers_may_use(spark, tmp_path):
    out = str(tmp_path)
    for text in ("one", "two", "three"):
        store.write_records(spark, some(spark, ["gmail"], text), out)
    store.vacuum(spark, out)
    assert len([d for d in os.listdir(tmp_path / "runs") if not d.startswith(".")]) == 2 and store._manifests(spark, out) == [2, 3]
    assert read(spark, out) == [("gmail", "three")]


def test_records_hold_every_table_once(spark):
    assert spark.createDataFrame([], RECORD).columns == some(spark, []).columns
    kinds = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema]
    assert kinds(of_kind(some(spark, ["gmail"]), MESSAGES).schema) == kinds(MESSAGE)
