"""Source jobs over files on disk (formats the reference parses but never tests)."""
from __future__ import annotations

import io
import json
import os
import zipfile
from pathlib import Path


from lifecorpus.sources import calendar, commits, files, lifelog, mail, meta_chats, social, whatsapp
from lifecorpus.sources.registry import run_sources
from lifecorpus.sources.store import read_jsonl, read_table, write_jsonl, write_records
from lifecorpus.schema import MESSAGE, MESSAGES, REJECTS, of_kind, records

from exports import ME


def w(path: Path, data, binary=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    if binary:
        path.write_bytes(data)
    else:
        path.write_text(data, encoding="utf-8")
    return path


def by_ord(rows):
    return sorted(rows, key=lambda r: (r.ord.path, r.ord.block, r.ord.pos))


def test_whatsapp_variants(spark, tmp_path):
    w(tmp_path / "a/WhatsApp Chat with Iga.txt",
      "[12.03.2020, 14:22:01] Iga: hej\n"
      "‎[12.03.2020, 14:23:00] Jan Kowal: <attached: 0001.jpg>\n"
      "[12.03.2020, 14:24:00] Jan Kowal: ok\n")
    w(tmp_path / "b/Czat WhatsApp z Ugo.txt",
      "3/12/20, 2:22 PM - Ugo: one\n3/25/20, 11:05 am - Jan Kowal: two\nline two\n")
    rows = by_ord(whatsapp.ingest_whatsapp(spark, str(tmp_path), ME).collect())
    assert [(r.thread_id, r.sender, r.text, r.timestamp) for r in rows] == [
        ("Iga", "Iga", "hej", "2020-03-12T14:22:01+00:00"),
        ("Iga", "Jan Kowal", "ok", "2020-03-12T14:24:00+00:00"),
        ("Ugo", "Ugo", "one", "2020-12-03T14:22:00+00:00"),
        ("Ugo", "Jan Kowal", "two\nline two", "2020-03-25T11:05:00+00:00"),
    ]
    assert rows[0].participants == ["Iga", "Jan Kowal"] and rows[1].is_me


def test_meta_e2ee_and_instagram(spark, tmp_path):
    w(tmp_path / "fb/e2ee/chat_with_zoe.json", json.dumps({
        "threadName": "Zoe", "participants": ["Zoe", "Jan Kowal"],
        "messages": [{"senderName": "Zoe", "timestamp": 1700000000000, "text": "hello"},
                     {"senderName": "Zoe", "timestamp": 1700000001000, "text": "gone", "isUnsent": True},
                     {"senderName": "Jan Kowal", "timestamp": 1700000002000, "text": "You sent an attachment."},
                     {"senderName": "Zoe", "timestamp": 1700000003000, "text": "Zoe reacted 👍 to your message"}]}))
    w(tmp_path / "fb/e2ee/broken.json", "{not json")
    w(tmp_path / "fb/posts/your_posts_1.json", json.dumps([{"timestamp": 1}]))
    w(tmp_path / "fb/inbox/t_9/message_1.json", json.dumps({"title": "T", "messages": [
        {"sender_name": "Jan Kowal", "timestamp_ms": 1700000009000, "content": "a"}]}))
    w(tmp_path / "fb/inbox/t_9/message_2.json", json.dumps({"title": "T", "messages": [
        {"sender_name": "Zoe", "timestamp_ms": 1700000010000, "content": "b"}]}))
    rows = meta_chats.ingest_instagram(spark, str(tmp_path / "fb"), ME).collect()
    got = sorted((r.source, r.thread_id, r.sender, r.text, r.thread_title) for r in rows)
    assert got == [("instagram", "e2ee/chat_with_zoe", "Zoe", "hello", "Zoe"),
                   ("instagram", "t_9", "Jan Kowal", "a", "T"), ("instagram", "t_9", "Zoe", "b", "T")]
    zoe = next(r for r in rows if r.text == "hello")
    assert zoe.participants == ["Zoe", "Jan Kowal"] and zoe.timestamp == "2023-11-14T22:13:20+00:00"


def test_facebook_posts(spark, tmp_path):
    w(tmp_path / "your_activity/posts/your_posts_1.json", json.dumps([
        {"timestamp": 1600000000, "title": "Jan updated status", "data": [{"post": "Nowy post"}]},
        {"timestamp": 1600000001, "data": [{"update_timestamp": 1}]}]))
    w(tmp_path / "your_activity/comments/comments.json", json.dumps({"comments_v2": [
        {"timestamp": 1600000100, "data": [{"comment": {"comment": "Fajne!", "author": "Jan"}}]}]}))
    w(tmp_path / "messages/inbox/x/your_posts_9.json", json.dumps([{"timestamp": 5, "data": [{"post": "no"}]}]))
    rows = social.ingest_facebook_posts(spark, str(tmp_path), ME).collect()
    got = sorted((r.doc_id, r.title, r.text, r.meta["kind"]) for r in rows)
    assert got == [("comment-1600000100", "Facebook comment", "Fajne!", "comment"),
                   ("post-1600000000", "Jan updated status", "Nowy post", "post")]


def test_twitter(spark, tmp_path):
    w(tmp_path / "data/tweets.js", "window.YTD.tweets.part0 = " + json.dumps([
        {"tweet": {"id_str": "1", "full_text": "first  tweet ", "created_at": "Wed Oct 10 20:19:24 +0000 2018",
                   "in_reply_to_screen_name": "bob"}},
        {"tweet": {"id_str": "2", "full_text": "RT @x: no", "created_at": "Wed Oct 10 20:19:24 +0000 2018"}}]))
    w(tmp_path / "data/tweets-deleted.js", "window.X = " + json.dumps([{"tweet": {"id_str": "3", "full_text": "d",
                                                                                  "created_at": ""}}]))
    w(tmp_path / "data/account.js", 'window.YTD.account.part0 = [{"account": {"accountId": "77"}}]')
    w(tmp_path / "data/direct-messages.js", "window.YTD.direct_messages.part0 = " + json.dumps([
        {"dmConversation": {"conversationId": "77-5", "messages": [
            {"messageCreate": {"createdAt": "2019-01-01T10:00:00.000Z", "senderId": "5", "text": "yo"}},
            {"reactionCreate": {}},
            {"messageCreate": {"createdAt": "2019-01-01T10:01:00.000Z", "senderId": "77", "text": "hej"}}]}}]))
    dms, tweets = social.ingest_twitter(spark, str(tmp_path), ME)
    t = tweets.collect()
    assert [(r.doc_id, r.text, r.timestamp, r.meta) for r in t] == [
        ("1", "first  tweet", "2018-10-10T20:19:24+00:00", {"reply_to": "bob"})]
    d = sorted((r.sender, r.is_me, r.text, r.timestamp) for r in dms.collect())
    assert d == [("5", False, "yo", "2019-01-01T10:00:00.000Z"), ("77", True, "hej", "2019-01-01T10:01:00.000Z")]


def test_reddit_csv(spark, tmp_path):
    w(tmp_path / "comments.csv", "﻿id,date,subreddit,body\n"
      'c1,2020-01-01,python,"multi\nline, with ""quotes"""\nc2,2020-01-02,python,[deleted]\nc3,2020-01-03,x,\n')
    w(tmp_path / "posts.csv", "id,date,subreddit,title,body\np1,2020-02-01,rust,Hello,\n")
    rows = sorted(social.ingest_reddit(spark, str(tmp_path), ME).collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.title, r.text, r.meta["kind"]) for r in rows] == [
        ("c1", "r/python comment", 'multi\nline, with "quotes"', "comment"),
        ("p1", "Hello", "Hello", "post")]


def test_linkedin(spark, tmp_path):
    w(tmp_path / "messages.csv", "CONVERSATION ID,CONVERSATION TITLE,FROM,DATE,SUBJECT,CONTENT\n"
      "c1,,Jan Kowal,2021-01-01 10:00:00 UTC,Offer,Thanks!\nc1,,Recruiter,2021-01-01 09:00:00 UTC,Offer,Hi\n")
    w(tmp_path / "Shares.csv", "Date,ShareLink,ShareCommentary\n2021-02-01,http://l/1,Proud of the team\n2021,x,\n")
    w(tmp_path / "Profile.csv", "First Name,Last Name,Headline,Summary\nJan,Kowal,,Builds things\n")
    w(tmp_path / "Positions.csv", "Company Name,Title,Description,Started On,Finished On\n"
      "Acme,Engineer,Built it,Jan 2019,\nInit,Intern,,Jun 2018,Dec 2018\n")
    msgs, docs = social.ingest_linkedin(spark, str(tmp_path), ME)
    m = sorted((r.sender, r.is_me, r.thread_title, r.timestamp) for r in msgs.collect())
    assert m == [("Jan Kowal", True, "Offer", "2021-01-01 10:00:00 UTC"),
                 ("Recruiter", False, "Offer", "2021-01-01 09:00:00 UTC")]
    d = {r.doc_id: r for r in docs.collect()}
    assert d["http://l/1"].text == "Proud of the team"
    assert d["profile"].text == "First Name: Jan\nLast Name: Kowal\nSummary: Builds things"
    assert d["positions"].text == ("Engineer at Acme (Jan 2019 – now): Built it\n"
                                   "Intern at Init (Jun 2018 – Dec 2018): ")


def test_lifelog_feeds(spark, tmp_path):
    w(tmp_path / "YouTube/watch-history.json", json.dumps([
        {"title": "Watched Cats", "time": "2021-05-01T10:00:00Z"},
        {"title": "Obejrzano: Psy", "time": "2021-05-01T11:00:00Z"},
        {"title": "Watched https://youtu.be/x", "time": "2021-05-01T12:00:00Z"},
        {"title": "Watched Cats", "time": "2021-05-01T13:00:00Z"}]))
    w(tmp_path / "YouTube/search-history.json", json.dumps([{"title": "Searched for lofi beats",
                                                              "time": "2021-05-01T09:00:00Z"}]))
    w(tmp_path / "Chrome/History.json", json.dumps({"Browser History": [
        {"title": "Spark docs", "time_usec": 1619863200000000}]}))
    w(tmp_path / "Timeline.json", json.dumps({"semanticSegments": [
        {"startTime": "2021-05-01T08:00:00+02:00", "visit": {"topCandidate": {"semanticType": "HOME"}}},
        {"startTime": "2021-05-02T08:00:00+02:00", "visit": {"topCandidate": {"placeLocation": {"latLng": "1,2"}}}}]}))
    w(tmp_path / "Location History/Semantic Location History/2021/2021_MAY.json", json.dumps({"timelineObjects": [
        {"placeVisit": {"location": {"address": "Main St 1"}, "duration": {"startTimestamp": "2021-05-02T09:00:00Z"}}},
        {"activitySegment": {}}]}))
    rows = {r.doc_id: r for r in lifelog.ingest_lifelog(spark, str(tmp_path)).collect()}
    assert rows["2021-05-01"].text == ("Watched on YouTube: Cats; Psy\nSearched YouTube: for lofi beats\n"
                                       "Browsed: Spark docs\nVisited: HOME")
    assert rows["2021-05-02"].text == "Visited: 1,2; Main St 1"
    assert rows["2021-05-02"].title == "Activity on 2021-05-02"


def _docx(paragraphs):
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    xml = f'<?xml version="1.0"?><w:document xmlns:w="{ns}"><w:body>{body}</w:body></w:document>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", xml)
    return buf.getvalue()


def test_notes_and_drive(spark, tmp_path):
    notes = tmp_path / "notes"
    w(notes / "journal/day.md", "Dziś był dobry dzień, hasło: sekret1\r\n")
    w(notes / "short.txt", "too short")
    w(notes / ".obsidian/cfg.md", "hidden settings file that is long enough")
    w(notes / "page.HTML", "<html><head><title>x</title></head><body><p>Notes in a web page body</p></body></html>")
    w(notes / "report.docx", _docx(["First paragraph of the report", "Second one"]), binary=True)
    w(notes / "broken.docx", b"not a zip at all", binary=True)
    w(notes / "big.txt", "x" * 250_000)
    rows = {r.doc_id: r for r in files.ingest_notes(spark, str(notes)).collect()}
    assert set(rows) == {"journal/day.md", "page.HTML", "report.docx", "big.txt"}
    assert rows["journal/day.md"].text == "Dziś był dobry dzień, hasło: [SECRET]"
    assert rows["report.docx"].text == "First paragraph of the report\nSecond one"
    assert rows["page.HTML"].text == "Notes in a web page body" and rows["page.HTML"].title == "page"
    assert len(rows["big.txt"].text) == 250_000 and rows["big.txt"].authored_by_me
    rej = of_kind(files.notes_job(spark, str(notes)), REJECTS).collect()
    assert [(os.path.basename(r.path), r.reason) for r in rej] == [("broken.docx", files.BAD_DOCX)]
    google = tmp_path / "google"
    w(google / "Takeout/Dysk/Moje/plan.txt", "Plan na wakacje w górach")
    w(google / "Takeout/Mail/x.txt", "not a drive document at all")
    d = {r.doc_id: r for r in files.ingest_drive(spark, str(google)).collect()}
    assert set(d) == {"Moje/plan.txt"} and not d["Moje/plan.txt"].authored_by_me


def test_calendar_forms(spark, tmp_path):
    w(tmp_path / "work.ics", "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nUID:a\r\nDTSTART;VALUE=DATE:20220101\r\n"
      "SUMMARY:New year\\, party\r\nDESCRIPTION:line one\\nline\r\n  two\r\nATTENDEE;CN=Ann:mailto:ann@x.org\r\n"
      "END:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART;TZID=Europe/Warsaw:20220601T120000\r\nSUMMARY:Lunch\r\nEND:VEVENT\r\n"
      "BEGIN:VEVENT\r\nUID:c\r\nSUMMARY:   \r\nEND:VEVENT\r\nEND:VCALENDAR\r\n")
    rows = {r.doc_id: r for r in calendar.ingest_calendar(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a", "Lunch"}
    assert rows["a"].text == "New year, party\nDescription: line one\nline two\nWith: ann@x.org"
    assert rows["a"].timestamp == "2022-01-01T00:00:00+00:00"
    assert rows["Lunch"].timestamp == "2022-06-01T10:00:00+00:00" and rows["Lunch"].meta == {"calendar": "work"}


def test_commit_dump(spark, tmp_path):
    w(tmp_path / "lifecorpus.gitlog", "abc1\x1f2024-01-02T10:00:00+01:00\x1fFix parser\n\nDetails\n\x1e\n"
      "abc2\x1f2024-01-03T10:00:00+01:00\x1f  \n\x1e\n")
    rows = commits.ingest_commits(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.timestamp, r.title, r.text, r.meta) for r in rows] == [
        ("abc1", "2024-01-02T10:00:00+01:00", "Commit in lifecorpus", "Fix parser\n\nDetails", {"repo": "lifecorpus"})]


def test_html_mail_and_labels(spark, tmp_path):
    w(tmp_path / "m.mbox",
      "From a@x Thu Jan 01 00:00:00 2020\nFrom: Ann <ann@x.org>\nTo: jan@example.org\nSubject: =?utf-8?q?Cze=C5=9B=C4=87?=\n"
      "Date: Wed, 01 Jan 2020 10:00:00 +0100\nContent-Type: text/html; charset=utf-8\n\n"
      "<div>Nowa wiadomo&#347;&#263;</div><div class=\"gmail_quote\">stara</div>\n\n"
      "From b@x Thu Jan 01 00:00:00 2020\nFrom: Bob <bob@x.org>\nX-Gmail-Labels: Kosz\nSubject: x\n\nbye\n\n"
      "From c@x Thu Jan 01 00:00:00 2020\nFrom: Jan <JAN@example.org>\nPrecedence: bulk\nSubject: y\n\nmine anyway\n")
    rows = sorted(mail.ingest_mail(spark, str(tmp_path), ME).collect(), key=lambda r: r.timestamp)
    assert [(r.sender, r.text, r.thread_title, r.is_me) for r in rows] == [
        ("Jan", "mine anyway", "y", True), ("Ann", "Nowa wiadomość", "Cześć", False)]
    assert rows[1].timestamp == "2020-01-01T09:00:00+00:00"


def test_jsonl_roundtrip_and_reingest(spark, tmp_path):
    df = spark.createDataFrame([("whatsapp", "t", "", "A", False, "x", "", [], None),
                                ("twitter_dm", "d", "", "B", False, "y", "", [], None),
                                ("gmail", "g", "", "C", True, "z", "", [], None)], MESSAGE)
    assert write_jsonl(df, str(tmp_path / "m")) == 3
    back = read_jsonl(spark, str(tmp_path / "m"), MESSAGE)
    assert sorted(r.source for r in back.collect()) == ["gmail", "twitter_dm", "whatsapp"]
    write_records(spark, records(df, MESSAGES), str(tmp_path / "t"))
    write_records(spark, records(df.where("source = 'gmail'"), MESSAGES), str(tmp_path / "t"), only=["gmail", "twitter"])
    assert sorted(r.source for r in read_table(spark, str(tmp_path / "t"), MESSAGES).collect()) == ["gmail", "whatsapp"]


def test_missing_folders_are_skipped(spark, tmp_path):
    (tmp_path / "telegram").mkdir()
    m, d = run_sources(spark, str(tmp_path), ME)
    assert m.count() == 0 and d.count() == 0
