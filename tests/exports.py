"""Writers of small exports: each takes plain records and renders one format.

``choir_tour`` puts a scenario together from them; ``CHOIR`` says what it holds.
"""
from __future__ import annotations

import base64
import json
from pathlib import Path

from lifecorpus.settings import Settings

ME = Settings.make("Jan Kowal", emails=["jan@example.org"], names=["Jan Kowal", "jkowal"],
                   skip_senders=["noreply"])


def mbox(path: Path, mails: list[tuple[list[str], str]]) -> None:
    """(header lines, body) pairs as one mbox archive."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"From - {i}\n" + "\n".join(head) + f"\n\n{body}\n\n"
                            for i, (head, body) in enumerate(mails)), encoding="utf-8")


def multipart(*parts: tuple[str, str]) -> tuple[str, str]:
    """(content type header, body) of a mail with these (part headers, part text)."""
    body = "".join(f"--cut\n{head}\n\n{text}\n" for head, text in parts) + "--cut--"
    return 'Content-Type: multipart/mixed; boundary="cut"', body


def chat(path: Path, lines: list[str]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def calendar(path: Path, events: list[list[str]]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = ["BEGIN:VCALENDAR"]
    for e in events:
        lines += ["BEGIN:VEVENT", *e, "END:VEVENT"]
    path.write_text("\r\n".join([*lines, "END:VCALENDAR", ""]), encoding="utf-8")


def as_json(path: Path, value) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value), encoding="utf-8")


def b64(text: str) -> str:
    return base64.b64encode(text.encode()).decode()


def mangled(text: str) -> str:
    """As Messenger exports write it: UTF-8 bytes shown as Latin-1 characters."""
    return text.encode().decode("latin-1")


def choir_mails() -> list[tuple[list[str], str]]:
    kind, parts = multipart(
        ("Content-Type: text/plain; charset=iso-8859-2\nContent-Disposition: attachment; filename=score.txt", "la la la"),
        ("Content-Type: text/html; charset=utf-8", "<p>ignored, a plain part follows</p>"),
        ("Content-Type: text/plain; charset=utf-8", "The bus takes forty.\nDo we need two?"))
    owner, tour = "From: Jan Kowal <jan@example.org>", "X-GM-THRID: tour"
    return [
        ([tour, owner, "To: Bea <bea@example.org>", "Cc: dee@example.org", f"Subject: =?utf-8?b?{b64('Trasa chóru')}?=",
          "Date: Mon, 3 Oct 2022 08:00:00 +0200", "Content-Type: text/html; charset=utf-8",
          "Content-Transfer-Encoding: base64"], b64("<div>Dates are fixed.<br>Who books the bus?</div>")),
        ([tour, "From: =?utf-8?q?B=C3=A9a?= Lund <bea@example.org>", "To: jan@example.org", "Subject: Re: bus",
          "Date: Mon, 3 Oct 2022 21:30:00 +0000", kind], parts),
        ([tour, "From: bea@example.org", "Subject: Re: bus", "Date: Sat, 3 Dec 2022 10:00:00 +0000"],
         "Two months later: thank you all!"),
        (["X-Gmail-Labels: Unread,", " Spam", "From: prize@example.net", "Subject: won"], "You have won a choir."),
        (["Precedence: list", "From: list@example.net", "Subject: digest 7"], "Digest of the week"),
        (["Precedence: list", owner, "Subject: digest 8", "Date: 4 Oct 2022 12:00:00"], "Sheet music is on my desk"),
    ]


#: In export order: (time, sender, text) of the choir's group chat; None marks a line without a header.
GROUP_CHAT = [("18:00", "Dee", "warm-up at six?"), ("18:01", "Bea", "six is fine"), ("18:02", "Jan Kowal", "see you there"),
              (None, None, "bring water"), ("18:02", "Dee", "<Media omitted>"), ("23:30", "Dee", "good concert"),
              ("23:31", "Jan Kowal", "the best one"), ("23:32", "Bea", "sleep well")]

ALARM = ["BEGIN:VALARM", "TRIGGER:-PT30M", "DESCRIPTION:Ring the bell", "END:VALARM"]


def choir_tour(raw: Path) -> Path:
    mbox(raw / "google/Takeout/Mail/tour.mbox", choir_mails())
    chat(raw / "whatsapp/WhatsApp Chat with Choir.txt",
         ["Dee created this group"] + [f"08/10/2022, {t} - {who}: {text}" if t else text for t, who, text in GROUP_CHAT])
    calendar(raw / "google/Takeout/Calendar/choir.ics", [
        ["UID:concert", "DTSTART;TZID=Central European Standard Time:20221008T190000", "SUMMARY:Concert\\, part 1",
         *ALARM, "LOCATION:Old", "  Mill"],
        ["UID:never", "DTSTART;VALUE=DATE:20220231", "SUMMARY:No such day"]])
    box = raw / "facebook/your_activity/messages/inbox/altos_8"
    for k, messages in enumerate([[("Jan Kowal", 40, "só"), ("Bea", 30, None)], [("Dee", 20, "ré"), ("Bea", 10, "dó")]], 1):
        as_json(box / f"message_{k}.json", {
            "title": "Altos", "participants": [{"name": n} for n in ("Bea", "Dee", "Jan Kowal")],
            "messages": [{"sender_name": who, "timestamp_ms": 1665000000000 + 1000 * t} | ({"content": mangled(text)} if text else {})
                         for who, t, text in messages]})
    as_json(raw / "telegram/result.json", {"personal_information": {"user_id": 31}, "chats": {"list": [
        {"id": 1, "name": "Driver", "messages": [
            {"type": "service", "action": "phone_call", "date_unixtime": "1665200000"},
            {"type": "message", "from": "J.", "from_id": "user31", "date_unixtime": "1665200100",
             "text": [{"type": "bold", "text": "Gate 4"}, ", at noon"]}]},
        {"id": 2, "name": "News", "messages": [
            {"type": "message", "from": "News", "from_id": "channel5", "date_unixtime": "1665200200", "text": "Rain"}]}]}})
    return raw
