"""HTML -> text, as an Arrow-batched pandas UDF around the stdlib parser.

Semantics of the reference's soup-based extraction: drop <style>, <script>,
<head>, <blockquote>, class gmail_quote / gmail_extra and id appendonsend with
everything inside; every remaining text node (split at any tag, comment or
declaration) is joined with newlines; whitespace-only nodes become one newline
(or one space when they hold no newline); 3+ newlines collapse to 2; strip.
"""
from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
DROP_TAGS = {"style", "script", "head", "blockquote"}
DROP_CLASSES = {"gmail_quote", "gmail_extra"}
DROP_IDS = {"appendonsend"}
# Elements that never have content (the parser treats them as self-closing).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta",
        "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex",
        "nextid", "spacer"}
# Whitespace inside these is kept as is.
PRESERVE = {"pre", "textarea"}
# ASCII whitespace that a whitespace-only text node may consist of.
ASCII_SPACE = " \n\t\x0c\r"
# End of fixed values
# ---------------------------------------------------------------------------

_MANY_NL = re.compile(r"\n{3,}")


class _Extractor(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool]] = []   # (tag, dropped)
        self.dropped = 0
        self.preserve = 0
        self.buf: list[str] = []
        self.out: list[str] = []

    def flush(self):
        if self.buf:
            s = "".join(self.buf)
            self.buf = []
            if not self.dropped:
                if not self.preserve and s.strip(ASCII_SPACE) == "":
                    s = "\n" if "\n" in s else " "
                self.out.append(s)

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in VOID:
            return
        a = dict(attrs)
        classes = set((a.get("class") or "").split())
        drop = tag in DROP_TAGS or bool(classes & DROP_CLASSES) or (a.get("id") in DROP_IDS)
        self.stack.append((tag, drop))
        self.dropped += drop
        self.preserve += tag in PRESERVE

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for t, d in self.stack[i:]:
                    self.dropped -= d
                    self.preserve -= t in PRESERVE
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.buf.append(data)

    def handle_comment(self, data):
        self.flush()

    def handle_decl(self, decl):
        self.flush()

    def handle_pi(self, data):
        self.flush()

    def unknown_decl(self, data):
        self.flush()


def html_to_text_py(html: str | None) -> str | None:
    """Per-row helper (also used by tests)."""
    if html is None:
        return None
    p = _Extractor()
    p.feed(html)
    p.close()
    p.flush()
    return _MANY_NL.sub("\n\n", "\n".join(p.out)).strip()


def _html_batch(s: pd.Series) -> pd.Series:
    return s.map(html_to_text_py)


def html_to_text(c: Column) -> Column:
    """Arrow-batched UDF (built on use, so importing this module needs no session)."""
    return F.pandas_udf(_html_batch, T.StringType())(c)
