"""Scalar text operators as Column -> Column expressions (JVM-side, codegen).

All patterns are Java regexes with the flags that give Python ``str`` regex
semantics: ``U`` (Unicode classes and case folding) and, where ``^``/``$`` act
per line, ``m`` plus ``d`` (only ``\\n`` ends a line, as in Python).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for identical results)
# Reply-header lines that start quoted history, English and Polish, matched
# case-insensitively per line; the text is cut at the first match.
REPLY_HEADERS = [
    r"^On .{5,200}wrote:\s*$",
    r"^W dniu .{5,200}(napisał|napisała|pisze)\S*:?\s*$",
    r"^\S+ .{0,100}(napisał|napisała)\S*:\s*$",
    r"^-{2,}\s*Original Message\s*-{2,}",
    r"^-{2,}\s*Wiadomość oryginalna\s*-{2,}",
    r"^-{2,}\s*Forwarded message\s*-{2,}",
    r"^-{2,}\s*Przekazana wiadomość\s*-{2,}",
    r"^From: .+$",
    r"^Od: .+$",
    r"^Sent from my \w+",
    r"^Wysłano z (mojego )?\w+",
    r"^_{10,}$",
]
# Signature separator line.
SIGNATURE = r"^-- ?$"
# Secret redactions, applied in this order: (pattern, replacement).
REDACTIONS = [
    ("card", r"\b(?:\d[ -]?){13,19}\b", "[CARD]"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}\b", "[IBAN]"),
    ("pesel", r"\b\d{11}\b", "[PESEL]"),
    ("secret", r"(?i)\b(password|hasło|haslo|pass|pwd|pin)\s*[:=]\s*\S+", "$1: [SECRET]"),
    ("otp", r"(?i)\b(code|kod)\s*(is|to|:)?\s*\d{4,8}\b", "$1 [OTP]"),
    ("api_key", r"\b(sk|pk|ghp|gho|xox[bap])[-_][A-Za-z0-9_-]{16,}\b", "[API_KEY]"),
]
# Line breaks recognised by Python's str.splitlines().
LINE_BREAKS = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
# Whitespace stripped by Python's str.strip(): Java's Unicode \s plus \x1c-\x1f.
PY_SPACE = r"[\s\x{1c}-\x{1f}]"
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200B))
                  + "\u2028\u2029\u202f\u205f\u3000")
# End of fixed values
# ---------------------------------------------------------------------------

# Every header pattern is anchored at a line start; checking the anchor once
# before the alternation lets the engine skip non-line-start positions fast.
assert all(p.startswith("^") for p in REPLY_HEADERS)
REPLY_RE = "(?dimU)^(?:" + "|".join(p[1:] for p in REPLY_HEADERS) + ")"
SIGNATURE_RE = "(?dmU)" + SIGNATURE
# A line whose first non-blank character is '>' (blanks: Python whitespace that
# is not a line break), with its line break.
QUOTED_LINE = r"(?dmU)^[[\s\x{1f}]&&[^\n]]*>.*(?:\n|\z)"
REDACTION_RULES = {name: ("(?U)" + pat, repl) for name, pat, repl in REDACTIONS}


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (a character-set trim, no regex)."""
    return F.trim(c, F.lit(PY_SPACE_CHARS))


def splitlines(c: Column) -> Column:
    """Python ``str.splitlines()``: no trailing empty element after a final break."""
    parts = F.split(c, LINE_BREAKS, -1)
    return F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""),
        F.slice(parts, 1, F.size(parts) - 1),
    ).otherwise(F.when(c == "", F.array().cast("array<string>")).otherwise(parts))


def cut_at(c: Column, pattern: str) -> Column:
    """Text before the first match of ``pattern`` (the whole text if none)."""
    return F.split(c, pattern, 2).getItem(0)


def strip_quotes(c: Column) -> Column:
    """Keep only the newly written part of a mail body."""
    head = cut_at(cut_at(c, REPLY_RE), SIGNATURE_RE)
    # splitlines + drop '>' lines + join('\n') in two passes: every line break
    # becomes '\n', then whole quoted lines (with their break) are removed.
    unix = F.regexp_replace(head, LINE_BREAKS, "\n")
    kept = F.regexp_replace(unix, QUOTED_LINE, "")
    return py_strip(kept)


def redact_one(c: Column, rule: str) -> Column:
    pat, repl = REDACTION_RULES[rule]
    return F.regexp_replace(c, pat, repl)


def redact(c: Column) -> Column:
    """T2a-f: the six secret redactions in the reference's order."""
    for name, _, _ in REDACTIONS:
        c = redact_one(c, name)
    return c


def fix_mojibake(c: Column) -> Column:
    """T4: text whose UTF-8 bytes were read as Latin-1 -> the intended text.

    Only strings made solely of U+0000..U+00FF can be re-encoded; the re-encoded
    bytes must be valid UTF-8, otherwise the input is kept."""
    latin = c.rlike(r"^[\x{00}-\x{ff}]*\z")
    repaired = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.coalesce(F.when(latin, repaired), c)


def normalize(c: Column) -> Column:
    """T5: CRLF -> LF, NBSP -> space, trailing blanks off, 3+ newlines -> 2, strip."""
    c = F.replace(c, F.lit("\r\n"), F.lit("\n"))
    c = F.replace(c, F.lit("\u00a0"), F.lit(" "))
    c = F.regexp_replace(c, "[ \\t]+\\n", "\n")
    c = F.regexp_replace(c, "\\n{3,}", "\n\n")
    return py_strip(c)


def clean_mail(c: Column) -> Column:
    """Mail body cleaning chain: strip quotes -> redact -> normalize."""
    return normalize(redact(strip_quotes(c)))


def clean_chat(c: Column) -> Column:
    """Chat text cleaning chain: redact -> normalize."""
    return normalize(redact(c))
