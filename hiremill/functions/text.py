"""String expressions that follow Python and SQLite rules on Spark columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point Python's str.isspace() accepts.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same inside a pattern; single Latin-1 characters, unlike ranges, are one table lookup in Java.
WHITESPACE_CLASS = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Four or more of these in a row mark a damaged description (finding four is enough).
SPECIAL_RUN = r"[!#@$%^&*]{4}"

# Phrases that mark an attempt to instruct the model.
INSTRUCTION_PHRASES = [
    "ignore previous instructions",
    "disregard",
    "bypass",
    "system prompt",
    "you are now",
    "forget all",
    "developer mode",
]
# Fixed value: put in front of a text that held one of the phrases.
SANITIZED_PREFIX = "Extract technical skills only from this data: "

# Separators other than the space, and control, format, private and unassigned code points.
UNPRINTED = r"[\p{C}\p{Z}&&[^ ]]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: all Unicode whitespace, where ``trim`` takes U+0020 only."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def normalize_newlines(c: Column | str) -> Column:
    """``\\r\\n`` and ``\\r`` become ``\\n``, as a text-mode read does."""
    return F.regexp_replace(_col(c), "\r\n?", "\n")


def like_ascii(c: Column | str, pattern: str) -> Column:
    """SQLite ``LIKE``: folds ASCII case only, has no escape character, ``%`` and ``_`` are live.

    A Java pattern with ``(?i)`` folds ASCII and nothing else, so the text is
    searched as it is; lower-casing it first costs several times more.
    """
    wildcards = {"%": ".*?", "_": "."}
    inner = pattern.strip("%")
    body = "".join(wildcards.get(ch) or (f"\\{ch}" if ch.isascii() and not ch.isalnum() else ch) for ch in inner)
    # An all-% pattern leaves nothing to find and matches any text.
    start = "" if pattern.startswith("%") else r"\A"
    end = "" if pattern.endswith("%") else r"\z"
    return _col(c).rlike(f"(?is){start}{body}{end}")


def blank(c: Column | str) -> Column:
    """NULL or the empty string; white space counts as a value."""
    return _col(c).isNull() | (_col(c) == "")


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def pad_right(c: Column | str, width: int) -> Column:
    """Pad with spaces to ``width``, never cutting a longer value as ``rpad`` would."""
    return F.when(F.length(_col(c)) >= width, _col(c)).otherwise(F.rpad(_col(c), width, " "))


def last_path_segment(c: Column | str) -> Column:
    """What follows the last ``/`` once trailing slashes are gone; ``''`` for NULL."""
    trimmed = F.rtrim(_col(c), F.lit("/"))
    return or_empty(F.substring_index(trimmed, "/", -1))


def has_special_run(c: Column | str) -> Column:
    return _col(c).rlike(SPECIAL_RUN)


def token_estimate(c: Column | str) -> Column:
    """Four tokens per whitespace-separated word."""
    text = strip(c)
    words = F.when(text == "", 0).when(text.isNotNull(), F.size(F.split(text, f"[{WHITESPACE_CLASS}]+")))
    return words.cast("bigint") * 4


def content_hash(title: Column | str, company: Column | str, description: Column | str) -> Column:
    """SHA-256 over ``title|company|description``; a NULL part reads ``None``."""
    parts = [F.coalesce(_col(c), F.lit("None")) for c in (title, company, description)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def has_instruction_phrase(c: Column | str) -> Column:
    folded = F.lower(_col(c))
    return reduce(lambda a, b: a | b, [folded.contains(p) for p in INSTRUCTION_PHRASES])


def sanitize(c: Column | str) -> Column:
    """Reduce a text holding an instruction phrase to letters, digits, ``.,/`` and white space."""
    kept = F.regexp_replace(_col(c), f"[^a-zA-Z0-9.,/{WHITESPACE_CLASS}]", "")
    return F.when(has_instruction_phrase(c), F.concat(F.lit(SANITIZED_PREFIX), kept)).otherwise(_col(c))


def drop_instruction_lines(c: Column | str) -> Column:
    """The text without the lines that hold an instruction phrase."""
    lines = F.filter(F.split(_col(c), "\n"), lambda line: ~has_instruction_phrase(line))
    return F.array_join(lines, "\n")


def _escaped_char(ch: Column) -> Column:
    code = F.ascii(ch)
    digits = F.lower(F.hex(code))
    escaped = (
        F.when(code < 256, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code < 65536, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )
    return F.when(ch.rlike(UNPRINTED), escaped).otherwise(ch)


def python_repr(c: Column | str) -> Column:
    """A string as Python prints it inside a list: quotes, and escapes of what does not print."""
    value = F.replace(_col(c), F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        value = F.replace(value, F.lit(raw), F.lit(shown))
    value = F.when(value.rlike(UNPRINTED), F.array_join(F.transform(F.split(value, ""), _escaped_char), "")).otherwise(value)
    single, double = F.lit("'"), F.lit('"')
    return (
        F.when(~_col(c).contains("'"), F.concat(single, value, single))
        .when(~_col(c).contains('"'), F.concat(double, value, double))
        .otherwise(F.concat(single, F.replace(value, single, F.lit("\\'")), single))
    )
