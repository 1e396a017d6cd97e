"""Text predicates, token counting and cutoff."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Java's Unicode white space leaves out U+001C..U+001F.
SPACE = r"\s\x1c-\x1f"
ANSI_SEQUENCE = r"\x1B\[[0-9;?]*[ -/]*[@-~]"

_NON_BLANK = rf"(?U)[^{SPACE}]"
_OUTER_SPACE = rf"(?U)\A[{SPACE}]++|(?<![{SPACE}])[{SPACE}]++\z"
_TOKEN = r"\S+"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.regexp_replace(text, _OUTER_SPACE, "")


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | ~text.rlike(_NON_BLANK)


def capitalize(text: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def tokens(text: Column) -> Column:
    """Default tokenizer: runs of non-space characters."""
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_TOKEN))


def cutoff(text: Column, limit: int, count: Column | None = None) -> Column:
    """The text up to the end of token number `limit`, white space kept as it is.

    The possessive quantifiers make one forward pass that stops at the limit.
    """
    count = token_count(text) if count is None else count
    head = F.regexp_extract(text, rf"\A(?:\s*+\S++){{0,{limit}}}+", 0)
    return F.when(count > limit, head).otherwise(text)


def clean_log_text(text: Column) -> Column:
    """Drop terminal escape sequences; CR and CRLF become LF."""
    return F.regexp_replace(F.regexp_replace(text, ANSI_SEQUENCE, ""), "\r\n?", "\n")


def slash_path(path: Column) -> Column:
    """Backslashes and control characters become slashes."""
    return F.regexp_replace(path, r"[\x00-\x1f\\]", "/")
