"""Source text: slices, ids and simple measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and signs that open another path through a function.
DECISION_WORDS = ("and", "case", "catch", "elif", "for", "if", "or", "while")
DECISION_SIGNS = r"&&|\|\||\?"

WORD = r"[A-Za-z0-9_]+"
TOKEN = r"[A-Za-z0-9_]+|[^ \t\r\nA-Za-z0-9_]"


def text_lines(text: Column) -> Column:
    """Lines of a text, ``\\n`` or ``\\r\\n`` ended; a final line end opens no further line."""
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.regexp_replace(text, r"\r?\n\z", ""), r"\r?\n"))
    )


def method_code(source: Column, start: Column, end: Column) -> Column:
    """Lines start … end (1-based, inclusive) of a source; NULL source → NULL."""
    return slice_lines(F.split(source, "\n"), start, end)


def slice_lines(lines: Column, start: Column, end: Column) -> Column:
    """Lines start … end of an already split source, joined again."""
    first = F.greatest(start.cast("int"), F.lit(1))
    count = F.greatest(end.cast("int") - first + 1, F.lit(0))
    return F.array_join(F.slice(lines, first, count), "\n")


def surrogate_id(*parts: Column | str) -> Column:
    """48-bit id from a hash of the natural key, the same on every run."""
    digest = F.md5(F.concat_ws("-", *parts))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def line_count(text: Column) -> Column:
    """Lines that hold more than blanks."""
    return F.size(F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\r")) != "")).cast("bigint")


def token_count(text: Column) -> Column:
    """Words plus single signs."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def decision_count(text: Column) -> Column:
    """1 + number of decision words and signs."""
    words = F.filter(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: w.isin(*DECISION_WORDS))
    return (F.lit(1) + F.size(words) + F.regexp_count(text, F.lit(DECISION_SIGNS))).cast("bigint")


def signed_lines(diff: Column, sign: str) -> Column:
    """Number of diff lines that start with ``sign``."""
    return F.size(F.filter(F.split(diff, "\n"), lambda line: F.startswith(line, F.lit(sign)))).cast("bigint")
