"""Diff texts and lists of changed lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .code import text_lines
from .text import strip

# One entry per changed line, as stored in file_change.diff_parsed.
PARSED_DIFF = "struct<added:array<struct<line:int,text:string>>,deleted:array<struct<line:int,text:string>>>"


def marked_lines(diff: Column, sign: str) -> Column:
    """Lines with ``sign`` in front, the sign removed, trimmed."""
    chosen = F.filter(text_lines(diff), lambda line: F.startswith(line, F.lit(sign)))
    return F.transform(chosen, lambda line: strip(F.substr(line, F.lit(2))))


def diff_dict(diff: Column) -> Column:
    """Struct of the added and the deleted lines of a prefixed text."""
    return F.struct(marked_lines(diff, "+").alias("added"), marked_lines(diff, "-").alias("deleted"))


def single_change(diff: Column) -> Column:
    """D3: struct of the last deleted line (``vul``) and the last added line (``patch``)."""
    return F.struct(
        F.try_element_at(marked_lines(diff, "-"), F.lit(-1)).alias("vul"),
        F.try_element_at(marked_lines(diff, "+"), F.lit(-1)).alias("patch"),
    )


def join_changes(lines: Column) -> Column:
    """Trimmed lines joined with blanks; for entries with a line number pass their text part."""
    return F.array_join(F.transform(lines, strip), " ")
