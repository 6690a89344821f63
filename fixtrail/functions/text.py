"""Strings, numbers and dates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() takes for blanks.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts that stand for a missing value in stored tables.
MISSING_MARKERS = ("nan", "None", "")


def strip(text: Column) -> Column:
    """Remove blanks of any kind on both ends."""
    return F.btrim(text, F.lit(BLANKS))


def rstrip(text: Column) -> Column:
    """Remove blanks of any kind at the end."""
    return F.rtrim(text, F.lit(BLANKS))


def clean_signature(signature: Column) -> Column:
    """Trimmed and without spaces."""
    return F.replace(strip(signature), F.lit(" "), F.lit(""))


def parse_list(literal: Column) -> Column:
    """Text of a list of strings → array of trimmed strings."""
    return F.transform(F.from_json(literal, "array<string>"), strip)


def decode(text: Column) -> Column:
    """Markers of a missing value → NULL."""
    value = text
    for marker in MISSING_MARKERS:
        value = F.nullif(value, F.lit(marker))
    return value


def stored_number(text: Column) -> Column:
    """What a text-typed score counts as inside an average: markers are 0, NULL stays NULL (Q1)."""
    return F.when(text.isNotNull(), F.coalesce(decode(text).try_cast("double"), F.lit(0.0)))


# What becomes of parts of a column's name, applied in this order.
NAME_RULES = ((r"\bcvss_v(?=\d)", "cvss"), (r"_data(?=_|$)", "_json"), (r"\bdescription_json\b", "description"))


def snake_name(name: str) -> str:
    """S2 on a column name: what follows the second part of a dotted path, its words in small letters, then the rules.

    Every capital starts a word.
    """
    parts = name.split(".")
    words = [word for part in parts[2:] or parts[-1:] for word in re.findall("[A-Z]?[^A-Z]*", part) if word]
    snake = "_".join(words).lower()
    for pattern, by in NAME_RULES:
        snake = re.sub(pattern, by, snake)
    return snake


def snake_column(name: Column) -> Column:
    """S2 as an expression over a column of names."""
    parts = F.split(name, r"\.")
    leaf = F.when(F.size(parts) > 2, F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))).otherwise(
        F.slice(parts, -1, 1))
    words = F.flatten(F.transform(leaf, lambda p: F.regexp_extract_all(p, F.lit("([A-Z]?[^A-Z]*)"), F.lit(1))))
    snake = F.lower(F.array_join(F.filter(words, lambda w: w != ""), "_"))
    for pattern, by in NAME_RULES:
        snake = F.regexp_replace(snake, pattern, by)
    return snake


def short_number(number: Column) -> Column:
    """4500 → 4.5K, 4000 → 4K, also M and B; below 1000 one decimal."""
    def scaled(divisor: float, unit: str) -> Column:
        digits = F.bround(number / F.lit(divisor), 1).cast("decimal(38,1)").cast("string")
        return F.concat(F.regexp_replace(digits, r"\.0$", ""), F.lit(unit))

    return (
        F.when(number >= 1e9, scaled(1e9, "B"))
        .when(number >= 1e6, scaled(1e6, "M"))
        .when(number >= 1e3, scaled(1e3, "K"))
        .otherwise(scaled(1.0, ""))
    )


def hms(seconds: Column) -> Column:
    """Struct of whole hours, whole minutes and rounded seconds."""
    return F.struct(
        F.floor(seconds / 3600).cast("bigint").alias("hours"),
        F.floor((seconds % 3600) / 60).cast("bigint").alias("minutes"),
        F.bround((seconds % 3600) % 60, 0).cast("bigint").alias("seconds"),
    )


def days_between(first: Column, second: Column) -> Column:
    """Whole days between the date parts, never negative."""
    return F.abs(F.datediff(F.to_date(first), F.to_date(second)))


def mean_above_zero(value: Column, count: Column | None = None) -> Column:
    """Mean of a double that skips NULL and 0, each row counted ``count`` times (Q1)."""
    kept = F.nullif(value, F.lit(0.0))
    if count is None:
        return F.avg(kept)
    return F.sum(kept * count) / F.nullif(F.sum(F.when(kept.isNotNull(), count)), F.lit(0))


def mean_as_stored(text: Column, count: Column | None = None) -> Column:
    """Mean as text columns give it: zeros and markers count as 0."""
    value = stored_number(text)
    if count is None:
        return F.avg(value)
    return F.sum(value * count) / F.nullif(F.sum(F.when(value.isNotNull(), count)), F.lit(0))
