"""Diff-like texts from the documents: lines get a sign by their length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .testbed import tables


def _signed(line: Column) -> Column:
    size = F.length(line)
    sign = F.when(size % 5 == 0, "-").when(size % 5 == 1, "+").otherwise(" ")
    marked = F.concat(sign, line)
    return F.when(size % 7 == 3, "\\ No newline at end of file").otherwise(marked)


def diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, diff), whole texts."""
    documents = tables(spark, sf_dir)["documents"]
    lines = F.transform(F.split("text", "\n"), _signed)
    return documents.select("doc_id", "source", F.array_join(lines, "\n").alias("diff"))


# The same for the oracle.
DIFFS = r"""(
    SELECT doc_id, source, array_to_string([
        CASE WHEN length(x) % 7 = 3 THEN '\ No newline at end of file'
             WHEN length(x) % 5 = 0 THEN '-' || x WHEN length(x) % 5 = 1 THEN '+' || x ELSE ' ' || x END
        for x in string_split(text, chr(10))], chr(10)) AS diff
    FROM documents)"""

# Trimming characters that occur at line ends of the texts.
TRIM = "trim({0}, ' ' || chr(9) || chr(13))"
