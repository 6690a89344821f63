"""The weakness catalogue, an XML document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

WEAKNESS = "_ID bigint, _Name string, Description string, Extended_Description string"
CATEGORY = "_ID bigint, _Name string, Summary string"


def read_weakness_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, description, extended_description, is_category) of weaknesses and categories.

    The extended description keeps the text of mixed content without its tags.
    """
    def nodes(tag: str, schema: str) -> DataFrame:
        return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)

    weaknesses = nodes("Weakness", WEAKNESS).select(
        F.col("_ID").alias("id"), F.col("_Name").alias("name"), F.col("Description").alias("description"),
        plain_text(F.col("Extended_Description")).alias("extended_description"), F.lit(False).alias("is_category"),
    )
    categories = nodes("Category", CATEGORY).select(
        F.col("_ID").alias("id"), F.col("_Name").alias("name"), F.col("Summary").alias("description"),
        F.lit("").alias("extended_description"), F.lit(True).alias("is_category"),
    )
    return weaknesses.unionByName(categories)


def plain_text(markup: Column) -> Column:
    """Text of an XML fragment."""
    return strip(F.regexp_replace(markup, "<[^>]+>", ""))
