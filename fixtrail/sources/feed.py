"""Advisory feeds: nested JSON, one file per year or JSON lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import shaping
from ..schemas import CVE, FEED

# First year of the published feeds.
FIRST_YEAR = 2002
DATE_TEXT = "yyyy-MM-dd'T'HH:mmX"


def read_advisory_feed(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    """One row per advisory of the feed files, below the columns of the feed's envelope.

    A yearly file is one JSON document and is read by one task; ``lines`` reads
    JSON-lines snapshots, which split.
    """
    raw = spark.read.schema(FEED).option("multiLine", not lines).json(paths)
    return explode_items(raw)


def explode_items(raw: DataFrame) -> DataFrame:
    """Rows of a feed's item array; a feed without items has no rows."""
    envelope = [name for name in raw.columns if name != "CVE_Items"]
    return raw.select(*envelope, F.explode("CVE_Items").alias("_item")).select(*envelope, "_item.*")


def advisories(items: DataFrame) -> DataFrame:
    """The ``cve`` table from feed items: flattened, cleaned, renamed, typed.

    A malformed date becomes null; ``malformed_dates`` counts them.
    """
    flat = shaping.flatten(items)
    flat = shaping.drop_empty_refs(flat, "cve.references.reference_data")
    flat = shaping.rename(flat, {"cve.CVE_data_meta.ID": "cve_id"})
    flat = shaping.snake_columns(shaping.drop_columns(flat))
    dates = {
        name: F.try_to_timestamp(name, F.lit(DATE_TEXT)) for name in ("published_date", "last_modified_date")
        if name in flat.columns
    }
    return shaping.align_schema(flat.withColumns(dates), CVE)


def malformed_dates(items: DataFrame) -> DataFrame:
    """Per date column the number of texts that are no date, in one row."""
    return items.agg(*[
        F.count(F.when(F.col(name).isNotNull() & F.try_to_timestamp(name, F.lit(DATE_TEXT)).isNull(), 1)).alias(name)
        for name in ("publishedDate", "lastModifiedDate")])


def year_window(df: DataFrame, column: str = "published_date", first: int | None = FIRST_YEAR, last: int | None = None,
                sample: bool = False, today: date | None = None) -> DataFrame:
    """Rows of the years first … last (default: this year); without ``first`` all before ``last`` too; ``sample`` keeps this year only.

    The limits are plain dates, so they reach the Parquet scan and prune by statistics.
    """
    this_year = (today or date.today()).year
    last = this_year if last is None else last
    if sample:
        first = last = this_year
    until = df.where(F.col(column) < F.lit(date(last + 1, 1, 1)))
    return until if first is None else until.where(F.col(column) >= F.lit(date(first, 1, 1)))


def feed_timestamp(feeds: DataFrame, column: str = "CVE_data_timestamp") -> DataFrame:
    """Newest date among the feeds' time stamps, in one row."""
    day = F.to_date(F.substring_index(F.col(column).cast("string"), "T", 1))
    return feeds.agg(F.max(day).alias("feed_date"))
