"""Incremental ingest of advisory files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def new_records(stream: DataFrame, known: DataFrame | None, key: str,
                event_time: str | None = None, delay: str = "7 days") -> DataFrame:
    """Records whose key is neither known nor seen before in the stream.

    Without ``event_time`` every key ever seen is kept in the state store. With
    it, a key is kept for ``delay`` only, which bounds the state; later repeats
    are then left to the known keys of the next start.
    """
    if known is not None:
        stream = stream.join(known.select(key).distinct(), key, "left_anti").select(*stream.columns)
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def incremental_ingest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str,
                       known: DataFrame | None = None, event_time: str | None = None,
                       files_per_batch: int | None = None, items: str | None = None, lines: bool = True,
                       rows: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """I4: append the advisories of files not seen before to ``target``; start again for each delivery.

    The checkpoint remembers the files read and the keys written, so a restart
    after a failure neither skips nor repeats records. ``items`` explodes an
    array column, such as a feed's item list, and takes its fields as columns.
    ``lines`` unset reads each file as one document, as yearly feeds are. A file that is not of the form said fails the
    stream; it would else give no rows without a word. ``rows`` makes the written rows of the items, such as
    ``feed.advisories``; ``key`` is one of their columns.
    """
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST").option("multiLine", not lines)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(source)
    if items:
        stream = stream.select(F.explode(items).alias("_item")).select("_item.*")
    if rows:
        stream = rows(stream)
    return (
        new_records(stream, known, key, event_time).writeStream.format("parquet")
        .option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
