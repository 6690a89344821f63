"""Exact deduplication (4) as a stateful stream.

1. ``land``: digest, identifier and content locator of each document are appended to a landing table.
   Texts stay where they are.
2. ``dedup_state``: a stream reads what landed. Its state, kept on disk by RocksDB and without expiry, holds per
   digest the least identifier, that document's locator and the number of documents. The
   stream combines the rows of a digest in each task before they move, so a digest of a third of all rows costs one
   row per task. A further delivery continues from the checkpoint.
3. ``assign``: each document is met with its digest's state. Documents whose digest was hit more than once are
   read again and grouped by digest and full text, again combined in each task; a digest that stands for several
   texts is split by the text itself.

Texts are equal when they are identical after each run of blanks became one space; null counts as empty.

Defined results: repeated rows are documents of their own with the same ``keep_id``; a null id is kept only where all ids
of the group are null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import BLANKS, id_and_text, whole_text

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All of an executor's stores share one bounded block cache and write buffer.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores would each hold some MB of files allocated ahead.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # A batch without new rows would change nothing.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def sha256_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def land(docs: DataFrame, path: str, digest: Callable[[Column], Column] = sha256_of) -> None:
    """Append ``digest, doc_id, locator`` of each document to the landing table at ``path``.

    The locator is the file that holds the content; with the identifier it finds the row.
    """
    docs = id_and_text(docs)
    docs.select(digest(normalised(F.col("text"))).alias("digest"), "doc_id", F.input_file_name().alias("locator")) \
        .write.mode("append").parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with these settings, which are put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def dedup_state(spark: SparkSession, landed: str, checkpoint: str, bytes_per_batch: int = 8 << 30) -> DataFrame:
    """Run the stream over all that landed since the last run; return its state.

    ``digest, keep_id, locator, group_size``, one row per digest ever seen. The state is read from the checkpoint, so
    it is there for the next delivery too.
    """
    arrived = (
        spark.readStream.schema("digest string, doc_id bigint, locator string")
        .option("maxBytesPerTrigger", bytes_per_batch).parquet(landed)
    )
    # Nulls last: an id goes before none.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("locator")))
    state = arrived.groupBy("digest").agg(least.alias("kept"), F.count("*").alias("group_size"))
    with settings(spark, STATE_SETTINGS):
        query = (
            state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        stored = spark.read.format("statestore").load(checkpoint)
    # The stored value has the buffers of the aggregates in order: the kept document, the number.
    kept, size = (F.col(f"value.`{f.name}`") for f in stored.schema["value"].dataType.fields)
    return stored.select(F.col("key.digest").alias("digest"), kept["doc_id"].alias("keep_id"),
                         kept["locator"].alias("locator"), size.cast("bigint").alias("group_size"))


def assign(docs: DataFrame, landed: DataFrame, state: DataFrame,
           digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """``doc_id, digest, keep_id, group_size`` of each document that landed, after the check of full texts.

    ``docs`` has what landed and is read once more for the check.
    """
    spark = docs.sparkSession
    by_digest = landed.select("doc_id", "digest").join(state.select("digest", "keep_id", "group_size"), "digest")
    # Identifiers are unique or repeat the row, so this exchange has no hot key; the next one gets one row per text
    # and task.
    hits = by_digest.where("group_size > 1").select(F.col("doc_id").alias("hit_id")).distinct()
    texts = (
        id_and_text(docs).select("doc_id", normalised(F.col("text")).alias("content"))
        .join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
        .select("doc_id", "content", digest(F.col("content")).alias("digest"))
        .groupBy("digest", "content").agg(F.count("*").alias("rows"))
    )
    path = scratch_path(spark, "texts")
    texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest").write.parquet(path)
    split = spark.read.schema("digest string").parquet(path)
    if split.isEmpty():
        return by_digest
    # Digests that stand for several texts: the text itself decides.
    several = (
        id_and_text(docs).select("doc_id", normalised(F.col("text")).alias("content"))
        .withColumn("digest", digest(F.col("content"))).join(split, "digest", "left_semi")
    )
    groups = several.groupBy("digest", "content").agg(F.min("doc_id").alias("keep_id"),
                                                      F.count("*").alias("group_size"))
    decided = several.join(groups, ["digest", "content"]).select(*by_digest.columns)
    return by_digest.join(split, "digest", "left_anti").unionByName(decided)


def dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """``doc_id, digest, keep_id, group_size`` of each document, in one delivery."""
    spark = docs.sparkSession
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "dedup-state")
    land(docs, landed, digest)
    state = dedup_state(spark, landed, checkpoint)
    return assign(docs, spark.read.schema("digest string, doc_id bigint, locator string").parquet(landed), state, digest)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The result per document with its digest as ``text_sha256`` and whether its row stays."""
    return dedup(docs).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of ``docs``. Of rows that repeat both identifier and text one stays."""
    kept = dedup_documents(docs).where("kept").select(
        F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_digest")).distinct()
    keyed = docs.select("*", F.col("doc_id").cast("bigint").alias("__own_id"),
                        sha256_of(normalised(whole_text())).alias("__own_digest"))
    on = F.col("__own_id").eqNullSafe(F.col("__kept_id")) & (F.col("__own_digest") == F.col("__kept_digest"))
    return keyed.join(kept, on, "left_semi").dropDuplicates(["__own_id", "__own_digest"]).select(*_names(docs))


def _names(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


SQL = r"""
WITH shown AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM shown GROUP BY text_sha256
)
SELECT s.doc_id, g.keep_id, g.group_size, s.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, s.text_sha256
FROM shown AS s JOIN groups AS g ON s.text_sha256 = g.text_sha256
"""
