"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space as the contracts define it: space and the controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANKS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Bound the bytes of Arrow batches for this session, unless it has a bound; a longer row is a batch of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(limit))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (bigint) and ``text`` (never null), whatever else the input has; batches of texts get bounded."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; a longer row is a batch of its own."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for at, size in enumerate(sizes):
            if at > start and total + size > limit:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


def drops_blanks(tokenizer) -> bool:
    """Whether texts may be cut at ASCII blanks: a tokenizer of the ``tokenizers`` library that drops them."""
    alone = [n for text in ("a", "b", ".", "c") for n in tokenizer.encode(text, add_special_tokens=False).ids]
    return all(tokenizer.encode(f"{x}a{x}b{x}{x}.{x}c{x}", add_special_tokens=False).ids == alone
               for x in " \t\n\x0b\x0c\r")
