"""One query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_words, fair_mix, grouped_prefix_join, license_scan, ordinal_toxicity, quality_neighbours, ranked_search, spotsigs,
    square_packing, stream_dedup, token_counts, vector_codes, warc_derivatives,
)
from .common import table
from .registry import ORACLES, QUERIES, register


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_spotsigs")
def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_edits(table(spark, sf_dir, "documents"))


@register("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


@register("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@register("op4_stream_dedup", stream_dedup.SQL)
def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.dedup_documents(table(spark, sf_dir, "documents"))


@register("op5_grouped_prefix_join")
def op5_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_prefix_join.join_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@register("op6_fair_mix", fair_mix.SQL)
def op6_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix_documents(table(spark, sf_dir, "documents"))


@register("op9_bpe_words")
def op9_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_words.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@register("op7_warc_derivatives", warc_derivatives.SQL)
def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_derivatives.derivatives(warc_derivatives.responses(table(spark, sf_dir, "pages")))


@register("op8_ordinal_toxicity")
def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal_toxicity.grade(docs, ordinal_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


@register("op10_quality_neighbours")
def op10_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_neighbours.fit(docs, labels.where(fold(F.col("doc_id")) != 0))
    return quality_neighbours.score_documents(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op11_vector_codes", vector_codes.SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


@register("op12_square_packing")
def op12_square_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return square_packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@register("op13_ranked_search", ranked_search.SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def load() -> tuple[dict, dict]:
    """(queries, oracles) by name."""
    return dict(QUERIES), dict(ORACLES)
