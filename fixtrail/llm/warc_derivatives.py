"""WARC derivatives (7): linked metadata and plain-text conversion records of responses.

Each response gives two records. Both name it in ``WARC-Refers-To`` and repeat its target and date; the conversion record
holds the page's plain text, the metadata record its title, language and number of links, the response's own
headers and digests, and the identifier of the conversion record. Identifiers follow from the response's identifier, so a
rerun gives the same. Everything happens in the row; nothing is shuffled. Marks go by built-in functions, character references and
blanks in one Arrow function.

Defined results: a null or empty payload gives an empty text and records of the same form; a null target or header block
counts as empty; line ends in a target are percent-encoded; repeated rows give repeated records; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPTURED = "2024-01-01T00:00:00Z"
CRLF = "\r\n"

# What the plain text loses or keeps of a page's marks, in order.
MARKS = (
    (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>", " "),
    (r"(?i)<(br|/p|p|/div|div|/h[1-6]|h[1-6]|/li|li|/tr|tr|/ul|ul|/nav|nav|/article|article)\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
_NO_BREAK = re.compile("&(?:nbsp|#160|#[xX]0*[aA]0);")


def without_marks(page: Column) -> Column:
    for pattern, by in MARKS:
        page = F.regexp_replace(page, pattern, by)
    return page


def readable(text: Column) -> Column:
    """A text with all character references decoded once, blanks run together and empty lines left out."""
    def lines(text: str) -> bytes:
        if "&" in text:
            text = html.unescape(_NO_BREAK.sub(" ", text))
        # Bytes split at ASCII blanks only.
        parts = (b" ".join(line.split()) for line in text.encode("utf-8", "replace").split(b"\n"))
        return b"\n".join(filter(None, parts))

    @F.arrow_udf("string")
    def decoded(texts: pa.Array) -> pa.Array:
        return pa.array([None if text is None else lines(text) for text in texts.to_pylist()], pa.binary()).cast(pa.string())

    return decoded(text)


def plain_text(page: Column) -> Column:
    return readable(without_marks(page))


def _uuid(text: Column) -> Column:
    """A record identifier made from a text."""
    digest = F.md5(F.encode(text, "UTF-8"))
    parts = [F.substring(digest, at, length) for at, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(text, "UTF-8"), 256))


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def responses(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """Response records of ``pages (page_id, url, html)``, as a crawler that got them would have written."""
    page = _text("html")
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                       _bytes(page).cast("string"))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        _uuid(F.concat(F.lit("response|"), _text("page_id"), F.lit("|"), _text("url"))).alias("record_id"),
        _text("url").alias("target_uri"), F.lit(captured).alias("date"), headers.alias("http_headers"),
        page.alias("payload"))


def derivatives(source: DataFrame, key: str = "page_id") -> DataFrame:
    """Two rows per row of ``source (key, record_id, target_uri, date, http_headers, payload)``.

    ``block`` is the record's content; ``warc_text`` (``serialised``) puts a record in the format of the files.
    """
    target, date, headers, payload = (_text(c) for c in ("target_uri", "date", "http_headers", "payload"))
    # A line end in an address would end its header.
    target = F.replace(F.replace(target, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    known = source.select(
        F.col(key), F.col("record_id").alias("refers_to"), target.alias("target_uri"), date.alias("date"),
        headers.alias("source_headers"), _digest(payload).alias("source_payload_digest"),
        _digest(F.concat(headers, F.lit(CRLF + CRLF), payload)).alias("source_block_digest"),
        _uuid(F.concat(F.lit("metadata|"), F.col("record_id"))).alias("metadata_id"),
        _uuid(F.concat(F.lit("conversion|"), F.col("record_id"))).alias("conversion_id"),
        # A title has no marks inside.
        readable(F.regexp_extract(payload, r"(?is)<title[^>]*>([^<]*)", 1)).alias("plain_title"),
        F.regexp_extract(payload, r'(?is)<html[^>]*\blang="([^"]*)"', 1).alias("language"),
        F.regexp_count(payload, F.lit(r"(?i)<a\s[^>]*href=")).cast("bigint").alias("links"),
        plain_text(payload).alias("plain"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    fields = F.concat(
        line("title", F.replace(F.col("plain_title"), F.lit("\n"), F.lit(" "))), line("language", F.col("language")),
        line("outlinks", F.col("links").cast("string")), line("conversion", F.col("conversion_id")),
        line("source-payload-digest", F.col("source_payload_digest")),
        line("source-block-digest", F.col("source_block_digest")),
        line("source-headers", F.regexp_replace("source_headers", r"\r?\n", " | ")))
    one = F.struct(F.lit("metadata").alias("type"), F.col("metadata_id").alias("record_id"),
                   F.lit("application/warc-fields").alias("content_type"), fields.alias("block"))
    two = F.struct(F.lit("conversion").alias("type"), F.col("conversion_id").alias("record_id"),
                   F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("plain").alias("block"))
    return known.select("*", F.explode(F.array(one, two)).alias("r")).select(
        key, F.col("r.type").alias("record_type"), F.col("r.record_id").alias("record_id"), "refers_to", "target_uri",
        "date", F.col("r.content_type").alias("content_type"), _bytes(F.col("r.block")).alias("content_length"),
        _digest(F.col("r.block")).alias("block_digest"), "source_headers", "source_payload_digest",
        F.col("r.block").alias("block"))


def serialised(records: DataFrame) -> DataFrame:
    """``value``: each record with its header, as files hold it, without the two line ends that close it."""
    header = F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in (
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        ("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to"), F.lit(">"))), ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("date")), ("WARC-Source-Payload-Digest", F.col("source_payload_digest")),
        ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")))])
    return records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), header, F.lit(CRLF), F.col("block")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC files, one per task, through Spark's text writer."""
    serialised(records).write.option("lineSep", CRLF + CRLF).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``headers, block`` of the records of WARC files; each file is read by one task, record by record."""
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data, at = content.as_buffer().to_pybytes(), 0
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at)
                    names = dict(x.split(": ", 1) for x in data[at:end].decode().split(CRLF)[1:])
                    size = int(names["Content-Length"])
                    block = data[end + 4:end + 4 + size]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([list(names.items())], pa.map_(pa.string(), pa.string())),
                         pa.array([block], pa.binary())], ["headers", "block"])
                    at = end + 4 + size + 4

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        parsed, "headers map<string,string>, block binary")


# The same in steps for SQL, with the character references that the given pages hold; the ampersand's own comes last.
_REFERENCES = (
    (r"&nbsp;|&#160;", " "), (r"&lt;|&#60;", "<"), (r"&gt;|&#62;", ">"), (r"&quot;|&#34;", '"'), (r"&apos;|&#39;", "'"),
    (r"&copy;|&#169;", "\u00a9"), (r"&middot;|&#183;", "\u00b7"), (r"&amp;|&#38;", "&"),
)
_BLANKS = ((r"[ \t\r\f\x0B]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", ""))


def _sql() -> str:
    def steps(text: str) -> str:
        for pattern, by in MARKS + _REFERENCES + _BLANKS:
            replacement = by.replace("'", "''").replace("\n", "' || chr(10) || '")
            text = f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', '{replacement}', 'g')"
        return text

    def uuid(text: str) -> str:
        parts = [f"substr(md5({text}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return "'urn:uuid:' || " + " || '-' || ".join(parts)

    end = "chr(13) || chr(10)"
    return f"""
WITH seen AS (
    SELECT CAST(page_id AS BIGINT) AS page_id,
           replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS target_uri, coalesce(html, '') AS payload,
           {uuid("'response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '')")} AS refers_to
    FROM pages
), headed AS (
    SELECT *, 'HTTP/1.1 200 OK' || {end} || 'Content-Type: text/html; charset=utf-8' || {end} || 'Content-Length: '
              || CAST(strlen(payload) AS VARCHAR) AS source_headers
    FROM seen
), known AS (
    SELECT *, 'sha256:' || sha256(payload) AS source_payload_digest,
           {uuid("'metadata|' || refers_to")} AS metadata_id, {uuid("'conversion|' || refers_to")} AS conversion_id,
           regexp_extract(payload, '(?is)<title[^>]*>([^<]*)', 1) AS title,
           regexp_extract(payload, '(?is)<html[^>]*\\blang="([^"]*)"', 1) AS language,
           len(regexp_extract_all(payload, '(?i)<a\\s[^>]*href=')) AS links, {steps("payload")} AS plain
    FROM headed
), records AS (
    SELECT *, 'metadata' AS record_type, metadata_id AS record_id, 'application/warc-fields' AS content_type,
           'title: ' || replace({steps("title")}, chr(10), ' ') || {end} || 'language: ' || language || {end}
           || 'outlinks: ' || CAST(links AS VARCHAR) || {end} || 'conversion: ' || conversion_id || {end}
           || 'source-payload-digest: ' || source_payload_digest || {end}
           || 'source-block-digest: sha256:' || sha256(source_headers || {end} || {end} || payload) || {end}
           || 'source-headers: ' || replace(source_headers, {end}, ' | ') || {end} AS block
    FROM known
    UNION ALL
    SELECT *, 'conversion', conversion_id, 'text/plain; charset=utf-8', plain FROM known
)
SELECT page_id, record_type, record_id, refers_to, target_uri, '{CAPTURED}' AS date, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, source_headers,
       source_payload_digest, block
FROM records
"""


SQL = _sql()
