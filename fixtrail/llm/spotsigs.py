"""Document fingerprints (1) by spot signatures.

A signature is a common word (the anchor) with the chain of content words that follow it; the set of a text's
signatures is its fingerprint. ``near_pairs`` finds all near documents: sets are partitioned by their size so that two near sets
stand in the same or in adjacent partitions, looked up by their rarest signatures, pruned by
size and compared. ``with_edits`` compares each text with an edited one and with its successor's.

``signature_sets``, and with it ``near_pairs``, gives a text of twelve words or more with two common words at most further
anchors, chosen by content: of every four successive words the one with the least hash. So likeness falls with the size of an edit in any
language, in code and in tables. ``with_edits`` returns that likeness beside the one of the fingerprints.

Defined results: a shorter text without common words has one signature of all its words, a text without words one of its
characters; an empty or null text has none. Two empty sets are alike (1.0), an empty and another are not (0.0). Repeated rows
stand next to one another in order of their text. A null id goes before all others. Extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_sliced, id_and_text, shuffle_partitions

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he in is it not of on or she that the they this to was we were which "
    "with you "
    "aber als am auf aus bei das dem den der des die ein eine einer es für hat ich im ist mit nicht sich sie sind so "
    "und von war wie wir zu zum zur "
    "au aux avec ce ces dans du elle est et il je la le les mais ne nous ou par pas pour que qui sa se sont sur un une "
    "vous "
    "al como con del ella ellas ellos el era esta este las lo los más muy no para pero por si sin su sus y yo"
).split()

CHAIN = 3
# Texts of fewer words have no anchors but common words, nor do texts with more common words than FEW.
SHORT, FEW = 12, 2
# Successive words of which one is an anchor by content.
NEAREST = 4
# Signatures have 40 bits: ten hexadecimal digits in a fingerprint.
BITS = 40

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(31), np.uint64(1), np.uint64(64 - BITS))
_LEAST = -(1 << 63)


class WordCodes(dict):
    """Word → 63 hash bits and, as lowest bit, whether it is an anchor; forgets all when it holds too many."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most, self.anchors = most, frozenset(w.encode() for w in ANCHORS)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        code = xxhash.xxh3_64_intdigest(word) & ~1 | (word in self.anchors)
        self[word] = code
        return code


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _MIX[2])) * _MIX[0]
    return (values ^ (values >> _MIX[2])) * _MIX[1]


def signatures(text: str, codes: WordCodes, chain: int = CHAIN, by_content: bool = False) -> np.ndarray:
    """Sorted distinct signatures; chains at the end of the text may be shorter, but hold one word at least.

    ``by_content`` adds anchors chosen by content where common words are too few.
    """
    return both_signatures(text, codes, chain)[by_content]


def both_signatures(text: str, codes: WordCodes, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """The signatures without and with anchors chosen by content."""
    words = _WORD.findall(text.encode().lower())
    coded = np.fromiter((codes[w] for w in words), np.uint64, len(words))
    anchor = (coded & _MIX[3]).astype(bool)
    content = np.concatenate([coded[~anchor], np.zeros(chain - 1, np.uint64)])
    at = np.flatnonzero(anchor)
    after = at - np.arange(len(at))
    own = after < len(content) - (chain - 1)
    sparse = len(words) >= SHORT and len(at) <= FEW
    at, after = at[own], after[own]
    found = np.unique(chains(coded[at], content, after, chain))
    more = np.union1d(found, chosen_by_content(coded, chain)) if sparse else None
    if not len(at) and text:
        whole = b" ".join(words) if words else b"\n" + text.encode()
        found = np.array([xxhash.xxh3_64_intdigest(whole) >> (64 - BITS)], np.uint64)
    return found, found if more is None else more


def chains(value: np.ndarray, content: np.ndarray, after: np.ndarray, chain: int) -> np.ndarray:
    """Signatures of anchors and the words from ``after`` on."""
    for k in range(chain):
        value = _mixed(value) + content[after + k]
    return _mixed(value) >> _MIX[4]


def chosen_by_content(coded: np.ndarray, chain: int) -> np.ndarray:
    """Signatures of the words with the least hash of ``NEAREST`` successive ones, with the words that follow."""
    windows = np.lib.stride_tricks.sliding_window_view(_mixed(coded), NEAREST)
    at = np.unique(np.arange(len(windows)) + windows.argmin(axis=1))
    return chains(coded[at], np.concatenate([coded, np.zeros(chain, np.uint64)]), at + 1, chain)


def to_text(values: np.ndarray) -> str:
    """The fingerprint: the signatures in order, ten digits each."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard likeness; 0.0 without a comparison where the sizes alone keep it below ``floor``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < floor * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def size_partition(size: int, threshold: float) -> int:
    """Number of the length partition; sizes whose ratio reaches the threshold are at most one apart."""
    return int(math.log(size) / (math.log(1 / threshold) + 1e-9)) if size > 0 else -1


def with_edits(docs: DataFrame, threshold: float = 0.8, floor: float = 0.0) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    ``near_…_by_content`` differ where a text has hardly any common words. The edited text has, in place of the last quarter of its code points, the first as many of the next document by
    id (the first one after the last). Documents are dealt by ranges of ids, whole texts once; the first document of
    each range also goes to the range before it.
    """
    docs = id_and_text(docs).select("doc_id", "text", F.coalesce("doc_id", F.lit(_LEAST)).alias("key"))
    ranges = shuffle_partitions(docs.sparkSession)
    shares = [n / ranges for n in range(1, ranges)] or [0.5]
    # One bound per range comes to the driver. Bounds are ids of the table, so each is the first of its range.
    least, cuts = docs.agg(F.min("key"), F.percentile_approx("key", shares, max(10_000, 20 * ranges))).first()
    bounds = np.array(sorted({x for x in (cuts or []) if x > least})[:ranges - 1], np.int64)
    firsts = np.concatenate([[least or 0], bounds]).astype(np.int64)
    count = len(firsts)

    @F.arrow_udf("array<int>")
    def places(keys: pa.Array) -> pa.Array:
        values = keys.to_numpy(zero_copy_only=False)
        own = np.searchsorted(bounds, values, "right")
        guest = values == firsts[own]
        return pa.array([[2 * o, 2 * ((o - 1) % count) + 1] if g else [2 * o] for o, g in zip(own.tolist(), guest)],
                        pa.list_(pa.int32()))

    # Even numbers: a range's own rows; odd ones: the row after them, in the same partition.
    dealt = (
        docs.select("*", F.explode(places("key")).alias("place"))
        .repartitionById(count, F.expr("place div 2").cast("int"))
        .sortWithinPartitions("place", "key", "text").select("doc_id", "text", "place")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        held = None
        for batch in byte_sliced(batches, "text", 2 << 20):
            rows = []
            for doc_id, text, place in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "place"))):
                if held is not None and held[2] % 2 == 1:
                    break  # more rows with the id of the row after: only the first counts
                now = (doc_id, text, place, *both_signatures(text, codes))
                if held is not None:
                    rows.append(_edited(held, now, codes, threshold, floor))
                held = now
            if rows:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=_NAMES), schema=_SCHEMA,
                                                 preserve_index=False)

    return dealt.mapInArrow(compared, RESULT_SCHEMA)


RESULT_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures bigint, size_partition int, near_edited_by_content double, "
    "near_next_by_content double"
)
_NAMES = [part.split()[0] for part in RESULT_SCHEMA.split(", ")]
_SCHEMA = pa.schema(list(zip(_NAMES, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                                      pa.float64(), pa.int64(), pa.int32(), pa.float64(), pa.float64()])))


def _edited(row: tuple, after: tuple, codes: WordCodes, threshold: float, floor: float) -> tuple:
    doc_id, text, _, own, own_by_content = row
    cut = len(text) // 4
    edited = text[:len(text) - cut] + after[1][:cut]
    other, other_by_content = (own, own_by_content) if edited == text else both_signatures(edited, codes)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(own), to_text(other),
            likeness(own, other, floor), likeness(own, after[3], floor), len(own), size_partition(len(own), threshold),
            likeness(own_by_content, other_by_content, floor), likeness(own_by_content, after[4], floor))


def signature_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, signatures`` (sorted array of bigint) of each text, by content where common words are too few."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in byte_sliced(batches, "text", 4 << 20):
            found = [signatures(text, codes, by_content=True).astype(np.int64) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))],
                                             ["doc_id", "signatures"])

    return id_and_text(docs).mapInArrow(sets, "doc_id bigint, signatures array<bigint>")


def near_pairs(sets: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): ``doc_id, class_id`` of each document, and ``left_id, right_id, likeness`` between classes.

    Equal sets are one class, named by its least id. Only pairs between different sets are listed.
    """
    classes = sets.groupBy("signatures").agg(F.min("doc_id").alias("class_id"), F.size("signatures").alias("n"))
    members = sets.join(classes, "signatures").select("doc_id", "class_id")
    classes = classes.where("n > 0")
    width = math.log(1 / threshold) + 1e-9
    listed = classes.select("class_id", "n", F.explode("signatures").alias("signature"))
    rarity = listed.groupBy("signature").agg(F.count("*").alias("times"))
    # The window holds the signatures of one text.
    rank = F.row_number().over(Window.partitionBy("class_id").orderBy("times", "signature"))
    index = (
        listed.join(rarity.where("times > 1"), "signature", "left").fillna(1, ["times"])
        .withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        .where("times > 1").select("signature", "class_id", "n", F.floor(F.log("n") / width).alias("part"))
    )
    right = index.select("signature", F.col("class_id").alias("right_id"), F.col("n").alias("right_n"),
                         F.col("part").alias("right_part"),
                         F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"))
    left = index.select("signature", "part", F.col("class_id").alias("left_id"), F.col("n").alias("left_n"))
    pairs = (
        left.join(right, ["signature", "part"])
        .where((F.col("part") != F.col("right_part")) | (F.col("left_id") < F.col("right_id")))
        .where(F.least("left_n", "right_n") >= F.greatest("left_n", "right_n") * F.lit(threshold) - 1e-9)
        .select("left_id", "right_id").distinct()
    )
    named = classes.select("class_id", "signatures")
    both = (
        pairs.join(named.toDF("left_id", "left"), "left_id").join(named.toDF("right_id", "right"), "right_id")
        .withColumn("common", F.size(F.array_intersect("left", "right")))
        .withColumn("likeness", F.col("common") / (F.size("left") + F.size("right") - F.col("common")))
        .where(F.col("likeness") >= threshold)
    )
    return members, both.select(F.least("left_id", "right_id").alias("left_id"),
                                F.greatest("left_id", "right_id").alias("right_id"), "likeness")
