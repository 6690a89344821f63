"""BPE encoding and decoding (9) through a table of distinct words.

1. ``split``: texts are split into words in blocks of some MB. A block is one row: its
   documents, its distinct words and, per document, the numbers of its words in order.
2. ``encode_runs``: the distinct words of all blocks meet by word; each is encoded once.
3. ``decode_by_join``: each is decoded once, through a join of its ids with the vocabulary's pieces.
4. ``encode_decode``: ids and pieces come back to the blocks by (block, number) and stand in for
   the words by position.

A word is a run of characters between places where the vocabulary's own splitter
always cuts: at white space (one blank stays with what follows) and between a
letter and an ASCII mark. It holds one or several of the splitter's words
whole, so ids of words, one after another, are the ids of the text. A very frequent
word is one row per block. Words, not texts, are shuffled; of the texts only the compressed
numbers move.

Defined results: a null text counts as empty (no ids, both digests those of the empty string);
repeated rows give repeated results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_sliced, id_and_text

BLOCK_SCHEMA = (
    "block bigint, doc_ids array<bigint>, lengths array<int>, numbers binary, n_words int, words array<string>"
)
RESULT_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

# Unicode's white space, and the Latin letters that every Unicode version calls letters.
_SPACE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARK = r"!-/:-@\[-`{-~"
_WORD = re.compile(
    f" ?[{_LETTER}]+(?=[{_SPACE}{_MARK}]|\\Z)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")


def text_words(text: str, special: str | None) -> list[str]:
    """The words of a text in order; joined they are the text. ``special`` is always a word of its own."""
    if special is None or special not in text:
        return _WORD.findall(text)
    found: list[str] = []
    for at, part in enumerate(text.split(special)):
        if at:
            found.append(special)
        found += _WORD.findall(part)
    return found


def special_of(path: str) -> str | None:
    """The one special string of a vocabulary file."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if len(added) > 1 or any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
        raise ValueError("only vocabularies with at most one plain special string are supported")
    return added[0]["content"] if added else None


class Numbers(dict):
    """word → its number, in the order in which words are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def split(docs: DataFrame, vocabulary: str, block_bytes: int, words: bool) -> DataFrame:
    """Blocks of documents; with ``words`` their distinct words, without them the numbers of words.

    Both kinds come from the same rows, so that a block has the same key in either; the key also holds a
    hash of the words, so blocks read in another order can never be taken for one another.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, part = special_of(vocabulary), TaskContext.get().partitionId()
        ids: list[int | None] = []
        coded: list[np.ndarray] = []
        known = Numbers()
        room = made = 0
        for batch in byte_sliced(batches, "text", 1 << 20):
            ids += batch.column("doc_id").to_pylist()
            for text in batch.column("text").to_pylist():
                found = text_words(text, special)
                coded.append(np.fromiter(map(known.__getitem__, found), np.uint32, len(found)))
                room += len(text)
            if room >= block_bytes:
                yield _block(ids, coded, known, (part, made), words)
                ids, coded, known, room, made = [], [], Numbers(), 0, made + 1
        if ids:
            yield _block(ids, coded, known, (part, made), words)

    return id_and_text(docs).mapInArrow(blocks, BLOCK_SCHEMA)


def _block(ids: list, coded: list[np.ndarray], known: dict[str, int], place: tuple, words: bool) -> pa.RecordBatch:
    """The row of a block. Words are numbered by how often the block has them, so that most numbers are small."""
    flat = np.concatenate(coded) if coded else np.zeros(0, np.uint32)
    ranked = np.argsort(-np.bincount(flat, minlength=len(known)), kind="stable")
    found = list(known)
    found = [found[n] for n in ranked.tolist()]
    key = xxhash.xxh3_64_intdigest("\x00".join([repr(place), *found]).encode()) - (1 << 63)
    numbers = lengths = None
    if not words:
        number = np.empty(len(ranked), np.uint32)
        number[ranked] = np.arange(len(ranked))
        # Low bytes, then middle ones, then high ones: runs of like values compress.
        numbers = _packed(number[flat].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
        lengths = [len(x) for x in coded]
    return pa.RecordBatch.from_arrays([
        pa.array([key], pa.int64()), pa.array([None if words else ids], pa.list_(pa.int64())),
        pa.array([lengths], pa.list_(pa.int32())), pa.array([numbers], pa.binary()), pa.array([len(found)], pa.int32()),
        pa.array([found if words else None], pa.list_(pa.string()))],
        ["block", "doc_ids", "lengths", "numbers", "n_words", "words"])


def _packed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def piece_table(spark: SparkSession, vocabulary: str) -> DataFrame:
    """``id, piece``: the bytes that each id of the vocabulary stands for (its size bounds the table)."""
    with open(vocabulary, encoding="utf-8") as file:
        data = json.load(file)
    # The byte alphabet of such vocabularies: printable Latin-1 stands for itself, the other bytes, in order, for
    # the characters from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}
    special = {x["id"]: x["content"] for x in data["added_tokens"]}
    rows = [(n, bytearray(byte_of[c] for c in piece)) for piece, n in data["model"]["vocab"].items() if n not in special]
    rows += [(n, bytearray(text.encode())) for n, text in special.items()]
    return spark.createDataFrame(pd.DataFrame({"id": [n for n, _ in rows], "piece": [bytes(p) for _, p in rows]}),
                                 "id int, piece binary")


def encode_runs(places: DataFrame, vocabulary: str) -> DataFrame:
    """``ids, blocks, numbers`` of each distinct word of ``places (word, block, number)``.

    Rows come sorted by word, so a word's rows follow one another and it is encoded once. Its places are lists of at
    most a batch's length; a word with more has several rows with the same ids.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        last, last_ids = None, None
        for batch in batches:
            words = batch.column("word").to_pylist()
            starts = [n for n in range(len(words)) if n == 0 or words[n] != words[n - 1]]
            distinct = [words[n] for n in starts]
            again = bool(distinct) and distinct[0] == last
            ids = [x.ids for x in tokenizer.encode_batch_fast(distinct[again:], add_special_tokens=False)]
            ids = [last_ids] * again + ids
            if ids:
                last, last_ids = distinct[-1], ids[-1]
            offsets = pa.array([*starts, len(words)], pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.list_(pa.int32())), pa.ListArray.from_arrays(offsets, batch.column("block")),
                pa.ListArray.from_arrays(offsets, batch.column("number"))], ["ids", "blocks", "numbers"])

    return places.repartition("word").sortWithinPartitions("word").mapInArrow(
        encode, "ids array<int>, blocks array<bigint>, numbers array<int>")


def decode_by_join(encoded: DataFrame, vocabulary: str, room: int = 300_000) -> DataFrame:
    """``block, numbers, ids, pieces, sizes``: what encoding and decoding gives for words of a block, packed.

    One row per id meets the table of pieces in a broadcast join (the vocabulary's size bounds it). Neither
    step moves or reorders rows, so a word's pieces follow one another and are put together without a shuffle; each
    row carries how many there are, and a gap raises. About ``room`` places at a time are gathered by block, so that a
    block gets few rows from each task. ``ids`` are decimal numbers joined by commas, ``pieces`` the decoded bytes.
    """
    first = F.col("at") == 0
    parts = (
        encoded.select(F.size("ids").alias("wanted"), "blocks", "numbers", F.posexplode_outer("ids").alias("at", "id"))
        .join(F.broadcast(piece_table(encoded.sparkSession, vocabulary)), "id", "left")
        .select("at", "id", "piece", "wanted", F.when(first, F.col("blocks")).alias("blocks"),
                F.when(first, F.col("numbers")).alias("numbers"))
    )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_block: dict[int, tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
        ids: list[str] = []
        pieces: list[bytes] = []
        blocks = numbers = None
        held = 0
        for batch in batches:
            row = zip(*(batch.column(c).to_pylist() for c in ("at", "id", "piece", "wanted", "blocks", "numbers")))
            for at, number, piece, wanted, its_blocks, its_numbers in row:
                if at != len(ids):
                    raise ValueError("the pieces of a word came out of order")
                if at == 0:
                    blocks, numbers = its_blocks, its_numbers
                ids.append(str(number))
                pieces.append(piece)
                if at + 1 == wanted:
                    joined, decoded = ",".join(ids), b"".join(pieces)
                    for block, place in zip(blocks, numbers):
                        for column, value in zip(by_block[block], (place, joined, decoded)):
                            column.append(value)
                    held += len(blocks)
                    ids, pieces = [], []
            if held >= room:
                yield _gathered(by_block)
                by_block.clear()
                held = 0
        if ids:
            raise ValueError("the pieces of a word are not whole")
        yield _gathered(by_block)

    return parts.mapInArrow(together, "block bigint, numbers binary, ids binary, pieces binary, sizes binary")


def _gathered(by_block: dict[int, tuple[list, list, list]]) -> pa.RecordBatch:
    rows = [(block, _packed(np.array(numbers, "<u4").tobytes()), _packed(" ".join(ids).encode()),
             _packed(b"".join(pieces)), _packed(np.array([len(p) for p in pieces], "<u4").tobytes()))
            for block, (numbers, ids, pieces) in by_block.items()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, [pa.int64()] + [pa.binary()] * 4)],
        ["block", "numbers", "ids", "pieces", "sizes"])


def encode_decode(docs: DataFrame, vocabulary: str, block_bytes: int = 32 << 20) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row."""
    places = (
        split(docs, vocabulary, block_bytes, words=True)
        .select("block", F.posexplode("words").alias("number", "word"))
    )
    known = decode_by_join(encode_runs(places, vocabulary), vocabulary)
    blocks = split(docs, vocabulary, block_bytes, words=False).drop("words")

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        count = left.column("n_words")[0].as_py() if left.num_rows else 0
        joined_ids: list = [None] * count
        pieces: list = [None] * count
        for row in right.to_pylist():
            starts = [0, *np.cumsum(np.frombuffer(_unpacked(row["sizes"]), "<u4"), dtype=np.int64).tolist()]
            raw = _unpacked(row["pieces"])
            listed = zip(np.frombuffer(_unpacked(row["numbers"]), "<u4").tolist(), _unpacked(row["ids"]).split(b" "))
            for at, (number, its_ids) in enumerate(listed):
                joined_ids[number], pieces[number] = its_ids, raw[starts[at]:starts[at + 1]]
        if left.num_rows != 1 or None in joined_ids:
            raise ValueError("the words of a block were read differently the second time")
        sizes = np.fromiter((x.count(b",") + 1 for x in joined_ids), np.int64, count)
        planes = np.frombuffer(_unpacked(left.column("numbers")[0].as_py()), np.uint8)
        flat = planes.reshape(4, -1).T.copy().view("<u4").ravel()
        rows, start = [], 0
        for doc_id, length in zip(left.column("doc_ids")[0].as_py(), left.column("lengths")[0].as_py()):
            part = flat[start:start + length]
            start += length
            listed = part.tolist()
            rows.append((doc_id, int(sizes[part].sum()),
                         hashlib.sha256(b",".join([joined_ids[n] for n in listed])).hexdigest(),
                         hashlib.sha256(_text(b"".join([pieces[n] for n in listed]))).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.table({part.split()[0]: pa.array(c, k)
                         for part, c, k in zip(RESULT_SCHEMA.split(", "), zip(*rows), kinds)})

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(joined, RESULT_SCHEMA)


def _text(raw: bytes) -> bytes:
    """The bytes as a decoder gives them: what is not UTF-8 is replaced."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()
    return raw
