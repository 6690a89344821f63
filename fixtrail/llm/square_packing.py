"""Best-fit packing (12): documents as token sequences of a fixed length, placed by sums of squares.

1. ``pieces``: every whole text becomes ids and an end id, longer documents are cut into pieces of a full
   sequence. Only lengths and checksums leave the Python workers. Words between ASCII blanks are looked up in a table of
   bounded size where the vocabulary drops blanks; new words of plain letters are encoded many in one call. Other
   vocabularies encode whole texts.
2. ``packed``: pieces are dealt in random shards of about 16,000. In a shard the state is the number of open sequences per
   residual gap. A piece goes where the sum of the squares of these numbers becomes smallest: into an open sequence of
   some gap, or into a new one. The last 30 % of a shard's pieces come longest first and open a new sequence only
   where no open one has room, so that few sequences are left open. Shards are packed side by side; each leaves less than a few open
   sequences' worth of room, whatever the input.

Defined results: a null text counts as empty and has the end id only; repeated rows are packed each; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import byte_sliced, drops_blanks, id_and_text

CAPACITY = 4096
SHARD = 1 << 14
TAIL = 0.3
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"
# Letters that are one code point in every normal form, and marks that may stand behind them; no contraction has these.
_LETTERS = "^[a-zà-öø-ÿß]+$"
_MARKS = ".,;:!?"


class WordIds:
    """Texts → ids by a ``.json`` vocabulary, through a table of words whose size is bounded.

    A word of letters with marks behind it is two units, any other word is one; a unit is encoded once.
    """

    def __init__(self, path: str, most: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.most = most
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cuts = drops_blanks(self.tokenizer)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        ends = [n for piece, n in self.tokenizer.get_vocab(False).items() if suffix and piece.endswith(suffix)]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(True), bool)
        self.ends[ends] = True
        alone = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        # Whether letters and the marks behind them are words of their own, whatever their case.
        self.plain = bool(ends) and self.cuts and alone("Äbc?!") == alone("äbc") + alone("?!")
        self.forget()

    def forget(self) -> None:
        # Unit 0 is empty.
        self.known: dict[str, int] = {"": 0}
        self.sizes, self.flat = np.zeros(1, np.int64), np.zeros(0, "<u4")

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end)."""
        if not self.cuts:
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([n for ids in found for n in ids], "<u4"), np.cumsum([len(ids) for ids in found])
        if len(self.known) > self.most:
            self.forget()
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        # Two units a word; the second may be the empty one.
        units = self.units(words.dictionary)[words.indices.to_numpy()].ravel()
        lengths = self.sizes[units]
        ends = np.cumsum(lengths)
        starts = np.cumsum(self.sizes) - self.sizes
        found = self.flat[np.repeat(starts[units] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        last = split.offsets.to_numpy()
        return found, np.concatenate([[0], ends])[2 * (last[1:] - last[0])]

    def units(self, words: pa.Array) -> np.ndarray:
        """Numbers of the two units of each word."""
        found = np.zeros((len(words), 2), np.int64)
        if not self.plain:
            found[:, 0] = self.numbers(words, False)
            return found
        bases = pc.utf8_lower(pc.utf8_rtrim(words, _MARKS))
        plain = pc.match_substring_regex(bases, _LETTERS).to_numpy(zero_copy_only=False)
        found[~plain, 0] = self.numbers(words.filter(pa.array(~plain)), False)
        its_bases = bases.filter(pa.array(plain)).dictionary_encode()
        found[plain, 0] = self.numbers(its_bases.dictionary, True)[its_bases.indices.to_numpy()]
        behind = pc.subtract(pc.utf8_length(words), pc.utf8_length(bases)).to_numpy()
        for count in np.unique(behind[plain]).tolist():
            if count:
                at = plain & (behind == count)
                marks = pc.utf8_slice_codeunits(words.filter(pa.array(at)), -count, None).dictionary_encode()
                found[at, 1] = self.numbers(marks.dictionary, False)[marks.indices.to_numpy()]
        return found

    def numbers(self, words: pa.Array, letters: bool) -> np.ndarray:
        """Unit number of each of different ``words``; new ones are encoded, many words of ``letters`` in one call."""
        listed = words.to_pylist()
        fresh = [w for w in listed if w not in self.known]
        if fresh:
            ids, sizes = self.together(fresh) if letters else self.alone(fresh)
            self.known.update(zip(fresh, range(len(self.sizes), len(self.sizes) + len(fresh))))
            self.flat, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.sizes, sizes])
        return np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))

    def alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([n for ids in found for n in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)

    def together(self, words: list[str], count: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """As ``alone``, for words of letters only: many in one text, told apart by their last pieces."""
        groups = [words[n:n + count] for n in range(0, len(words), count)]
        encoded = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        found = []
        for group, x in zip(groups, encoded):
            ids = np.array(x.ids, "<u4")
            sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            found.append((ids, sizes) if len(sizes) == len(group) else self.alone(group))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


_WORDS: dict[str, WordIds] = {}


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text", batch_bytes: int = 8 << 20) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of all pieces of at most ``capacity`` ids.

    ``vocabulary`` is a path that every executor can open. A Python worker keeps its table of words for its next
    tasks, which changes nothing but time.
    """
    def long_text(words: WordIds, text: str) -> np.ndarray:
        # In parts cut before a blank, where the vocabulary drops blanks.
        found, start = [], 0
        while start < len(text):
            cut = re.compile("[\x20\x09-\x0d]").search(text, start + batch_bytes) if words.cuts else None
            end = cut.start() if cut else len(text)
            found.append(words(pa.array([text[start:end]], pa.string()))[0])
            start = end
        return np.concatenate(found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _WORDS:
            _WORDS[vocabulary] = WordIds(vocabulary)
        words = _WORDS[vocabulary]
        last = np.array([end_id], "<u4").tobytes()
        for batch in byte_sliced(batches, "text", batch_bytes):
            texts = batch.column("text")
            if batch.num_rows == 1 and len(texts[0].as_py()) > batch_bytes:
                ids = long_text(words, texts[0].as_py())
                ends = [len(ids)]
            else:
                ids, ends = words(texts)
                ends = ends.tolist()
            rows: list[tuple] = []
            begin = 0
            for doc_id, end in zip(batch.column("doc_id").to_pylist(), ends):
                size = end - begin + 1
                for piece, start in enumerate(range(0, size, capacity)):
                    stop = min(start + capacity, size)
                    check = zlib.crc32(np.ascontiguousarray(ids[begin + start:begin + min(stop, size - 1)]))
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(last, check) if stop == size else check))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if n == 1 else pa.int64()) for n, c in enumerate(zip(*rows))],
                [part.split()[0] for part in PIECES.split(", ")])

    return id_and_text(docs, id_col, text_col).mapInArrow(cut, PIECES)


def place_by_squares(lengths: list[int], capacity: int, tail: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of pieces in their order; from number ``tail`` on, new sequences only where none has room."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    sequences, offsets, used = [], [], 0
    never = np.iinfo(np.int64).max
    for n, length in enumerate(lengths):
        # By the gap that remains: the change of the sum of squares. A full sequence is no longer counted.
        before = count[length:]
        change = 2 * count[:capacity - length + 1] + 1
        change[0] = 0
        change -= 2 * before - 1
        change[before == 0] = never
        fresh = 2 * int(count[capacity - length]) + 1 if length < capacity else 0
        left = int(change.argmin())
        found = int(change[left])
        if found == never or (n < tail and fresh < found):
            sequence, gap, left = used, capacity, capacity - length
            used += 1
        else:
            gap = left + length
            sequence = open_at[gap].pop()
            count[gap] -= 1
        if left:
            open_at[left].append(sequence)
            count[left] += 1
        sequences.append(sequence)
        offsets.append(capacity - gap)
    return sequences, offsets


def packed(cut: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``sequence_id`` and ``offset`` added to ``cut``, a stored table of pieces (``PIECES``)."""
    shards = max(1, round(cut.count() / shard))
    mixed = F.xxhash64(F.monotonically_increasing_id())
    dealt = cut.withColumn("mixed", mixed).withColumn("shard", F.expr(f"pmod(mixed, {shards}L)"))

    def place(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("mixed").to_numpy(), kind="stable")
        lengths = table.column("length").to_numpy()
        tail = len(order) - int(len(order) * TAIL)
        last = order[tail:]
        order[tail:] = last[np.argsort(-lengths[last], kind="stable")]
        table = table.take(pa.array(order))
        sequences, offsets = place_by_squares(lengths[order].tolist(), capacity, tail)
        first = table.column("shard")[0].as_py() << 32
        names = [part.split()[0] for part in PIECES.split(", ")]
        return table.select(names).append_column("sequence_id", pa.array([first + s for s in sequences], pa.int64())) \
            .append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("shard").applyInArrow(place, PACKED)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return packed(materialise(pieces(docs, vocabulary, capacity, end_id)), capacity)
