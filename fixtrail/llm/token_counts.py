"""Token counts (3): batch encoding in Arrow functions that return lengths only.

Every text goes whole through the tokenizer of a vocabulary file. Batches are
balanced by bytes, not rows, so that a run of long texts does not fill a worker's
memory. Texts are cut where no token can span the cut: at runs of ASCII blanks, which the vocabulary drops. Each batch
encodes its distinct pieces once, and short pieces seen before keep their length in a table of bounded size. Only counts
leave the Python workers; nothing is shuffled.

Defined results: a null text counts as empty and has 0 tokens; repeated rows give
repeated results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import byte_sliced, id_and_text

# Longer pieces than this many bytes are measured again in each batch.
LONGEST_REMEMBERED = 64
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

def hub_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Lengths by a ``.json`` vocabulary, without added special tokens, truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    return lambda texts: [len(x) for x in encode(texts, add_special_tokens=False)]


def piece_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Lengths by a ``.model`` vocabulary. Its normaliser looks across blanks, so its texts are never cut."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = 1 << 20, remembered: int = 300_000) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; ``over_limit`` is ``n_tokens > limit``.

    ``vocabulary`` is a path that every executor can open. ``batch_bytes`` bounds
    what one call of the tokenizer gets (a longer piece goes alone), ``remembered`` how many pieces a task keeps
    the lengths of; it changes nothing but time.
    """
    cut = not vocabulary.endswith(".model")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = hub_counter(vocabulary) if cut else piece_counter(vocabulary)
        known: dict[bytes, int] = {}
        for batch in byte_sliced(batches, "text", batch_bytes):
            if cut:
                pieces = [text.encode().split() for text in batch.column("text").to_pylist()]
                fresh = _measured(set().union(*pieces) - known.keys(), counter, batch_bytes)
                known.update(fresh)
                counts = np.array([sum(map(known.__getitem__, words)) for words in pieces], np.int64)
                for word in fresh:
                    if len(word) > LONGEST_REMEMBERED:
                        del known[word]
                if len(known) > remembered:
                    known = {}
            else:
                counts = np.array(counter(batch.column("text").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pc.binary_length(batch.column("text")).cast(pa.int64()),
                pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(lengths, SCHEMA)


def _measured(pieces: set[bytes], counter: Callable[[list[str]], list[int]], batch_bytes: int) -> dict[bytes, int]:
    """Length of each piece; each call of the tokenizer gets about ``batch_bytes``."""
    found: dict[bytes, int] = {}
    held: list[bytes] = []
    room = 0
    for piece in pieces:
        held.append(piece)
        room += len(piece)
        if room >= batch_bytes:
            found.update(zip(held, counter([p.decode() for p in held])))
            held, room = [], 0
    found.update(zip(held, counter([p.decode() for p in held])))
    return found
