"""Ranked lexical search (13): each item's best documents, scored once per class of equal bags.

1. ``bags``: of every whole text, the number of its terms and how often each term of the items' vocabulary occurs in it.
   What else a document holds cannot change a score but through its length.
2. ``statistics``: documents, terms and document frequencies, counted per task and added up.
3. ``classes``: documents with the same bag and the same length factor ``m`` score alike. They meet by a hash of both, and
   bag and factor themselves are keys too, so a hash shared by chance joins nothing. Of a class the k least ids are kept, as no more of it can be
   listed; each task keeps its own k before the shuffle, so a class with a third of all rows stays small.
4. ``best``: each class is scored once, for all items, through the items' postings; a task keeps k documents
   per item, and the last ranking sees k rows per task and item.

Items come in blocks of a bounded number of items and terms, so what is sent to tasks is bounded too.

Defined results: a null or empty text holds no term, is no document of the statistics and is never listed; an item without terms
has no rows; rows that repeat an id are documents (or items) of their own; null ids come last among equal scores; extra
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import byte_sliced, id_and_text

# Items and terms of a block at most (one item's terms may exceed it).
ITEMS = 2_000
TERMS = 200_000
# Postings and scores that are held at a time.
ROOM = 1 << 21
# Digits, letters and all bytes of other characters are parts of terms; capitals count as small letters.
_KEEP = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))
RESULT = "number int, item_id bigint, score bigint, doc_id bigint"


def terms(text: str) -> list[bytes]:
    """The terms of a text in order."""
    return text.encode().translate(_KEEP).split()


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Blocks of (item_id, its terms with counts); the driver holds one block at a time."""
    block: list[tuple[int | None, Counter]] = []
    held = 0
    for row in items.toLocalIterator():
        counts = Counter(terms(row.text))
        if block and (len(block) == ITEMS or held + len(counts) > TERMS):
            yield block
            block, held = [], 0
        block.append((row.doc_id, counts))
        held += len(counts)
    if block:
        yield block


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag`` of each document with terms: the bag has (number, count) of each vocabulary term, by number."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def restricted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in byte_sliced(batches, "text", 4 << 20):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = terms(text)
                if found:
                    counts = Counter(map(known.get, found))
                    counts.pop(None, None)
                    rows.append((doc_id, len(found), np.array(sorted(counts.items()), "<i4").tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))],
                    ["doc_id", "n", "bag"])

    return id_and_text(docs).mapInArrow(restricted, "doc_id bigint, n bigint, bag binary")


def statistics(found: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms of all, documents that hold each of the ``size`` vocabulary terms)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            documents += batch.num_rows
            total += int(batch.column("n").to_numpy().sum())
            flat = np.frombuffer(b"".join(batch.column("bag").to_pylist()), "<i4").reshape(-1, 2)
            held += np.bincount(flat[:, 0], minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *at.tolist()], pa.int32()), pa.array([documents, total, *held[at].tolist()], pa.int64())],
            ["term", "counted"])

    rows = found.select("n", "bag").mapInArrow(counted, "term int, counted bigint").groupBy("term") \
        .agg(F.sum("counted").alias("counted")).collect()
    known = {r.term: r.counted for r in rows}
    return known.get(-1, 0), known.get(-2, 0), np.array([known.get(n, 0) for n in range(size)], np.int64)


def classes(found: DataFrame, documents: int, total: int, k: int) -> DataFrame:
    """``m, bag, members``: each class once, with its k least ids in order."""
    key = ["h", "m", "bag"]
    placed = found.where(F.length("bag") > 0).select(
        "doc_id", F.expr(f"100 - 75 + (75L * n * {documents}L) div {max(total, 1)}L").alias("m"), "bag") \
        .withColumn("h", F.xxhash64("bag", "m"))
    least = Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id"))
    return (
        placed.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k)
        .groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "doc_id"))).alias("members"))
        .select("m", "bag", F.transform("members", lambda x: x.doc_id).alias("members"))
    )


def weights(documents: int, frequencies: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * frequencies + 1))).astype(np.int64)


def best(found: DataFrame, block: list[tuple[int | None, Counter]], vocabulary: dict[bytes, int], weight: np.ndarray,
         k: int) -> DataFrame:
    """``number, item_id, score, doc_id``: the k best documents of each item of the block, per task."""
    number = np.concatenate([np.full(len(c), n, np.int64) for n, (_, c) in enumerate(block)])
    term = np.array([vocabulary[t] for _, c in block for t in c], np.int64)
    repeats = np.array([r for _, c in block for r in c.values()], np.int64)
    order = np.argsort(term, kind="stable")
    first = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
    most = max(sum(r * int(weight[vocabulary[t]]) for t, r in c.items()) for _, c in block) * 1_000_000
    held = found.sparkSession.sparkContext.broadcast(
        (number[order], repeats[order], first, weight, [item for item, _ in block], most < 1 << 53))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, repeat, first, weight, item_ids, exact = held.value
        count = len(item_ids)
        top: list[list[tuple]] = [[] for _ in range(count)]
        floor, floor_id = np.zeros(count, np.int64), np.full(count, np.iinfo(np.int64).max)
        for batch in batches:
            packed = batch.column("bag").to_pylist()
            flat = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2).astype(np.int64)
            ends = np.cumsum([len(b) >> 3 for b in packed])
            m = np.repeat(batch.column("m").to_numpy(), np.diff(ends, prepend=0))
            part = weight[flat[:, 0]] * ((1_000_000_000 * flat[:, 1]) // (1000 * flat[:, 1] + 8 * m))
            lengths = first[flat[:, 0] + 1] - first[flat[:, 0]]
            work = np.cumsum(lengths)[ends - 1]
            members = batch.column("members").to_pylist()
            start = 0
            while start < len(packed):
                done = work[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(work, done + ROOM, "right")))
                stop = min(stop, start + max(1, ROOM // count))
                scores = _scores(part, lengths, flat[:, 0], (ends[start - 1] if start else 0), ends[start:stop], items,
                                 repeat, first, count, exact)
                _keep(top, floor, floor_id, scores, members[start:stop], k)
                start = stop
        rows = [(n, item_ids[n], -minus, doc_id) for n, listed in enumerate(top) for minus, _, doc_id, _ in listed]
        if rows:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                             [part.split()[0] for part in RESULT.split(", ")])

    return found.mapInArrow(ranked, RESULT)


def _scores(part: np.ndarray, lengths: np.ndarray, term: np.ndarray, begin: int, ends: np.ndarray, items: np.ndarray,
            repeat: np.ndarray, first: np.ndarray, count: int, exact: bool) -> np.ndarray:
    """Scores (class, item) of the classes whose entries end at ``ends``."""
    end = int(ends[-1])
    size = lengths[begin:end]
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=begin))
    before = np.cumsum(size) - size
    post = np.repeat(first[term[begin:end]] - before, size) + np.arange(int(size.sum()))
    place = np.repeat(row * count, size) + items[post]
    amount = np.repeat(part[begin:end], size) * repeat[post]
    if exact:
        # All sums stay below 2**53.
        scores = np.bincount(place, amount, len(ends) * count).astype(np.int64)
    else:
        scores = np.zeros(len(ends) * count, np.int64)
        np.add.at(scores, place, amount)
    return scores.reshape(len(ends), count)


def _keep(top: list[list[tuple]], floor: np.ndarray, floor_id: np.ndarray, scores: np.ndarray, members: list[list],
          k: int) -> None:
    """Merge a slice of classes into each item's k best; ``floor`` has the k-th best score, ``floor_id`` its id."""
    ids = np.array([x[0] if x[0] is not None else np.iinfo(np.int64).max for x in members])
    wanted = (scores > floor) | ((scores == floor) & (scores > 0) & (ids[:, None] < floor_id))
    if len(scores) > k:
        # Every class has a document, so less than the k-th best class cannot be listed.
        wanted &= scores >= np.partition(scores, len(scores) - k, axis=0)[len(scores) - k]
    by_item = np.nonzero(wanted.T)
    for n, at in zip(*(x.tolist() for x in by_item)):
        minus = -int(scores[at, n])
        listed = top[n]
        fresh = [(minus, doc_id is None, doc_id, rank) for rank, doc_id in enumerate(members[at])]
        if len(listed) + len(fresh) > 16 * k:
            listed = heapq.nsmallest(k, listed, key=_order)
        listed += fresh
        top[n] = listed
    for n in set(by_item[0].tolist()):
        top[n] = heapq.nsmallest(k, top[n], key=_order)
        if len(top[n]) == k:
            floor[n] = -top[n][-1][0]
            floor_id[n] = np.iinfo(np.int64).max if top[n][-1][1] else top[n][-1][2]


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] or 0


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each row of ``items``, best first."""
    spark, results = docs.sparkSession, []
    for block in item_blocks(id_and_text(items, item_col, text_col)):
        vocabulary = {t: n for n, t in enumerate(sorted({t for _, c in block for t in c}))}
        if not vocabulary:
            continue
        found = materialise(bags(docs, vocabulary))
        documents, total, frequencies = statistics(found, len(vocabulary))
        rows = best(classes(found, documents, total, k), block, vocabulary, weights(documents, frequencies), k)
        rank = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        rows = rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
        results.append(materialise(rows.select("item_id", "rank", "doc_id", "score")))
    if not results:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH item_terms AS (
    SELECT item_id, term, count(*) AS repeats
    FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), texts AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents
), sizes AS (
    SELECT doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0
), corpus AS (
    SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sizes
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM texts)
    WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM counts, corpus GROUP BY term, documents
), scored AS (
    SELECT i.item_id, c.doc_id, CAST(sum(i.repeats * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (
        100 - 75 + (75 * s.n * documents) // total)))) AS BIGINT) AS score
    FROM item_terms i JOIN counts c ON i.term = c.term JOIN weights w ON w.term = i.term
         JOIN sizes s ON s.doc_id = c.doc_id, corpus
    GROUP BY i.item_id, c.doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
