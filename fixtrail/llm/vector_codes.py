"""Vector code compression (11): product codes learnt and assigned through Hilbert-sorted flat blocks.

1. ``blocks``: vectors become integers and are gathered in chunks. Of a chunk and each part position the parts are sorted
   along a Hilbert curve and cut into flat blocks of 16, each with its least and greatest values (box) and its sums. The
   table is written once; all rounds read it, and nothing of it is shuffled.
2. ``round_sums``: of a block and an entry the box gives the least and the greatest possible distance. Entries whose least
   distance is beyond another's greatest cannot be nearest to any part of the block; the others are the block's
   shortlist, with all that may tie. A block with one entry left adds its stored sums; other blocks are compared with their
   shortlists by exact integer kernels, blocks of equal length together.
3. Sums and counts by part and entry, at most one row per task, entry and position, are added up by Spark; only the new
   codebooks (parts x entries x positions) come to the driver.
4. ``vector_codes``: the last codebooks assign all parts, and the chunk's stored places bring codes back to vectors.

Defined results: vectors that are null or hold a null or non-finite component are dropped; the first
vectors by (vec_id, components), null ids aside, give the codebooks, all of them where fewer are kept than entries are asked for.
A vector whose length is 0, no multiple of the number of parts or not that of the first vectors has a null code and
error and takes no part in the rounds (its label's errors are summed without it). Repeated rows are
coded each; a null id is coded too; extra columns are ignored; an empty table gives no rows. A component from 2**16 on
raises, as exact distances might leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# Vectors of a chunk, parts of a block.
CHUNK = 1 << 15
BLOCK = 16
# Distances that a kernel holds at a time.
ROOM = 1 << 21
# Components stay below this, so that squared distances of thousands of components fit 64 bits.
LARGEST = 1 << 16


def kept(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and all finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & finite)


def integers(rows: np.ndarray) -> np.ndarray:
    """Components as floor(256 · x)."""
    scaled = np.floor(rows.astype(np.float64) * 256)
    if scaled.size and np.abs(scaled).max() >= LARGEST * 256:
        raise ValueError("a component is too large for exact distances in 64 bits")
    return scaled.astype(np.int64)


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Order of integer ``points (n, d)`` along a Hilbert curve over their box (its first 62 dimensions)."""
    points = points[:, :62]
    n, d = points.shape
    bits = max(1, min(8, 62 // d))
    low = points.min(axis=0)
    reach = np.maximum(points.max(axis=0) - low, 1)
    x = [((points[:, i] - low[i]) * ((1 << bits) - 1) // reach[i]) for i in range(d)]
    for bit in range(bits - 1, 0, -1):
        on, rest = 1 << bit, (1 << bit) - 1
        for i in range(d):
            there = (x[i] & on) != 0
            swap = np.where(there, 0, (x[0] ^ x[i]) & rest)
            x[0] = x[0] ^ np.where(there, rest, swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    turned = np.zeros(n, np.int64)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where(x[d - 1] & (1 << bit), (1 << bit) - 1, 0)
    key = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | ((x[i] ^ turned) >> bit) & 1
    return np.argsort(key, kind="stable")


def blocks(vectors: DataFrame, parts: int, length: int, label: str) -> DataFrame:
    """Chunks of ``vectors (vec_id, label, vector)`` of ``length`` components, one row each.

    ``places`` gives, by part, the sorted order, ``values`` the sorted parts, ``lows``, ``highs`` and ``sums`` the
    blocks' boxes and sums; all are little-endian integers.
    """
    kind = dict(vectors.dtypes)[label]

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                take = min(CHUNK - sum(b.num_rows for b in held), batch.num_rows)
                held.append(batch.slice(0, take))
                batch = batch.slice(take)
                if sum(b.num_rows for b in held) == CHUNK:
                    yield laid_out(held)
                    held = []
        if held:
            yield laid_out(held)

    def laid_out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        chunk = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        rows = integers(chunk.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, length))
        n, width = len(rows), length // parts
        starts = np.arange(0, n, BLOCK)
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        for part in range(parts):
            points = rows[:, part * width:(part + 1) * width]
            order = hilbert_order(points)
            points = points[order]
            found = (order.astype("<u4"), points.astype("<i4"), np.minimum.reduceat(points, starts).astype("<i4"),
                     np.maximum.reduceat(points, starts).astype("<i4"), np.add.reduceat(points, starts).astype("<i8"))
            for column, value in zip(columns, found):
                column.append(value)
        lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), chunk.column(c)) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays(
            lists + [pa.array([np.stack(c).tobytes()], pa.binary()) for c in columns],
            ["vec_ids", "labels", "places", "values", "lows", "highs", "sums"])

    return vectors.mapInArrow(chunked, f"vec_ids array<bigint>, labels array<{kind}>, places binary, values binary, "
                                       "lows binary, highs binary, sums binary")


def shortlists(lows: np.ndarray, highs: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which of ``entries (k, d)`` may be nearest to a part of each block, ties included: (blocks, k)."""
    low, high, entry = lows[:, None, :].astype(np.int64), highs[:, None, :].astype(np.int64), entries[None]
    least = (np.maximum(np.maximum(low - entry, entry - high), 0) ** 2).sum(axis=2)
    greatest = (np.maximum(np.abs(entry - low), np.abs(high - entry)) ** 2).sum(axis=2)
    return least <= greatest.min(axis=1)[:, None]


def nearest(values: np.ndarray, listed: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Index of the nearest entry of each of ``values (n, d)``, ties to the lower index, by blocks and their shortlists."""
    count, (n, d) = len(listed), values.shape
    spread = max(abs(int(x)) for x in (values.min(), values.max(), entries.min(), entries.max()))
    kind = np.int32 if 4 * spread * spread * d < 1 << 31 else np.int64
    # The last block is filled up with its last part.
    full = np.concatenate([values, np.repeat(values[-1:], count * BLOCK - n, axis=0)]).reshape(count, BLOCK, d).astype(kind)
    entries = entries.astype(kind)
    sizes = listed.sum(axis=1)
    order = np.argsort(~listed, axis=1, kind="stable")
    codes = np.empty((count, BLOCK), np.int64)
    for size in np.unique(sizes).tolist():
        alike = np.flatnonzero(sizes == size)
        step = max(1, ROOM // (BLOCK * size))
        for start in range(0, len(alike), step):
            at = alike[start:start + step]
            candidates = order[at, :size]
            if size == 1:
                codes[at] = candidates
                continue
            near, distance = entries[candidates], np.zeros((len(at), BLOCK, size), kind)
            for i in range(d):
                away = full[at, :, i][:, :, None] - near[:, None, :, i]
                distance += away * away
            codes[at] = np.take_along_axis(candidates, distance.argmin(axis=2), axis=1)
    return codes.ravel()[:n]


def _read(row: dict, parts: int, width: int) -> tuple[np.ndarray, ...]:
    shaped = lambda name, kind, *last: np.frombuffer(row[name], kind).reshape(parts, -1, *last)
    return (shaped("places", "<u4"), shaped("values", "<i4", width), shaped("lows", "<i4", width),
            shaped("highs", "<i4", width), shaped("sums", "<i8", width))


def round_sums(table: DataFrame, books: np.ndarray) -> DataFrame:
    """``part, entry, position, total``: sums of the parts nearest to each entry; position -1 counts them."""
    parts, size, width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                _, values, lows, highs, sums = _read(row, parts, width)
                n = values.shape[1]
                lengths = np.minimum(BLOCK, n - np.arange(lows.shape[1]) * BLOCK)
                for part in range(parts):
                    listed = shortlists(lows[part], highs[part], books[part])
                    alone = listed.sum(axis=1) == 1
                    # Blocks with one entry left are added whole, without a look at their parts.
                    only = listed[alone].argmax(axis=1)
                    np.add.at(total[part, :, 0], only, lengths[alone])
                    np.add.at(total[part, :, 1:], only, sums[part][alone])
                    open_rows = np.repeat(~alone, lengths)
                    if not open_rows.any():
                        continue
                    rest = _open_values(values[part], open_rows)
                    codes = nearest(values[part], listed, books[part])[open_rows]
                    total[part, :, 0] += np.bincount(codes, minlength=size)
                    for i in range(width):
                        # Below 2**53, so the sums are exact.
                        total[part, :, i + 1] += np.bincount(codes, rest[:, i], size).astype(np.int64)
        part, entry, position = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(position - 1, pa.int32()),
             pa.array(total[part, entry, position])], ["part", "entry", "position", "total"])

    columns = ["places", "values", "lows", "highs", "sums"]
    return table.select(*columns).mapInArrow(summed, "part int, entry int, position int, total bigint") \
        .groupBy("part", "entry", "position").agg(F.sum("total").alias("total"))


def _open_values(values: np.ndarray, open_rows: np.ndarray) -> np.ndarray:
    return values[open_rows].astype(np.float64)


def moved(books: np.ndarray, rows: list) -> np.ndarray:
    """Entries replaced by the floored means of their parts; unused ones stay."""
    total = {(r.part, r.entry, r.position): r.total for r in rows}
    after = books.copy()
    for part, entry, position in np.ndindex(books.shape):
        count = total.get((part, entry, -1), 0)
        if count:
            after[part, entry, position] = total.get((part, entry, position), 0) // count
    return after


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


CODED = "vec_id bigint, label {}, code string, error bigint"


def assigned(table: DataFrame, books: np.ndarray, kind: str) -> DataFrame:
    """``vec_id, label, code, error`` of every vector of the chunks."""
    parts, _, width = books.shape

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.select(["places", "values", "lows", "highs", "sums"]).to_pylist()):
                places, values, lows, highs, _ = _read(row, parts, width)
                n = values.shape[1]
                codes, errors = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
                for part in range(parts):
                    found = nearest(values[part], shortlists(lows[part], highs[part], books[part]), books[part])
                    codes[places[part], part] = found
                    away = values[part].astype(np.int64) - books[part][found]
                    errors[places[part]] += (away * away).sum(axis=1)
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[at].values, batch.column("labels")[at].values,
                     pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                     pa.array(errors)], ["vec_id", "label", "code", "error"])

    return table.mapInArrow(coded, CODED.format(kind))


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector.

    ``code`` has two hex digits for each part, so ``entries`` is at most 256. The codebooks are bounded by
    ``entries`` vectors.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    rows = kept(vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                               F.col(vector_col).alias("vector")), "vector")
    kind = dict(rows.dtypes)["label"]
    usable = rows.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    least = usable.where("vec_id IS NOT NULL").orderBy("vec_id", "vector").limit(entries).collect()
    length = len(least[0].vector) if least else 0
    first = [r.vector for r in least if len(r.vector) == length]
    fits = F.size("vector") == length if length else F.lit(False)
    width = length // parts
    books = integers(np.array(first, np.float64).reshape(-1, length or parts)).reshape(len(first), parts, width or 1) \
        .transpose(1, 0, 2).copy()
    coded = rows.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                     F.lit(None).cast("bigint").alias("error"))
    if first:
        table = materialise(blocks(rows.where(fits), parts, length, "label"))
        for _ in range(rounds):
            books = moved(books, round_sums(table, books).collect())
        coded = assigned(table, books, kind).unionByName(coded)
    coded = materialise(coded)
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "its_label")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("its_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books) if first else digest(books[:, :0]))
        .alias("codebooks_sha256"))


def _sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    seen = "list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0"
    steps = [f"""
kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
    FROM embeddings WHERE embedding IS NOT NULL AND {seen}
), cut AS (
    SELECT place, label, vec_id, part,
           vector[CAST(part * len(vector) / {parts} AS INT) + 1:CAST((part + 1) * len(vector) / {parts} AS INT)] AS v
    FROM kept, (SELECT unnest(range({parts})) AS part)
), book0 AS (
    SELECT part, place - 1 AS entry, v AS e FROM cut WHERE place <= {entries}
)"""]
    near = """near{n} AS (
    SELECT place, part, any_value(v) AS v, min(struct_pack(d := d, entry := entry)) AS best
    FROM (SELECT c.place, c.part, c.v, b.entry,
                 list_sum(list_transform(list_zip(c.v, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
          FROM cut c JOIN book{n} b ON c.part = b.part)
    GROUP BY place, part
)"""
    for n in range(rounds):
        steps.append(near.format(n=n))
        steps.append(f"""means{n} AS (
    SELECT part, entry, list(mean ORDER BY i) AS e
    FROM (SELECT part, entry, i, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS mean
          FROM (SELECT part, best.entry AS entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{n})
          GROUP BY part, entry, i)
    GROUP BY part, entry
), book{n + 1} AS (
    SELECT b.part, b.entry, coalesce(m.e, b.e) AS e
    FROM book{n} b LEFT JOIN means{n} m ON b.part = m.part AND b.entry = m.entry
)""")
    steps.append(near.format(n=rounds))
    return "WITH " + ", ".join(steps) + f""", coded AS (
    SELECT k.vec_id, k.label, string_agg(printf('%02x', n.best.entry), '' ORDER BY n.part) AS code,
           CAST(sum(n.best.d) AS BIGINT) AS error
    FROM near{rounds} n JOIN kept k ON n.place = k.place GROUP BY k.place, k.vec_id, k.label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


SQL = _sql()
