"""Exact membership of keys decided in the row, by a cascade of bit filters.

The first filter holds the keys that are in; some that are out pass it by chance. The second holds those, and some that
are in pass it, and so on, until so few are left that they are listed. For the keys the cascade was made of the answer is exact:
a wide row is kept or dropped where it is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# Keys of a filter at most, bits per key and places of a key; a filter thus has at most 5 MB.
MOST = 1 << 22
BITS = 10
PLACES = 4
# Keys that are listed instead.
LISTED = 10_000


def _bits(keys: DataFrame, hashed: Column, size: int) -> np.ndarray:
    """The filter of ``keys``; tasks and the shuffle put bits together by words of 32."""
    places = F.explode(F.array(*[_place(hashed, n, size) for n in range(PLACES)]))
    words = keys.select(places.alias("place")).groupBy(F.expr("place div 32").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 32 as int))")).alias("bits"))
    found = words.toArrow()
    packed = np.zeros(size // 32, "<u4")
    packed[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return packed.view(np.uint8)


def _place(hashed: Column, n: int, size: int) -> Column:
    return F.pmod(hashed.bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(n) * F.shiftrightunsigned(hashed, 32), F.lit(size))


def _passing() -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    # Nested, so that it travels to the executors by value.
    def passes(hashes: np.ndarray, filtered: np.ndarray) -> np.ndarray:
        values, size = hashes.view(np.uint64), np.uint64(8 * len(filtered))
        found = np.ones(len(hashes), bool)
        for n in range(PLACES):
            place = ((values & np.uint64(0xFFFFFFFF)) + np.uint64(n) * (values >> np.uint64(32))) % size
            byte = filtered[(place >> np.uint64(3)).astype(np.int64)]
            found &= (byte >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    return passes


_passes = _passing()


def _in_filter(filtered: np.ndarray) -> Callable[[Column], Column]:
    @F.arrow_udf("boolean")
    def passes(hashes: pa.Array) -> pa.Array:
        return pa.array(_passes(hashes.to_numpy(zero_copy_only=False), filtered))

    return passes


def key_cascade(inside: DataFrame, outside: DataFrame, key: str, most: int = MOST,
                listed: int = LISTED) -> Callable[[Column], Column] | None:
    """key → whether it is among ``inside``, exact for keys of ``inside`` and ``outside`` (distinct, not null, apart).

    A null key is not inside. None where ``inside`` has more than ``most`` keys.
    """
    sides = [materialise(side.select(key)) for side in (inside, outside)]
    filters: list[np.ndarray] = []
    while True:
        held, other = sides
        count = held.count()
        if count > most:
            return None
        if count <= listed:
            break
        # The level goes into the hash, so that what passed one filter by chance passes the next one no more easily.
        hashed = F.xxhash64(F.lit(len(filters)), F.col(key))
        filters.append(_bits(held, hashed, -(-count * BITS // 32) * 32))
        passed = materialise(other.where(_in_filter(filters[-1])(hashed)))
        sides = [passed, held]
    rest = {row[0] for row in sides[0].collect()}

    @F.arrow_udf("boolean")
    def contained(keys: pa.Array, *hashes: pa.Array) -> pa.Array:
        # The last level is exact; each one before holds what passes its filter and is not of the next level.
        answer = np.array([k in rest for k in keys.to_pylist()], bool)
        for values, filtered in zip(reversed(hashes), reversed(filters)):
            answer = _passes(values.to_numpy(zero_copy_only=False), filtered) & ~answer
        return pa.array(answer)

    def found(column: Column) -> Column:
        hashes = [F.xxhash64(F.lit(n), column) for n in range(len(filters))]
        return F.coalesce(F.when(column.isNotNull(), contained(column, *hashes)), F.lit(False))

    return found
