"""Running totals and row numbers over a total order, without a single-task window.

A window without partitions, or one whose partition key holds a large part of
the rows, sorts all of that in one task. Here the rows are range partitioned by
(group, order), so a large group spreads over many partitions; every partition
sums up on its own and then adds what the group had in the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .session import materialise

PART = "_part"


def running_total(df: DataFrame, order: Sequence[Column | str], name: str,
                  group: Sequence[str] = (), weight: Column | str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``weight`` (a bigint) over this row and all before it in its group.

    ``order`` must be total within a group, else ties fall in any order. With
    ``weight`` unset every row counts 1, which makes ``name`` a row number.
    """
    keys = list(group)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    amount = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    # Without a number of partitions small neighbours are merged, which keeps their order.
    ranged = df.withColumn("_amount", amount.cast("bigint")).repartitionByRange(*keys, *order)
    # A plain row number is the row's place in its sorted partition; other totals need a window.
    numbered = not keys and weight is None
    columns = {PART: F.spark_partition_id()}
    if numbered:
        ranged = ranged.sortWithinPartitions(*order)
        columns["_local"] = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    # Range bounds come from a sample, so both uses below must see one and the same layout.
    placed = materialise(ranged.withColumns(columns))

    local = Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = (
        Window.partitionBy(*keys) if keys else Window.partitionBy()
    ).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition and group. Only a group that crosses a partition
    # boundary has an offset, so at most one row per partition is broadcast.
    offsets = (
        placed.groupBy(PART, *keys).agg(F.sum("_amount").alias("_part_total"))
        .withColumn("_before", F.sum("_part_total").over(earlier))
        .where("_before IS NOT NULL")
        .select(F.col(PART).alias("_o_part"), "_before", *[F.col(k).alias(f"_o_{k}") for k in keys])
    )
    on = F.col(PART) == F.col("_o_part")
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_o_{key}"))
    summed = placed if numbered else placed.withColumn("_local", F.sum("_amount").over(local))
    return (
        summed.join(F.broadcast(offsets), on, "left")
        .withColumn(name, F.col("_local") + F.coalesce("_before", F.lit(0)))
        .select(*df.columns, name)
    )
