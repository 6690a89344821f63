"""Mixing sources to target weights (6) by weighted fair queueing.

The documents of each source stand in a shuffled order that depends on their ids only. A document's
virtual finish time is its source's running total of words divided by the source's target. All documents of all
sources are put in one order by finish time, and the queue is cut where its total reaches the budget. A source
whose target is above its size is queued up to three times.

Only DataFrame operations run. Running totals go through range partitions with offsets, so a source with most of the
rows spreads over many tasks; two of them are taken, over ids and numbers alone, never over texts, which are read once for their sizes.

Defined results: a null or blank text has size 0 and nothing is taken of it; the null source is a
source, last in order; repeated rows count and queue each on its own; a source without words has target 0; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..ranking import running_total
from ..session import materialise
from .common import NOT_BLANKS

WEIGHTS = (1, 2, 3)
MOST_PASSES = 3


def word_count(text: str = "text") -> Column:
    """Number of runs of non-blank characters; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(NOT_BLANKS)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``source, source_size, target`` for ``sizes (source, size)``.

    Sources in code point order, null last, take the weights in turn. Targets share the sum of all sizes by weight
    and stop at ``most`` times the source's size; the excess is shared again by weight until none is above. Each
    round is one small aggregate, and a source that reached its limit keeps it.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running_total(summed, order, "place")
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    weighted = materialise(ranked.select(
        "source", "source_size", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
        .cast("bigint").alias("weight")))
    level, limit = 0.0, F.col("source_size") * most
    full = F.lit(False)
    while True:
        total, left, weight, filled = weighted.agg(
            F.sum("source_size"), F.sum("source_size") - F.coalesce(F.sum(F.when(full, limit)), F.lit(0)),
            F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if not total or not weight:
            break
        level = left / weight
        full_now = limit < F.col("weight") * F.lit(level)
        if weighted.where(full_now).count() == filled:
            break
        full = full_now
    return weighted.select("source", "source_size", F.when(full, limit.cast("double"))
                           .otherwise(F.col("weight") * F.lit(level)).alias("target"))


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, seed: str = "mix") -> DataFrame:
    """``doc_id, source, size, source_size, target, passes, taken`` for ``sized (doc_id, source, size)``.

    ``passes`` is how often the mix takes the document, ``taken`` its words times that.
    """
    # Sizes are read from the texts once; all below reads ids, sources and numbers.
    sized = materialise(sized.select("doc_id", "source", "size"))
    targets = source_targets(sized, weights, most)
    shuffled = sized.withColumn("mixed", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"),
                                                                              F.lit("")))))
    queued = running_total(shuffled, ["mixed", "doc_id", "size"], "upto", group=["source"], weight="size")
    # One row per source; the optimizer broadcasts it if it is small.
    known = targets.withColumnRenamed("source", "_source")
    queued = materialise(
        queued.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "mixed"))
    whole = F.col("source_size").cast("double")
    order = [F.col(c) for c in ("finish", "no_source", "source", "upto", "doc_id")]

    def place(number: Column) -> list[Column]:
        finish = (number * whole + F.col("upto")) / F.col("target")
        return [finish.alias("finish"), F.col("source").isNull().alias("no_source"), F.col("source"), F.col("upto"),
                F.col("doc_id")]

    # A pass that starts at or after the source's target cannot be in the mix; without words there is nothing to take.
    items = (
        queued.where("size > 0 AND target > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
        .where(F.col("pass") * whole + F.col("upto") - F.col("size") < F.col("target"))
        .select(*place(F.col("pass")), "size")
    )
    budget = sized.agg(F.sum("size")).first()[0] or 0
    spent = running_total(items, order, "spent", weight="size")
    # The first item that does not fit; a single row.
    cut = spent.where(F.col("spent") > budget).agg(F.min(F.struct(*order)).alias("cut")).first()["cut"]
    names = ["finish", "no_source", "source", "upto", "doc_id"]
    kinds = ["double", "boolean", "string", "bigint", "bigint"]
    taken = F.lit(0)
    for number in range(most):
        in_time = number * whole + F.col("upto") - F.col("size") < F.col("target")
        if cut is not None:
            bound = F.struct(*[F.lit(cut[n]).cast(k).alias(n) for n, k in zip(names, kinds)])
            in_time = in_time & (F.struct(*place(F.lit(number))) < bound)
        taken = taken + F.when(F.expr("size > 0 AND target > 0") & in_time, 1).otherwise(0)
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.cast("int").alias("passes")) \
        .withColumn("taken", F.col("passes") * F.col("size"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``mix`` of a table with ``doc_id, text, source``."""
    return mix(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string")
                           .alias("source"), word_count().alias("size")), **options)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.select("*", F.col("doc_id").cast("bigint").alias("__id"), F.col("source").cast("string").alias("__from"),
                      word_count().alias("__size"))
    taken = mix(own.select(F.col("__id").alias("doc_id"), F.col("__from").alias("source"), F.col("__size").alias("size")),
                **options)
    # Rows alike in id, source and size, one as a rule, share out their passes in order.
    key = ["__id", "__from", "__size"]
    passes = taken.groupBy(*(F.col(c).alias(f"{k}_2") for c, k in zip(("doc_id", "source", "size"), key))).agg(
        F.sort_array(F.collect_list("passes")).alias("__passes"))
    numbered = own.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy("text")))
    on = [F.col(k).eqNullSafe(F.col(f"{k}_2")) for k in key]
    return numbered.join(passes, on).select(*names, F.explode(
        F.array_repeat(F.lit(0), F.element_at("__passes", F.col("__n")))).alias("__pass")).drop("__pass")


# The same in SQL: limits that are reached are those of the sources with the least limit per unit of weight.
SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), summed AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
    FROM sized GROUP BY source
), filling AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE) AS room,
           CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS share,
           row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS n
    FROM summed
    WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT room / share AS level FROM filling WHERE 3 * source_size >= weight * (room / share) ORDER BY n LIMIT 1
), targets AS (
    SELECT source, source_size, CASE WHEN 3 * source_size < weight * level THEN CAST(3 * source_size AS DOUBLE)
                                     ELSE weight * level END AS target
    FROM summed, level
), queued AS (
    SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
           CAST(sum(size) OVER (PARTITION BY s.source
                                ORDER BY md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
                                ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
    FROM sized AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source
), items AS (
    SELECT *, (CAST(pass AS DOUBLE) * source_size + upto) / target AS finish
    FROM queued, (VALUES (0), (1), (2)) AS p(pass)
    WHERE size > 0 AND target > 0 AND CAST(pass AS DOUBLE) * source_size + upto - size < target
), spent AS (
    SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, source, upto, doc_id ROWS UNBOUNDED PRECEDING) AS spent
    FROM items
), passes AS (
    SELECT doc_id, source, upto, count(*) AS passes FROM spent
    WHERE spent <= (SELECT sum(size) FROM sized) GROUP BY ALL
)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, CAST(coalesce(p.passes, 0) AS INTEGER) AS passes,
       CAST(coalesce(p.passes, 0) * q.size AS BIGINT) AS taken
FROM queued AS q LEFT JOIN passes AS p
  ON q.size > 0 AND q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.source IS NOT DISTINCT FROM p.source
     AND q.upto = p.upto
"""
