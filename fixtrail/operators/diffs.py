"""Line-level differences and method pairs.

Windows here are keyed by one text, or one file, so a partition never holds more
than the lines of one input row. Texts are shuffled whole and split into lines
afterwards; all windows of an operator reuse that one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.code import text_lines
from ..functions.diffs import PARSED_DIFF
from ..functions.text import rstrip, strip
from ..ranking import running_total

# Marks for a missing line end; the first is git's own text.
NO_LINE_END = ("\\ No newline at end of file", "\\ No newline at the end of file")


def parse_diff(files: DataFrame, column: str = "diff_parsed") -> DataFrame:
    """Add diff_added and diff_deleted (arrays of line and text) from the parsed diff.

    The column is the native struct, or its JSON text.
    """
    parsed = F.col(column)
    if files.schema[column].dataType.simpleString() == "string":
        parsed = F.from_json(parsed, PARSED_DIFF)
    return files.withColumns({"diff_added": parsed.added, "diff_deleted": parsed.deleted})


def number_diff(diffs: DataFrame, key: str, diff: str = "diff") -> DataFrame:
    """(key, sign, line, text) of the added and deleted lines of each diff.

    The old side's counter skips added lines, the new side's skips deleted ones;
    marks for a missing line end count on neither.
    """
    lines = (
        diffs.select(key, diff).repartition(key)
        .select(key, F.posexplode(F.split(diff, "\n")).alias("_pos", "_raw"))
        .select(key, "_pos", rstrip(F.col("_raw")).alias("_raw"))
        .withColumn("sign", F.when(F.col("_raw").isin(*NO_LINE_END), "\\").otherwise(F.substring("_raw", 1, 1)))
    )
    so_far = Window.partitionBy(key).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)

    def counter(skipped: str) -> Column:
        return F.sum(F.when(F.col("sign").isin(skipped, "\\"), 0).otherwise(1)).over(so_far)

    return (
        lines.withColumns({"_old": counter("+"), "_new": counter("-")})
        .where(F.col("sign").isin("+", "-"))
        .select(key, "sign", F.when(F.col("sign") == "-", F.col("_old")).otherwise(F.col("_new")).alias("line"),
                F.substr("_raw", F.lit(2)).alias("text"))
    )


def mark_changes(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``copy`` and ``changed`` to lines (keys…, before_change, pos, line) of text pairs.

    The k-th copy of a line pairs with the k-th copy on the other side, so a line
    is changed if it is a copy beyond the number of those on the other side.
    """
    same = Window.partitionBy(*keys, "line")
    nth = Window.partitionBy(*keys, "line", "before_change").orderBy("pos")
    before = F.count_if(F.col("before_change")).over(same)
    after = F.count_if(~F.col("before_change")).over(same)
    return (
        lines.withColumns({"copy": F.row_number().over(nth), "_before": before, "_after": after})
        .withColumn("changed", F.col("copy") > F.when(F.col("before_change"), F.col("_after")).otherwise(F.col("_before")))
        .drop("_before", "_after")
    )


def unmatched_lines(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines (keys…, before_change, pos, line) without a partner on the other side, with their ``copy`` number."""
    return mark_changes(lines, keys).where("changed").drop("changed")


def _lines_of_pairs(pairs: DataFrame, keys: Sequence[str], before: str, after: str) -> DataFrame:
    """(keys…, before_change, pos, line) from rows with both texts; one row of NULLs where both are empty or equal."""
    def side(text: str, flag: bool) -> Column:
        whole = text_lines(F.coalesce(F.col(text), F.lit("")))
        return F.transform(whole, lambda line, at: F.struct(
            F.lit(flag).alias("before_change"), at.alias("pos"), line.alias("line")))

    # Equal texts have no changed line, so their lines need not be made.
    both = F.when(~F.col(before).eqNullSafe(F.col(after)), F.concat(side(before, True), side(after, False)))
    lines = pairs.select(*keys, F.explode_outer(both).alias("_l"))
    return lines.select(*keys, "_l.before_change", "_l.pos", "_l.line")


def line_diff(texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Deleted (before_change) and added lines of text pairs, one row per side (keys…, before_change, text)."""
    lines = (
        texts.select(*keys, "before_change", text).repartition(*keys)
        .select(*keys, "before_change", F.posexplode(text_lines(F.col(text))).alias("pos", "line"))
    )
    return unmatched_lines(lines, keys)


def pair_diff(pairs: DataFrame, keys: Sequence[str], before: str, after: str) -> DataFrame:
    """D4 for rows that hold both texts."""
    lines = _lines_of_pairs(pairs.select(*keys, before, after).repartition(*keys), keys, before, after)
    return unmatched_lines(lines.where("line IS NOT NULL"), keys)


def join_changed_lines(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D6 grouped: (keys…, diff_added, diff_deleted), the trimmed lines of each side in order, joined with blanks."""
    def joined(flag: bool) -> Column:
        chosen = F.collect_list(F.when(F.col("before_change") == F.lit(flag), F.struct("pos", "line")))
        return F.array_join(F.transform(F.array_sort(chosen), lambda entry: strip(entry.line)), " ")

    return lines.groupBy(*keys).agg(joined(False).alias("diff_added"), joined(True).alias("diff_deleted"))


def pair_methods(methods: DataFrame, placed: bool = False, spread: bool = False) -> DataFrame:
    """(file_change_id, name, occurrence, ids and code before and after) of methods on both sides.

    The n-th method of a name before the change pairs with the n-th after it, by
    line. One shuffle serves the numbering and the pairing; ``placed`` says that
    the methods are partitioned by file already. A group of the numbering is what one
    name has in one file, so it comes from one array of one snapshot's file and is no longer than that. ``spread``
    numbers through range partitions instead, for tables of other origin.
    """
    nth = Window.partitionBy("file_change_id", "name", "before_change").orderBy("start_line", "method_change_id")
    version = F.struct(F.col("method_change_id").alias("id"), F.col("code").alias("code"))
    narrow = methods.select("file_change_id", "name", "before_change", "start_line", "method_change_id", "code")
    if spread:
        numbered = running_total(
            narrow, ["start_line", "method_change_id"], "occurrence", group=["file_change_id", "name", "before_change"]
        ).withColumn("occurrence", F.col("occurrence").cast("int"))
    else:
        laid_out = narrow if placed else narrow.repartition("file_change_id", "name")
        numbered = laid_out.withColumn("occurrence", F.row_number().over(nth))
    return (
        numbered.groupBy("file_change_id", "name", "occurrence")
        .agg(
            F.max(F.when(F.col("before_change"), version)).alias("_b"),
            F.max(F.when(~F.col("before_change"), version)).alias("_a"),
        )
        .where("_b IS NOT NULL AND _a IS NOT NULL")
        .select(
            "file_change_id", "name", "occurrence",
            F.col("_b.id").alias("before_id"), F.col("_a.id").alias("after_id"),
            F.col("_b.code").alias("code_before"), F.col("_a.code").alias("code_after"),
        )
    )


def pair_adjacent(methods: DataFrame, order: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Rows 2k and 2k+1 of the whole order, where both have the same file and name (Q13).

    ``order`` names columns with a total order, ``descending`` those of them that
    fall; ``method_change_id`` is the key of the methods. The rows are numbered in range partitions, not in
    one task, by their ids and order alone. The pairs then meet their code on one layout by file and name, so code passes
    one exchange.
    """
    keys = ["file_change_id", "name"]
    sorting = [F.desc(column) if column in descending else F.col(column) for column in order]
    placed = running_total(methods.select(*dict.fromkeys((*keys, "method_change_id", *order))), sorting, "_at")
    row = F.struct("_at", *keys, "method_change_id")
    pairs = placed.groupBy(F.floor((F.col("_at") - 1) / 2).alias("pair")).agg(
        F.min(row).alias("_f"), F.max(row).alias("_s"), F.count("*").alias("_n")
    )
    sides = pairs.where("_n = 2 AND _f.file_change_id = _s.file_change_id AND _f.name = _s.name").select(
        "pair", "_f.file_change_id", "_f.name",
        F.posexplode(F.array("_f.method_change_id", "_s.method_change_id")).alias("_side", "method_change_id"),
    )
    # Places and texts of a method meet in a window instead of a join, whose layout would be by method.
    met = methods.select(*keys, "method_change_id", "code").unionByName(sides, allowMissingColumns=True)
    same = Window.partitionBy(*keys, "method_change_id")
    version = F.struct(F.col("method_change_id").alias("id"), F.col("code").alias("code"))
    return (
        met.repartition(*keys).withColumn("code", F.max("code").over(same)).where("pair IS NOT NULL")
        .groupBy(*keys, "pair")
        .agg(*[F.max(F.when(F.col("_side") == n, version)).alias(f"_{n}") for n in (0, 1)])
        .select("pair", *keys, F.col("_0.id").alias("first_id"), F.col("_1.id").alias("second_id"),
                F.col("_0.code").alias("first_code"), F.col("_1.code").alias("second_code"))
    )


def method_patches(methods: DataFrame, files: DataFrame, language: str) -> DataFrame:
    """(file_change_id, name, occurrence, diff_added, diff_deleted) for each paired method of a language.

    Pairs with equal code give two empty texts without a look at their lines. Code is shuffled once, by file:
    the language join, the pairing and the line windows all run on that layout. On large tables the session's runtime
    filters (``session.SETTINGS``) drop most other languages' code before that shuffle.
    """
    # Not made distinct: a runtime filter is not built over an aggregate.
    chosen = files.where(F.col("programming_language") == language).select("file_change_id")
    narrow = methods.select("file_change_id", "name", "before_change", "start_line", "method_change_id", "code")
    placed = narrow.repartition("file_change_id").join(chosen, "file_change_id", "left_semi")
    keys = ["file_change_id", "name", "occurrence"]
    lines = _lines_of_pairs(pair_methods(placed, placed=True), keys, "code_before", "code_after")
    # Unchanged lines lose their side instead of being dropped, so that every pair keeps its row.
    changed = mark_changes(lines, keys).withColumn("before_change", F.when(F.col("changed"), F.col("before_change")))
    return join_changed_lines(changed, keys)
