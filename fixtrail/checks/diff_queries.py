"""D1-D9 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import diffs as texts
from ..operators import diffs as D
from .registry import register
from .signed import DIFFS, TRIM, diffs
from .testbed import tables

# Lines of a text where a final line end opens no further line.
LINES = "string_split(regexp_replace({0}, '\\n$', ''), chr(10))"
DIFF_LINES = LINES.format("diff")


def _marked(sign: str) -> str:
    return f"[{TRIM.format('x[2:]')} for x in {DIFF_LINES} if x LIKE '{sign}%']"


def _entries(sign: str):
    numbered = F.transform(F.split("diff", "\n"), lambda line, at: F.struct(
        (at + 1).alias("line"), F.substr(line, F.lit(2)).alias("text"), F.startswith(line, F.lit(sign)).alias("mine")))
    return F.transform(F.filter(numbered, lambda e: e.mine), lambda e: F.struct(e.line.alias("line"), e.text.alias("text")))


def _entries_text(sign: str) -> str:
    listed = f"[x for x in list_zip(range(1, len(string_split(diff, chr(10))) + 1), string_split(diff, chr(10))) if x[2] LIKE '{sign}%']"
    return f"array_to_string([CAST(y[1] AS VARCHAR) || ':' || y[2][2:] for y in {listed}], '|')"


@register("d1_parse_diff", f"""
    SELECT doc_id, {_entries_text('+')} AS added, {_entries_text('-')} AS deleted FROM {DIFFS}""")
def d1(spark, sf_dir):
    parsed = F.struct(_entries("+").alias("added"), _entries("-").alias("deleted"))
    stored = diffs(spark, sf_dir).select("doc_id", F.to_json(parsed).alias("diff_parsed"))

    def flat(column: str):
        return F.array_join(F.transform(column, lambda e: F.concat(e.line.cast("string"), F.lit(":"), e.text)), "|")

    return D.parse_diff(stored).select("doc_id", flat("diff_added").alias("added"), flat("diff_deleted").alias("deleted"))


@register("d2_number_diff", f"""
    WITH li AS (SELECT doc_id, unnest(string_split(diff, chr(10))) AS raw,
                       generate_subscripts(string_split(diff, chr(10)), 1) AS pos FROM {DIFFS}),
    si AS (SELECT doc_id, pos, rtrim(raw, ' ' || chr(9) || chr(13)) AS raw,
                  CASE WHEN raw LIKE '\\ No newline%' THEN '\\' ELSE raw[1] END AS sign FROM li),
    nu AS (SELECT *, sum(CASE WHEN sign IN ('+', '\\') THEN 0 ELSE 1 END) OVER w AS o,
                  sum(CASE WHEN sign IN ('-', '\\') THEN 0 ELSE 1 END) OVER w AS n
           FROM si WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
    SELECT doc_id, sign, CAST(CASE WHEN sign = '-' THEN o ELSE n END AS BIGINT) AS line, raw[2:] AS text
    FROM nu WHERE sign IN ('+', '-')""")
def d2(spark, sf_dir):
    return D.number_diff(diffs(spark, sf_dir), "doc_id")


@register("d3_single_change", f"""
    SELECT doc_id, list_extract({_marked('-')}, -1) AS vul, list_extract({_marked('+')}, -1) AS patch FROM {DIFFS}""")
def d3(spark, sf_dir):
    return diffs(spark, sf_dir).select("doc_id", texts.single_change(F.col("diff")).alias("c")).select("doc_id", "c.*")


def _pairs(spark, sf_dir):
    """Documents 2k and 2k + 1 as the two sides of a text."""
    return tables(spark, sf_dir)["documents"].select(
        F.floor(F.col("doc_id") / 2).alias("pair"), (F.col("doc_id") % 2 == 0).alias("before_change"), "text")


SIDES = f"""
    li AS (SELECT doc_id // 2 AS pair, doc_id % 2 = 0 AS before_change, unnest({LINES.format('text')}) AS line,
                  generate_subscripts({LINES.format('text')}, 1) - 1 AS pos FROM documents WHERE text <> ''),
    nu AS (SELECT *, row_number() OVER (PARTITION BY pair, before_change, line ORDER BY pos) AS copy FROM li),
    un AS (SELECT COALESCE(b.pair, a.pair) AS pair, b.pair IS NOT NULL AS before_change, COALESCE(b.line, a.line) AS line,
                  COALESCE(b.pos, a.pos) AS pos, COALESCE(b.copy, a.copy) AS copy
           FROM (SELECT * FROM nu WHERE before_change) b FULL JOIN (SELECT * FROM nu WHERE NOT before_change) a
           ON b.pair = a.pair AND b.line = a.line AND b.copy = a.copy
           WHERE b.pair IS NULL OR a.pair IS NULL)"""


@register("d4_line_diff", f"""
    WITH {SIDES} SELECT pair, before_change, CAST(pos AS INT) AS pos, line, CAST(copy AS INT) AS copy FROM un""")
def d4(spark, sf_dir):
    return D.line_diff(_pairs(spark, sf_dir), ["pair"])


@register("d5_diff_dict", f"""
    SELECT doc_id, array_to_string({_marked('+')}, '|') AS added, array_to_string({_marked('-')}, '|') AS deleted
    FROM {DIFFS}""")
def d5(spark, sf_dir):
    changed = diffs(spark, sf_dir).select("doc_id", texts.diff_dict(F.col("diff")).alias("d"))
    return changed.select("doc_id", F.array_join("d.added", "|").alias("added"),
                          F.array_join("d.deleted", "|").alias("deleted"))


@register("d6_join_changes", f"""
    SELECT doc_id, array_to_string({_marked('+')}, ' ') AS diff_added, array_to_string({_marked('-')}, ' ') AS diff_deleted
    FROM {DIFFS}""")
def d6(spark, sf_dir):
    changed = diffs(spark, sf_dir).select("doc_id", texts.diff_dict(F.col("diff")).alias("d"))
    return changed.select("doc_id", texts.join_changes(F.col("d.added")).alias("diff_added"),
                          texts.join_changes(F.col("d.deleted")).alias("diff_deleted"))


def _joined(flag: str, keys: str = "pair") -> str:
    trimmed = TRIM.format("line")
    return f"COALESCE(string_agg({trimmed}, ' ' ORDER BY pos) FILTER (WHERE {flag}), '')"


@register("d6_join_changed_lines", f"""
    WITH {SIDES} SELECT pair, {_joined('NOT before_change')} AS diff_added, {_joined('before_change')} AS diff_deleted
    FROM un GROUP BY pair""")
def d6_grouped(spark, sf_dir):
    return D.join_changed_lines(D.line_diff(_pairs(spark, sf_dir), ["pair"]), ["pair"])


# One pass: methods are numbered once, then both sides of a number meet in one group.
PAIRED = """
    oc AS MATERIALIZED (SELECT file_change_id, name, before_change, method_change_id, code, row_number() OVER (
               PARTITION BY file_change_id, name, before_change ORDER BY start_line, method_change_id) AS occurrence
           FROM %s),
    pa AS (SELECT file_change_id, name, CAST(occurrence AS INT) AS occurrence,
                  max(method_change_id) FILTER (WHERE before_change) AS before_id,
                  max(method_change_id) FILTER (WHERE NOT before_change) AS after_id,
                  max(code) FILTER (WHERE before_change) AS code_before,
                  max(code) FILTER (WHERE NOT before_change) AS code_after
           FROM oc GROUP BY file_change_id, name, occurrence
           HAVING count(*) FILTER (WHERE before_change) > 0 AND count(*) FILTER (WHERE NOT before_change) > 0)"""


@register("d7_pair_methods", f"WITH {PAIRED % '{method_change}'} SELECT * FROM pa")
def d7(spark, sf_dir):
    return D.pair_methods(tables(spark, sf_dir)["method_change"])


# Some methods have no version after the change, so pairs fall out of step.
UNEVEN = "(SELECT * FROM {method_change} WHERE before_change OR token_count % 9 <> 0)"


@register("d8_pair_adjacent", f"""
    WITH nu AS (SELECT *, row_number() OVER (ORDER BY file_change_id, before_change DESC, method_change_id) AS rn
                FROM {UNEVEN}),
    le AS (SELECT *, lead(file_change_id) OVER w AS f2, lead(name) OVER w AS n2, lead(method_change_id) OVER w AS m2,
                  lead(code) OVER w AS c2 FROM nu WINDOW w AS (ORDER BY rn))
    SELECT CAST((rn - 1) // 2 AS BIGINT) AS pair, file_change_id, name, method_change_id AS first_id, m2 AS second_id,
           code AS first_code, c2 AS second_code
    FROM le WHERE rn % 2 = 1 AND file_change_id = f2 AND name = n2""")
def d8(spark, sf_dir):
    methods = tables(spark, sf_dir)["method_change"].where("before_change OR token_count % 9 <> 0")
    return D.pair_adjacent(methods, ["file_change_id", "before_change", "method_change_id"], descending=["before_change"])


@register("d9_method_patches", f"""
    WITH {PAIRED % "(SELECT m.* FROM {method_change} m JOIN {file_change} f ON m.file_change_id = f.file_change_id WHERE f.programming_language = 'AF')"},
    li AS (SELECT file_change_id, name, occurrence, true AS before_change, unnest({LINES.format('code_before')}) AS line,
                  generate_subscripts({LINES.format('code_before')}, 1) AS pos FROM pa
           UNION ALL
           SELECT file_change_id, name, occurrence, false, unnest({LINES.format('code_after')}),
                  generate_subscripts({LINES.format('code_after')}, 1) FROM pa),
    nu AS (SELECT *, row_number() OVER (PARTITION BY file_change_id, name, occurrence, before_change, line ORDER BY pos)
               AS copy FROM li),
    un AS (SELECT n.* FROM nu n WHERE NOT EXISTS (
               SELECT 1 FROM nu o WHERE o.file_change_id = n.file_change_id AND o.name = n.name
               AND o.occurrence = n.occurrence AND o.line = n.line AND o.copy = n.copy
               AND o.before_change <> n.before_change)),
    jo AS (SELECT file_change_id, name, occurrence, {_joined('NOT before_change')} AS diff_added,
                  {_joined('before_change')} AS diff_deleted FROM un GROUP BY ALL)
    SELECT pa.file_change_id, pa.name, pa.occurrence, COALESCE(diff_added, '') AS diff_added,
           COALESCE(diff_deleted, '') AS diff_deleted
    FROM pa LEFT JOIN jo ON pa.file_change_id = jo.file_change_id AND pa.name = jo.name AND pa.occurrence = jo.occurrence""")
def d9(spark, sf_dir):
    t = tables(spark, sf_dir)
    return D.method_patches(t["method_change"], t["file_change"], "AF")
