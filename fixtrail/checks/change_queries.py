"""C1-C9 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import code
from ..operators import changes as C
from .registry import register
from .signed import DIFFS, diffs
from .testbed import tables


@register("c1_changed_methods", """
    SELECT DISTINCT s.* FROM {spans} s JOIN {lines} l
    ON s.file_change_id = l.file_change_id AND s.before_change = l.before_change
       AND l.line BETWEEN s.start_line AND s.end_line""")
def c1(spark, sf_dir):
    t = tables(spark, sf_dir)
    return C.changed_methods(t["lines"], t["spans"])


@register("c2_method_code", """
    SELECT doc_id, array_to_string(string_split(text, chr(10))[1 + doc_id % 3 : 1 + doc_id % 3 + doc_id % 5], chr(10))
        AS code FROM documents""")
def c2(spark, sf_dir):
    start = 1 + F.col("doc_id") % 3
    return tables(spark, sf_dir)["documents"].select(
        "doc_id", code.method_code(F.col("text"), start, start + F.col("doc_id") % 5).alias("code"))


FILES = """
    SELECT CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) || '/' || CAST(l_partkey AS STRING) || '/' ||
               CAST(l_suppkey AS STRING) AS path, l_orderkey, l_partkey, l_suppkey, l_quantity,
           'a' || CAST(l_partkey AS STRING) || chr(10) || 'b' || chr(10) || 'c' || chr(10) || 'd' || chr(10) || 'e' AS after,
           CASE WHEN l_suppkey % 5 <> 0 THEN 'a' || CAST(l_suppkey AS STRING) || chr(10) || 'b' || chr(10) || 'c' END
               AS before
    FROM {lineitem}"""
ID48 = "CAST('0x' || substr(md5({0}), 1, 12) AS BIGINT)"


def _method_side(flag: str, source: str, name: str, first: int, last: int, line: str, text: str) -> str:
    """One method of each file as SQL, if a changed line lies in it and its side has source."""
    return f"""
        SELECT file_change_id, '{name}' AS name, {first} AS start_line, {last} AS end_line, {text} AS code,
               CAST(l_quantity AS INT) AS nloc, {flag} AS before_change
        FROM fi WHERE {source} IS NOT NULL AND {line} BETWEEN {first} AND {last}"""


@register("c3_method_rows", f"""
    WITH fi AS (SELECT *, {ID48.format('path')} AS file_change_id FROM ({FILES.replace('{lineitem}', 'lineitem')})),
    me AS ({' UNION ALL '.join((
        _method_side('true', 'before', 'f', 1, 2, '1 + l_suppkey % 6',
                     "array_to_string(string_split(before, chr(10))[1:2], chr(10))"),
        _method_side('false', 'after', 'f', 1, 2, '1 + l_partkey % 6',
                     "array_to_string(string_split(after, chr(10))[1:2], chr(10))"),
        _method_side('false', 'after', 'g', 4, 9, '1 + l_partkey % 6',
                     "array_to_string(string_split(after, chr(10))[4:9], chr(10))"),
    ))})
    SELECT *, {ID48.format("CAST(file_change_id AS STRING) || '-' || CAST(before_change AS STRING) || '-' || name || '-' || CAST(start_line AS STRING) || '-' || CAST(end_line AS STRING)")}
        AS method_change_id FROM me""")
def c3(spark, sf_dir):
    files = spark.sql(FILES, lineitem=tables(spark, sf_dir)["lineitem"])

    def method(name: str, first: int, last: int):
        return F.struct(
            F.lit(name).alias("name"), F.lit(name).alias("long_name"), F.array(F.lit("x")).alias("parameters"),
            F.lit(first).alias("start_line"), F.lit(last).alias("end_line"),
            F.col("l_quantity").cast("int").alias("nloc"), F.lit(1).alias("complexity"), F.lit(2).alias("token_count"),
            F.lit(0).alias("top_nesting_level"))

    def line(column: str):
        return F.array(F.struct((1 + F.col(column) % 6).cast("int").alias("line"), F.lit("t").alias("text")))

    nested = files.select(
        code.surrogate_id("path").alias("file_change_id"),
        F.col("after").alias("source_code"), F.col("before").alias("source_code_before"),
        F.array(method("f", 1, 2), method(C.ANONYMOUS, 3, 3), method("g", 4, 9)).alias("methods"),
        F.array(method("f", 1, 2), method(C.ANONYMOUS, 3, 6)).alias("methods_before"),
        F.struct(line("l_partkey").alias("added"), line("l_suppkey").alias("deleted")).alias("diff_parsed"),
        "l_quantity",
    )
    return C.method_rows(nested).select(
        "method_change_id", "file_change_id", "name", "start_line", "end_line", "code", "nloc", "before_change")


def _snapshots(spark, sf_dir):
    """Commits from orders, with o_orderkey % 4 files each (some lists are empty)."""
    def one(n):
        changed = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
            i.cast("int").alias("line"), F.lit("x").alias("text")))
        return F.struct(
            F.concat(F.lit("f"), n.cast("string")).alias("filename"), F.lit(None).cast("string").alias("old_path"),
            F.concat(F.lit("src/f"), n.cast("string")).alias("new_path"), F.lit("MODIFY").alias("change_type"),
            F.lit("+x").alias("diff"),
            F.struct(changed.alias("added"), F.slice(changed, 1, 1).alias("deleted")).alias("diff_parsed"),
            F.concat(F.lit("after "), n.cast("string")).alias("source_code"),
            F.lit(None).cast("string").alias("source_code_before"),
            (n * 10).cast("int").alias("nloc"), F.lit(1).alias("complexity"), F.lit(3).alias("token_count"),
        )

    many = F.col("o_orderkey") % 4
    numbers = F.when(many > 0, F.sequence(F.lit(1).cast("bigint"), many)).otherwise(F.array().cast("array<bigint>"))
    who = F.struct(F.col("o_orderstatus").alias("name"), F.col("o_orderdate").cast("timestamp").alias("date"),
                   F.lit(3600).alias("timezone"))
    return tables(spark, sf_dir)["orders"].select(
        F.col("o_orderkey").cast("string").alias("hash"),
        F.concat(F.lit("https://github.com/o/c"), F.col("o_custkey").cast("string")).alias("repo_url"),
        who.alias("author"), who.alias("committer"), F.col("o_orderpriority").alias("msg"),
        (F.col("o_orderkey") % 2 == 0).alias("merge"), F.array(F.lit("p")).alias("parents"),
        F.transform(numbers, one).alias("modified_files"),
    )


@register("c4_commit_rows", """
    SELECT CAST(o_orderkey AS STRING) AS hash, 'https://github.com/o/c' || CAST(o_custkey AS STRING) AS repo_url,
           o_orderstatus AS author, 3600 AS committer_timezone, strftime(o_orderdate, '%Y-%m-%d') AS committed,
           o_orderpriority AS msg, o_orderkey % 2 = 0 AS merge,
           CAST((o_orderkey % 4) * (o_orderkey % 4 + 1) / 2 AS INT) AS num_lines_added,
           CAST(o_orderkey % 4 AS INT) AS num_lines_deleted
    FROM orders""")
def c4_commits(spark, sf_dir):
    rows = C.commit_rows(_snapshots(spark, sf_dir))
    return rows.select("hash", "repo_url", "author", "committer_timezone",
                       F.date_format("committer_date", "yyyy-MM-dd").alias("committed"), "msg", "merge",
                       "num_lines_added", "num_lines_deleted")


FILE_NO = """
    SELECT CAST(o_orderkey AS STRING) AS hash, 'https://github.com/o/c' || CAST(o_custkey AS STRING) AS repo_url,
           unnest(range(1, o_orderkey % 4 + 1)) AS n FROM orders"""


@register("c4_file_rows", f"""
    SELECT {ID48.format("repo_url || '-' || hash || '-src/f' || CAST(n AS STRING) || '-' || CAST(n - 1 AS STRING)")}
               AS file_change_id,
           hash, 'f' || CAST(n AS STRING) AS filename, 'src/f' || CAST(n AS STRING) AS new_path, 'MODIFY' AS change_type,
           CAST(n AS INT) AS num_lines_added, 1 AS num_lines_deleted, 'after ' || CAST(n AS STRING) AS code_after,
           CAST(n * 10 AS INT) AS nloc
    FROM ({FILE_NO})""")
def c4_files(spark, sf_dir):
    return C.file_rows(_snapshots(spark, sf_dir)).select(
        "file_change_id", "hash", "filename", "new_path", "change_type", "num_lines_added", "num_lines_deleted",
        "code_after", "nloc")


@register("c5_surrogate_id", f"""
    SELECT o_orderkey, {ID48.format("CAST(o_orderkey AS STRING) || '-' || o_orderstatus")} AS id FROM orders""")
def c5(spark, sf_dir):
    return tables(spark, sf_dir)["orders"].select(
        "o_orderkey", code.surrogate_id(F.col("o_orderkey").cast("string"), "o_orderstatus").alias("id"))


LINE_TOTALS = f"""
    SELECT doc_id, source AS hash, CAST(len([x for x in string_split(diff, chr(10)) if x LIKE '+%']) AS BIGINT)
               AS num_lines_added,
           CAST(len([x for x in string_split(diff, chr(10)) if x LIKE '-%']) AS BIGINT) AS num_lines_deleted
    FROM {DIFFS}"""


def _line_totals(spark, sf_dir):
    return C.line_totals(diffs(spark, sf_dir)).select(
        "doc_id", F.col("source").alias("hash"), "num_lines_added", "num_lines_deleted")


@register("c6_line_totals", LINE_TOTALS)
def c6(spark, sf_dir):
    return _line_totals(spark, sf_dir)


@register("c6_commit_line_totals", f"""
    SELECT hash, CAST(sum(num_lines_added) AS BIGINT) AS num_lines_added,
           CAST(sum(num_lines_deleted) AS BIGINT) AS num_lines_deleted FROM ({LINE_TOTALS}) GROUP BY hash""")
def c6_commits(spark, sf_dir):
    return C.commit_line_totals(_line_totals(spark, sf_dir))


WORDS = ", ".join(f"'{word}'" for word in code.DECISION_WORDS)


@register("c7_text_metrics", f"""
    SELECT doc_id, CAST(len([x for x in string_split(text, chr(10)) if trim(x, ' ' || chr(9) || chr(13)) <> '']) AS BIGINT)
               AS nloc,
           CAST(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^ \\t\\r\\nA-Za-z0-9_]')) AS BIGINT) AS token_count,
           CAST(1 + len([x for x in regexp_extract_all(text, '[A-Za-z0-9_]+') if x IN ({WORDS})])
                + len(regexp_extract_all(text, '&&|\\|\\||\\?')) AS BIGINT) AS complexity
    FROM documents""")
def c7(spark, sf_dir):
    source = F.col("text")
    return tables(spark, sf_dir)["documents"].select(
        "doc_id", code.line_count(source).alias("nloc"), code.token_count(source).alias("token_count"),
        code.decision_count(source).alias("complexity"))


def _dmm(name: str, low: str) -> str:
    moves = f"""sum(CASE WHEN {low} THEN s ELSE 0 END) AS lo_{name}, sum(CASE WHEN {low} THEN 0 ELSE s END) AS hi_{name}"""
    return moves


def _dmm_share(name: str) -> str:
    good = f"(greatest(lo_{name}, 0) + greatest(-hi_{name}, 0))"
    bad = f"(greatest(-lo_{name}, 0) + greatest(hi_{name}, 0))"
    return f"round(CAST({good} AS DOUBLE) / nullif({good} + {bad}, 0), 6) AS dmm_unit_{name}"


@register("c8_maintainability", f"""
    WITH me AS (SELECT f.hash, m.*, CASE WHEN m.before_change THEN -m.nloc ELSE m.nloc END AS s
                FROM {{method_change}} m JOIN {{file_change}} f ON f.file_change_id = m.file_change_id),
    mo AS (SELECT hash, {_dmm('size', 'nloc <= 15')}, {_dmm('complexity', 'complexity <= 5')},
                  {_dmm('interfacing', 'parameter_count <= 2')} FROM me GROUP BY hash)
    SELECT hash, {_dmm_share('size')}, {_dmm_share('complexity')}, {_dmm_share('interfacing')} FROM mo""")
def c8(spark, sf_dir):
    t = tables(spark, sf_dir)
    measures = C.maintainability(t["method_change"], t["file_change"])
    return measures.select("hash", *[F.round(c, 6).alias(c) for c in measures.columns if c != "hash"])


LANGUAGES = ("de", "en", "es", "fr")
SPACE = C.FEATURES


@register("c9_label_language", f"""
    WITH te AS (SELECT doc_id, lang, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s
                FROM documents),
    ch AS (SELECT doc_id, lang, [CAST(unicode(x) AS BIGINT) for x in string_split(s, '')] AS c FROM te),
    fe AS (SELECT doc_id, lang, unnest([(x[1] * 1009 + x[2] * 31 + x[3]) % {SPACE}
                  for x in list_zip(c[1:len(c) - 2], c[2:len(c) - 1], c[3:])]) AS f FROM ch WHERE len(c) >= 3),
    co AS (SELECT f, lang, count(*) AS n FROM fe GROUP BY ALL),
    la AS (SELECT lang, sum(n) AS total FROM co GROUP BY lang),
    mo AS (SELECT r.f, la.lang, ln((COALESCE(co.n, 0) + 1) / (la.total + {SPACE})::DOUBLE) AS p
           FROM (SELECT DISTINCT f FROM fe) r CROSS JOIN la LEFT JOIN co ON co.f = r.f AND co.lang = la.lang),
    sc AS (SELECT doc_id, mo.lang, sum(p) AS score FROM fe JOIN mo ON fe.f = mo.f GROUP BY ALL),
    be AS (SELECT doc_id, arg_max(lang, score) AS lang FROM sc GROUP BY doc_id)
    SELECT d.doc_id, COALESCE(be.lang, 'unknown') AS programming_language
    FROM documents d LEFT JOIN be ON be.doc_id = d.doc_id""")
def c9(spark, sf_dir):
    documents = tables(spark, sf_dir)["documents"].select("doc_id", "text", "lang")
    model = C.train_language(documents, LANGUAGES)
    return C.label_language(documents, model, "doc_id", "text")
