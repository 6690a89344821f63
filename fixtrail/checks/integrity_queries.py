"""P1-P8 on the driver tables."""

from __future__ import annotations

from ..operators import integrity as P
from .registry import register
from .testbed import tables


@register("p1_drop_non_textual", """
    SELECT * FROM {file_change} WHERE NOT (num_lines_added = 0 AND num_lines_deleted = 0)""")
def p1(spark, sf_dir):
    return P.drop_non_textual(tables(spark, sf_dir)["file_change"])


@register("p2_drop_unnamed", "SELECT * FROM {method_change} WHERE name <> ''")
def p2(spark, sf_dir):
    return P.drop_unnamed(tables(spark, sf_dir)["method_change"])


TEXTUAL = "SELECT * FROM {file_change} WHERE NOT (num_lines_added = 0 AND num_lines_deleted = 0)"
# The pruned tables, each from the raw ones.
PRUNED = {
    "fixes": "SELECT * FROM {fixes} WHERE hash IN (SELECT hash FROM {commits})",
    "commits": "SELECT DISTINCT * FROM {commits} WHERE hash IN (SELECT hash FROM {fixes})",
    "file_change": f"SELECT * FROM ({TEXTUAL}) WHERE hash IN (SELECT hash FROM {{fixes}})"
                   " AND hash IN (SELECT hash FROM {commits})",
    "cve": "SELECT * FROM {cve} WHERE cve_id IN (SELECT cve_id FROM {fixes})",
    "cwe_classification": "SELECT * FROM {cwe_classification} WHERE cve_id IN (SELECT cve_id FROM {fixes})",
}
PRUNED["method_change"] = (
    "SELECT * FROM {method_change} WHERE name <> '' AND file_change_id IN "
    f"(SELECT file_change_id FROM ({PRUNED['file_change']}))"
)
PRUNED["cwe"] = f"SELECT * FROM {{cwe}} WHERE cwe_id IN (SELECT cwe_id FROM ({PRUNED['cwe_classification']}))"
FILLED = """
    SELECT * FROM {repository} UNION ALL
    SELECT DISTINCT fx.repo_url, 'visit repo url', 'visit repo url', list_extract(string_split(fx.repo_url, '/'), -2),
           CAST(NULL AS INTEGER)
    FROM {fixes} fx WHERE NOT EXISTS (SELECT 1 FROM {repository} r WHERE r.repo_url = fx.repo_url)"""
PRUNED["repository"] = f"SELECT * FROM ({FILLED}) WHERE repo_url IN (SELECT repo_url FROM {{fixes}})"


def _register_pruned(name: str) -> None:
    @register(f"p3_prune_{name}", PRUNED[name])
    def query(spark, sf_dir):
        return P.prune(tables(spark, sf_dir))[name]


for _name in PRUNED:
    _register_pruned(_name)


@register("p3_prune_methods_with_orphans", """
    SELECT * FROM {method_change} WHERE name <> '' AND file_change_id NOT IN (
        SELECT file_change_id FROM (%s) WHERE hash NOT IN (SELECT hash FROM {fixes}))""" % TEXTUAL)
def p3_orphans(spark, sf_dir):
    return P.prune(tables(spark, sf_dir), keep_orphans=True)["method_change"]


@register("p4_fill_missing_repos", FILLED)
def p4(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.fill_missing_repos(t["fixes"], t["repository"])


@register("p5_check_unique", """
    SELECT cve_id, repo_url, count(*) AS row_count FROM {fixes} GROUP BY 1, 2 HAVING count(*) > 1""")
def p5(spark, sf_dir):
    return P.check_unique(tables(spark, sf_dir)["fixes"], ["cve_id", "repo_url"])


@register("p6_check_foreign_key", """
    SELECT repo_url, count(*) AS row_count FROM {fixes} fx
    WHERE NOT EXISTS (SELECT 1 FROM {repository} r WHERE r.repo_url = fx.repo_url) GROUP BY repo_url""")
def p6(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.check_foreign_key(t["fixes"], t["repository"], "repo_url")


def _rule(name, left, right, relation):
    sides = [f"(SELECT count(DISTINCT {column}) FROM {{{table}}})" for table, column in (left, right)]
    return f"SELECT '{name}' AS rule, {sides[0]} AS left_count, {sides[1]} AS right_count, {sides[0]} {relation} {sides[1]} AS holds"


_EMPTY = "(SELECT count(*) FROM {file_change} WHERE num_lines_added = 0 AND num_lines_deleted = 0)"


@register("p7_check_counts", " UNION ALL ".join(_rule(*rule) for rule in P.COUNT_RULES) + f"""
    UNION ALL SELECT 'textual_files', {_EMPTY}, CAST(0 AS BIGINT), {_EMPTY} = 0""")
def p7(spark, sf_dir):
    return P.check_counts(tables(spark, sf_dir))


def _rule_after(name, left, right, relation):
    sides = [f"(SELECT count(DISTINCT {column}) FROM ({PRUNED[table]}))" for table, column in (left, right)]
    return f"SELECT '{name}' AS rule, {sides[0]} AS left_count, {sides[1]} AS right_count, {sides[0]} {relation} {sides[1]} AS holds"


@register("p7_check_counts_after_prune", " UNION ALL ".join(_rule_after(*rule) for rule in P.COUNT_RULES) + """
    UNION ALL SELECT 'textual_files', CAST(0 AS BIGINT), CAST(0 AS BIGINT), true""")
def p7_pruned(spark, sf_dir):
    return P.check_counts(P.prune(tables(spark, sf_dir), materialise_links=True))


@register("p8_table_counts", """
    SELECT 'commits' AS measure, count(*) AS row_count FROM {commits}
    UNION ALL SELECT 'files', count(*) FROM {file_change}
    UNION ALL SELECT 'methods', count(*) FROM {method_change}
    UNION ALL SELECT 'vulnerable_methods', count(*) FROM {method_change} WHERE before_change""")
def p8(spark, sf_dir):
    return P.table_counts(tables(spark, sf_dir))
