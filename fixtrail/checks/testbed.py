"""The driver tables seen as the eight tables, as SQL text that both engines run.

``{name}`` stands for a driver table or another view. Spark binds DataFrames to
the names, the oracle gets the views it needs as a WITH clause.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _score(zero: int, missing: int) -> str:
    return (
        f"CASE WHEN p_partkey % {missing} = 0 THEN 'nan' WHEN p_partkey % {zero} = 0 THEN '0.0' "
        f"ELSE CAST((p_size + {zero}) % 10 AS STRING) || '.' || CAST(p_partkey % 10 AS STRING) END"
    )


VIEWS = {
    "commits": """
        SELECT CAST(o_orderkey AS STRING) AS hash,
               'https://host.example/cust/p_' || CAST(o_custkey AS STRING) AS repo_url,
               o_orderdate AS committer_date,
               CASE WHEN o_orderkey % 11 = 0 THEN 'None' WHEN o_totalprice < 50000 THEN '0.0'
                    ELSE '0.' || CAST(o_orderkey % 10 AS STRING) END AS dmm_unit_size,
               CASE WHEN o_orderkey % 11 = 0 THEN 'None' ELSE '0.' || CAST(o_custkey % 10 AS STRING) END
                    AS dmm_unit_complexity,
               '0.' || CAST((o_custkey + o_orderkey) % 10 AS STRING) AS dmm_unit_interfacing
        FROM {orders}""",
    "file_change": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' ||
                   CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS file_change_id,
               CAST(l_orderkey AS STRING) AS hash,
               'file' || CAST(l_linenumber AS STRING) || '.' || lower(l_returnflag) AS filename,
               CAST(l_quantity AS INT) - 1 AS num_lines_added,
               CAST(round(l_tax * 100) AS INT) AS num_lines_deleted,
               'old ' || CAST(l_partkey AS STRING) AS code_before,
               CASE WHEN l_partkey % 19 <> 0 THEN 'new ' || CAST(l_suppkey AS STRING) END AS code_after,
               l_returnflag || l_linestatus AS programming_language
        FROM {lineitem}""",
    "method_base": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' ||
                   CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS file_change_id,
               CASE WHEN l_suppkey % 17 = 0 THEN '' WHEN l_suppkey % 13 = 0 THEN '(anonymous)'
                    ELSE 'm' || CAST(l_linenumber AS STRING) END AS name,
               CAST(l_quantity AS INT) AS quantity, CAST(round(l_tax * 100) AS INT) AS tax,
               l_linenumber AS line, l_partkey AS part, l_suppkey AS supp
        FROM {lineitem} WHERE l_discount > 0.02""",
    "method_change": """
        SELECT file_change_id || '-b' AS method_change_id, file_change_id, name, name || ' ( int a )' AS signature,
               line % 5 AS parameter_count, 'a' AS parameters, 5 * line AS start_line, 5 * line + 8 AS end_line,
               quantity AS nloc, tax AS complexity, quantity + tax AS token_count,
               'int ' || name || ' begin' || chr(10) || '  x = ' || CAST(part % 7 AS STRING) || ';' || chr(10) || '' ||
                   chr(10) || '  y = ' || CAST(tax AS STRING) || ';' || chr(10) || '' || chr(10) || 'end' AS code,
               true AS before_change
        FROM {method_base}
        UNION ALL
        SELECT file_change_id || '-a', file_change_id, name, name || ' ( int a, int b )',
               (line + supp) % 5, 'a,b', 5 * line, 5 * line + 8,
               1 + 4 * line, line, quantity + line,
               'int ' || name || ' begin' || chr(10) || '  x = ' || CAST(supp % 7 AS STRING) || ';' || chr(10) || '' ||
                   chr(10) || '  z = ' || CAST(line AS STRING) || ';' || chr(10) || 'end',
               false
        FROM {method_base}""",
    "cve": f"""
        SELECT CAST(p_partkey AS STRING) AS cve_id, DATE '1995-01-01' + p_size * 30 AS published_date,
               {_score(9, 7)} AS cvss3_base_score, {_score(8, 11)} AS cvss2_base_score,
               {_score(5, 13)} AS exploitability_score, {_score(6, 17)} AS impact_score
        FROM {{part}}""",
    "cwe": """
        SELECT p_brand AS cwe_id, 'name, of "' || p_brand || '"' AS cwe_name, false AS is_category
        FROM (SELECT DISTINCT p_brand FROM {part}) b
        UNION ALL
        SELECT p_type, 'name, of "' || p_type || '"', true FROM (SELECT DISTINCT p_type FROM {part}) t""",
    "cwe_classification": """
        SELECT CAST(p_partkey AS STRING) AS cve_id, p_brand AS cwe_id FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), p_type FROM {part} WHERE p_size > 25""",
    "fixes": """
        SELECT DISTINCT CAST(l_partkey AS STRING) AS cve_id, CAST(l_orderkey AS STRING) AS hash,
               'https://host.example/cust/p_' || CAST(o_custkey AS STRING) AS repo_url
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        WHERE l_shipdate < TIMESTAMP '2000-01-01 00:00:00' AND l_partkey % 20 <> 0""",
    "repository": """
        SELECT 'https://host.example/cust/p_' || CAST(c_custkey AS STRING) AS repo_url, c_name AS repo_name,
               c_mktsegment AS description, 'cust' AS owner, CAST(round(abs(c_acctbal)) AS INT) AS stars_count
        FROM {customer} WHERE c_custkey % 10 <> 0""",
    "short_commits": """
        SELECT md5(CAST(o_orderkey AS STRING)) AS hash,
               'https://host.example/cust/p_' || CAST(o_custkey % 100 AS STRING) AS repo_url FROM {orders}""",
    "short_fixes": """
        SELECT CAST(o_orderkey AS STRING) AS cve_id,
               CASE WHEN o_orderkey % 3 = 0 THEN substr(md5(CAST(o_orderkey AS STRING)), 1, 7)
                    ELSE md5(CAST(o_orderkey AS STRING)) END AS hash,
               'https://host.example/cust/p_' || CAST(o_custkey % 100 AS STRING) AS repo_url FROM {orders}""",
    "probe_log": """
        SELECT 'https://host.example/cust/p_' || CAST(user_id AS STRING) AS url, ts AS probed_at,
               CASE WHEN event_type = 'error' THEN 404 WHEN event_type = 'click' THEN 200 WHEN event_type = 'view' THEN 302
                    WHEN event_type = 'signup' THEN 429 ELSE 301 END AS status,
               CASE WHEN event_id % 2 = 0 THEN 'https://gitlab.com/users/sign_in'
                    WHEN event_id % 3 = 0 THEN 'https://gitlab.com/new/home' END AS location
        FROM {events}""",
    "lines": """
        SELECT CAST(l_orderkey AS STRING) AS file_change_id, l_suppkey % 2 = 0 AS before_change,
               CAST(5 * l_linenumber + l_partkey % 400 AS INT) AS line
        FROM {lineitem}
        UNION ALL
        SELECT CAST(l_orderkey AS STRING), l_suppkey % 2 = 1, CAST(64 * l_linenumber AS INT) FROM {lineitem}""",
    "spans": """
        SELECT CAST(l_orderkey AS STRING) AS file_change_id, l_suppkey % 3 = 0 AS before_change,
               CASE WHEN l_suppkey % 13 = 0 THEN '(anonymous)' ELSE 'm' || CAST(l_linenumber AS STRING) END AS name,
               CAST(5 * l_linenumber + 40 * (l_partkey % 10) AS INT) AS start_line,
               CAST(5 * l_linenumber + 40 * (l_partkey % 10) + l_suppkey % 200 AS INT) AS end_line
        FROM {lineitem}""",
    "nodes": """
        SELECT p_partkey - 5 AS id, p_brand || ' weakness' AS name, p_name AS description,
               p_type || ' long text' AS extended_description, false AS is_category FROM {part}
        UNION ALL
        SELECT s_suppkey * 3, s_name, 'summary of ' || s_name, '', true FROM {supplier}""",
    "meta": """
        SELECT 'https://github.com/o/c' || CAST(c_custkey AS STRING) AS repo_url, c_name AS repo_name,
               CAST(round(abs(c_acctbal)) AS INT) AS stars_count
        FROM {customer} WHERE c_custkey % 4 <> 0""",
    "hosted": """
        SELECT CASE WHEN o_custkey % 3 = 0 THEN 'https://github.com/o/c' ELSE 'https://gitlab.com/o/c' END ||
               CAST(o_custkey AS STRING) AS repo_url FROM {orders}""",
    "link_urls": """
        SELECT CAST(l_partkey AS STRING) AS cve_id,
               CASE WHEN l_orderkey % 2 = 0 THEN 'http' ELSE 'https' END || '://' ||
               CASE WHEN l_orderkey % 5 = 0 THEN 'www.' ELSE '' END ||
               CASE WHEN l_suppkey % 3 = 0 THEN 'github.com' WHEN l_suppkey % 3 = 1 THEN 'gitlab.com'
                    ELSE 'bitbucket.org' END ||
               '/o' || CAST(l_suppkey AS STRING) || '/p' || CAST(l_suppkey % 4 AS STRING) ||
               CASE WHEN l_orderkey % 7 = 0 THEN '/-' ELSE '' END ||
               CASE WHEN l_orderkey % 3 = 0 THEN '/commits/' ELSE '/commit/' END ||
               md5(CAST(l_orderkey AS STRING)) || CASE WHEN l_orderkey % 4 = 0 THEN '#diff-1' ELSE '' END ||
               CASE WHEN l_orderkey % 31 = 0 THEN '#https://github.com/later/repo/commit/ab'
                    WHEN l_orderkey % 37 = 0 THEN 'https://github.com/later/repo/commit/ab' ELSE '' END AS url
        FROM {lineitem}""",
}


def _needs(text: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", text)


class Testbed(Mapping):
    """Driver tables and views of one folder by name, each read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        if name in VIEWS:
            text = VIEWS[name]
            return self.spark.sql(text, **{need: self[need] for need in dict.fromkeys(_needs(text))})
        if name in DRIVER_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        raise KeyError(name)

    def __iter__(self) -> Iterator[str]:
        return iter((*DRIVER_TABLES, *VIEWS))

    def __len__(self) -> int:
        return len(DRIVER_TABLES) + len(VIEWS)


def tables(spark: SparkSession, sf_dir: str) -> Testbed:
    """The eight tables, and all other views, on the driver tables of a folder."""
    return Testbed(spark, sf_dir)


def with_views(sql: str) -> str:
    """Oracle SQL with ``{view}`` names → SQL on the driver tables alone."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for need in _needs(VIEWS[name]):
                visit(need)
            ordered.append(name)

    for name in _needs(sql):
        visit(name)

    def plain(text: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", text)

    clauses = [f"{name} AS ({plain(VIEWS[name]).strip()})" for name in ordered]
    body = plain(sql).strip()
    if not clauses:
        return body
    prefix = ",\n".join(clauses)
    if body.upper().startswith("WITH "):
        return f"WITH {prefix},\n{body[5:]}"
    return f"WITH {prefix}\n{body}"
