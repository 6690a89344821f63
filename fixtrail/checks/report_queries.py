"""The five reports on the driver tables; their oracles build on those of the questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import analytics, reports
from .registry import ORACLES, QUERIES, register
from .testbed import tables

NAME = "replace(list_extract(string_split(projects, '/'), -1), '_', '-')"


def _of(question: str) -> str:
    return f"({ORACLES[question]})"


@register("r1_vul_projects", f"SELECT * EXCLUDE (rank) FROM {_of('a7_ranked_columns')} WHERE rank <= 10")
def r1(spark, sf_dir):
    return reports.project_ranking(tables(spark, sf_dir))


@register("r2_summary_cve_cwe", f"""
    SELECT {NAME} AS projects, cve_count, cwe_count
    FROM (SELECT * FROM {_of('a8_cve_cwe_per_project')} ORDER BY cve_count DESC, projects LIMIT 10)""")
def r2(spark, sf_dir):
    return reports.advisory_counts(tables(spark, sf_dir))


@register("r3_cwe_summary", f"""
    SELECT CWE, regexp_replace(description, '["'',]', '', 'g') AS description, cve_count, commit_count, file_count
    FROM {_of('a9_weakness_summary')} ORDER BY cve_count DESC, CWE LIMIT 10""")
def r3(spark, sf_dir):
    return reports.weakness_counts(tables(spark, sf_dir))
