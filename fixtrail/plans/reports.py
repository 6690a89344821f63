"""The five CSV reports on a built dataset.

Run it as a job: ``python -m fixtrail.plans.reports --tables hdfs:///data/fixes --output hdfs:///out/reports``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import last_segment
from ..operators.shaping import replace_all_strings
from ..session import build_session, drop_scratch
from ..sources.tables import load_tables, write_report
from . import analytics

Tables = Mapping[str, DataFrame]
TOP = 10


def project_ranking(t: Tables, limit: int = TOP) -> DataFrame:
    """A7 without its numbers: the projects with most commits, files and methods side by side."""
    return analytics.ranked_columns(t).where(F.col("rank") <= limit).orderBy("rank").drop("rank")


def advisory_counts(t: Tables, limit: int = TOP) -> DataFrame:
    """A8 of the first projects, with short names and dashes."""
    top = analytics.cve_cwe_per_project(t).orderBy(F.desc("cve_count"), "projects").limit(limit)
    return replace_all_strings(top.withColumn("projects", last_segment(F.col("projects"))), {"_": "-"})


def weakness_counts(t: Tables, limit: int = TOP) -> DataFrame:
    """A9 of the first weaknesses without methods; descriptions lose quotes and commas."""
    top = analytics.weakness_summary(t).orderBy(F.desc("cve_count"), "CWE").limit(limit)
    plain = F.regexp_replace("description", "[\"',]", "")
    return top.select("CWE", plain.alias("description"), "cve_count", "commit_count", "file_count")


# The names of the reports. Each has its rows, their order and how many there are at most, if there is a limit.
REPORTS: dict[str, tuple[Callable[[Tables], DataFrame], Sequence[str], int | None]] = {
    "vul_projects_10": (project_ranking, ["commit_count DESC", "file_count DESC", "method_count DESC"], TOP),
    "dataset_summary_cve_cwe": (advisory_counts, ["cve_count DESC", "projects"], TOP),
    "cwe_summary": (weakness_counts, ["cve_count DESC", "CWE"], TOP),
    "dataset_summary": (analytics.dataset_summary, [], 1),
    # One row per project; a report of all of them is what is asked for, in as many files as it takes.
    "severity_summary": (analytics.severity_summary, ["cve_count DESC", "projects"], None),
}


def write_reports(t: Tables, target: str) -> None:
    """Write all reports as CSV files below ``target``."""
    for name, (build, order, limit) in REPORTS.items():
        write_report(build(t), f"{target}/{name}", [F.expr(o.removesuffix(" DESC")).desc() if o.endswith(" DESC")
                                                   else F.col(o) for o in order], limit)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write the five reports on a built dataset.")
    parser.add_argument("--tables", required=True, help="folder of the eight tables")
    parser.add_argument("--output", required=True, help="folder of the reports")
    given = parser.parse_args(arguments)
    spark = build_session("fixtrail-reports")
    write_reports(load_tables(spark, given.tables), given.output)
    drop_scratch(spark)


if __name__ == "__main__":
    main()
