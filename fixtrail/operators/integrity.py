"""Pruning to a referentially whole dataset, and checks on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import canonical_repo, owner_of
from ..session import materialise
from .linking import resolve_short_hashes

Tables = Mapping[str, DataFrame]

# Fixed value: text of placeholder repository rows.
PLACEHOLDER = "visit repo url"


def keep_linked(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; the keys are made distinct before they are shuffled.

    A semi join would be moved below a union, whose rows then lose their layout by key.
    """
    return df.join(keys.select(key).distinct(), key).select(*df.columns)


def drop_non_textual(files: DataFrame) -> DataFrame:
    """Remove files with no added and no deleted line; unknown counts stay."""
    empty = (F.col("num_lines_added") == 0) & (F.col("num_lines_deleted") == 0)
    return files.where(~F.coalesce(empty, F.lit(False)))


def drop_unnamed(methods: DataFrame) -> DataFrame:
    """Remove methods with an empty name."""
    return methods.where(F.coalesce(F.col("name"), F.lit("?")) != "")


def fill_missing_repos(fixes: DataFrame, repos: DataFrame) -> DataFrame:
    """Add a placeholder row for each linked repository without a row.

    Text columns carry the placeholder text; dates and counts are NULL.
    """
    absent = (
        fixes.select("repo_url").where(F.contains("repo_url", F.lit("/"))).distinct()
        .join(repos.select("repo_url").distinct(), "repo_url", "left_anti")
    )
    values = []
    for field in repos.schema.fields:
        if field.name == "repo_url":
            value = F.col("repo_url")
        elif field.name == "owner":
            value = owner_of(F.col("repo_url"))
        else:
            value = F.lit(PLACEHOLDER if isinstance(field.dataType, T.StringType) else None).cast(field.dataType)
        values.append(value.alias(field.name))
    return repos.unionByName(absent.select(*values))


def prune(tables: Tables, keep_orphans: bool = False, first_git_mark: bool = False,
          resolve: bool = True, materialise_links: bool = False, stored: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight tables cut down to rows that hang together.

    ``keep_orphans`` keeps methods of files dropped as non-textual and
    ``first_git_mark`` cuts addresses at the first ``.git``, as the stored
    dataset has it (Q4, Q6). ``materialise_links`` checkpoints the pruned links,
    which all other tables depend on; use it when all eight are written. ``stored`` are commits of an earlier run that was
    pruned; fixes may name them too, they are not among the result.
    """
    commits = tables["commits"]
    commits = commits.withColumn("repo_url", canonical_repo(F.col("repo_url"), first_git_mark))
    fixes = tables["fixes"]
    known = commits.select("repo_url", "hash")
    if stored is not None:
        known = known.unionByName(stored.select("repo_url", "hash"))
    if resolve:
        fixes = resolve_short_hashes(fixes, known)
    fixes = keep_linked(fixes, known, "hash")
    if materialise_links:
        fixes = materialise(fixes)
    # The pruned fixes name loaded commits only, so they are the key set of both sides.
    # Rows are made distinct after the join by hash, whose layout serves that too.
    commits = keep_linked(commits, fixes, "hash").distinct()
    textual = drop_non_textual(tables["file_change"])
    files = keep_linked(textual, fixes, "hash")
    methods = drop_unnamed(tables["method_change"])
    if keep_orphans:
        removed = textual.join(fixes.select("hash").distinct(), "hash", "left_anti").select("file_change_id")
        methods = methods.join(removed.distinct(), "file_change_id", "left_anti").select(*methods.columns)
    else:
        methods = keep_linked(methods, files, "file_change_id")
    cve = keep_linked(tables["cve"], fixes, "cve_id")
    classification = keep_linked(tables["cwe_classification"], cve, "cve_id")
    repos = fill_missing_repos(fixes, tables["repository"].distinct())
    return {
        "fixes": fixes,
        "commits": commits,
        "file_change": files,
        "method_change": methods,
        "cve": cve,
        "cwe_classification": classification,
        "cwe": keep_linked(tables["cwe"], classification, "cwe_id"),
        "repository": keep_linked(repos, fixes, "repo_url"),
    }


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P5: keys that occur more than once, with their number of rows; empty if the key holds."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys of the child that the parent lacks, with their number of rows; empty if the key holds."""
    used = child.groupBy(key).agg(F.count("*").alias("row_count"))
    return used.join(parent.select(key).distinct(), key, "left_anti").select(key, "row_count")


# Rule name, left (table, column), right (table, column), relation of the distinct counts.
COUNT_RULES = (
    ("cve_fixes", ("cve", "cve_id"), ("fixes", "cve_id"), "="),
    ("commits_fixes", ("commits", "hash"), ("fixes", "hash"), "="),
    ("cve_classification", ("cve", "cve_id"), ("cwe_classification", "cve_id"), "="),
    ("cwe_classification", ("cwe", "cwe_id"), ("cwe_classification", "cwe_id"), "="),
    ("repository_fixes", ("repository", "repo_url"), ("fixes", "repo_url"), "="),
    ("commits_files", ("commits", "hash"), ("file_change", "hash"), ">="),
    ("files_methods", ("file_change", "file_change_id"), ("method_change", "file_change_id"), ">="),
)


def check_counts(tables: Tables) -> DataFrame:
    """One row per rule (rule, left_count, right_count, holds); the last rule is that no file is non-textual."""
    # One pass over each table but files counts all its keys; the rules then compare numbers of one row.
    wanted: dict[str, list[str]] = {}
    for _, *sides, _ in COUNT_RULES:
        for table, column in sides:
            if column not in wanted.setdefault(table, []):
                wanted[table].append(column)
    counts, places = [], {}
    for table, columns in wanted.items():
        # Files have two wide keys: counted in one pass, every row would be shuffled once per key with all counted columns.
        for some in ([column] for column in columns) if table == "file_change" else (columns,):
            rows, measures = tables[table], [F.count_distinct(column).alias(column) for column in some]
            if (table, some) == ("file_change", ["hash"]):
                measures.append(F.count_if((F.col("num_lines_added") == 0) & (F.col("num_lines_deleted") == 0)).alias("empty"))
            elif len(some) == 1:
                rows = rows.where(F.col(some[0]).isNotNull())
            place = f"{table}_{some[0]}"
            counts.append(rows.agg(F.struct(*measures)).scalar().alias(place))
            places.update({(table, column): F.col(place)[column] for column in some})
    known = tables["fixes"].sparkSession.range(1).select(*counts)

    def rule(name: str, left: Column, right: Column, holds: Column) -> Column:
        return F.struct(F.lit(name).alias("rule"), left.alias("left_count"), right.alias("right_count"), holds.alias("holds"))

    rules = []
    for name, left, right, relation in COUNT_RULES:
        one, other = places[left], places[right]
        rules.append(rule(name, one, other, one >= other if relation == ">=" else one == other))
    empty = F.col("file_change_hash.empty")
    rules.append(rule("textual_files", empty, F.lit(0).cast("bigint"), empty == 0))
    return known.select(F.explode(F.array(*rules)).alias("r")).select("r.*")


def table_counts(tables: Tables) -> DataFrame:
    """(measure, row_count) for commits, files, methods and vulnerable methods."""
    methods = tables["method_change"].agg(
        F.count("*").alias("methods"), F.count_if("before_change").alias("vulnerable_methods")
    ).unpivot([], ["methods", "vulnerable_methods"], "measure", "row_count")
    rows = methods
    for measure, table in (("commits", "commits"), ("files", "file_change")):
        counted = tables[table].agg(F.count("*").alias("row_count"))
        rows = rows.unionByName(counted.withColumn("measure", F.lit(measure)))
    return rows


def verify_catalog(weaknesses: DataFrame) -> None:
    """Raise ``ValueError`` if the weakness table has no rows or a key twice."""
    repeated = weaknesses.groupBy("cwe_id").count().where("count > 1 OR cwe_id IS NULL")
    if weaknesses.isEmpty() or not repeated.isEmpty():
        raise ValueError("cwe_id is not unique, or there are no weaknesses")


def verify(tables: Tables) -> None:
    """Raise ``ValueError`` if a primary key, the weakness reference or a count rule (P5-P7) does not hold."""
    problems = {
        "cve_id is not unique in cve": check_unique(tables["cve"], ["cve_id"]),
        "cwe_id is not unique in cwe": check_unique(tables["cwe"], ["cwe_id"]),
        "cwe_classification has repeated rows": check_unique(tables["cwe_classification"], ["cve_id", "cwe_id"]),
        "cwe_classification names weaknesses that cwe lacks":
            check_foreign_key(tables["cwe_classification"], tables["cwe"], "cwe_id"),
        "count rules do not hold": check_counts(tables).where("NOT holds"),
    }
    # A few examples of each are enough for the message.
    found = {problem: rows for problem, df in problems.items() if (rows := df.limit(5).collect())}
    if found:
        raise ValueError("; ".join(f"{problem}, such as {[tuple(row) for row in rows]}" for problem, rows in found.items()))
