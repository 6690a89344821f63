"""Questions on the eight tables.

Counts over joins are taken before the joins: each side is folded to one row per
key with its number of rows, and the numbers are multiplied. The result equals
that of counting joined rows, while a key that holds a large part of one table
is one row when it is joined. ``t`` maps table names to DataFrames throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import last_segment
from ..functions.text import days_between, decode, mean_above_zero, mean_as_stored, stored_number
from ..operators.shaping import fill_null, replace_all_strings, round_all
from ..ranking import running_total
from ..session import materialise, spread

Tables = Mapping[str, DataFrame]

SCORES = ("cvss3_base_score", "cvss2_base_score", "exploitability_score", "impact_score")
MEAN_NAMES = {
    "cvss3_base_score": "avg_cvss_v3_score",
    "cvss2_base_score": "avg_cvss_v2_score",
    "exploitability_score": "avg_exploitability_score",
    "impact_score": "avg_impact_score",
}
UNITS = ("unit_size", "unit_complexity", "unit_interfacing")
COUNTS = ("commit_count", "file_count", "method_count")
UNKNOWN_LANGUAGE = "unknown"


# ---- methods, files and projects ------------------------------------------------------------------------------------

def methods_by_language(t: Tables, language: str) -> DataFrame:
    """A1: the methods of files in one language."""
    files = t["file_change"].where(F.col("programming_language") == language)
    return (
        t["method_change"].join(files.select("file_change_id", "programming_language"), "file_change_id")
        .select("name", "signature", "nloc", "parameters", "token_count", "code", "before_change",
                "programming_language")
    )


def small_fixes(t: Tables, max_added: int = 1, max_deleted: int = 1, language: str | None = None) -> DataFrame:
    """A2: file changes of few lines with their advisory and weakness.

    The narrow links are joined first; the source texts are shuffled once, in the last join.
    """
    files = t["file_change"].where((F.col("num_lines_added") <= max_added) & (F.col("num_lines_deleted") <= max_deleted))
    if language is not None:
        files = files.where(F.col("programming_language") == language)
    hashes = files.select("hash").distinct()
    links = (
        t["fixes"].select("cve_id", "hash").join(hashes, "hash", "left_semi")
        .join(t["cve"].select("cve_id"), "cve_id")
        .join(t["cwe_classification"].select("cve_id", "cwe_id"), "cve_id")
        .join(t["commits"].select("hash"), "hash")
    )
    return files.join(links, "hash").select(
        "cve_id", "filename", "num_lines_added", "num_lines_deleted", "code_before", "code_after", "cwe_id"
    )


def _links(t: Tables) -> DataFrame:
    """(repo_url, hash, links): number of fix × commit rows behind each pair."""
    fixes = t["fixes"].groupBy("repo_url", "hash").agg(F.count("*").alias("_fixes"))
    commits = t["commits"].groupBy("hash").agg(F.count("*").alias("_commits"))
    return fixes.join(commits, "hash").select("repo_url", "hash", (F.col("_fixes") * F.col("_commits")).alias("links"))


def _files_per_commit(t: Tables) -> DataFrame:
    return t["file_change"].groupBy("hash").agg(F.count("file_change_id").alias("_files"))


def _methods_per_commit(t: Tables) -> DataFrame:
    methods = t["method_change"].groupBy("file_change_id").agg(F.count("method_change_id").alias("_methods"))
    return (
        t["file_change"].select("file_change_id", "hash").join(methods, "file_change_id")
        .groupBy("hash").agg(F.sum("_methods").alias("_methods"))
    )


def _ranked(df: DataFrame, count: str, name: str) -> DataFrame:
    return df.orderBy(F.desc(count), name)


def commit_count(t: Tables) -> DataFrame:
    """A3: fix commits per project, most first."""
    counted = _links(t).groupBy(F.col("repo_url").alias("commit_project")).agg(F.sum("links").alias("commit_count"))
    return _ranked(counted, "commit_count", "commit_project")


def file_count(t: Tables) -> DataFrame:
    """A4: changed files per project, most first."""
    counted = (
        _links(t).join(_files_per_commit(t), "hash")
        .groupBy(F.col("repo_url").alias("file_project")).agg(F.sum(F.col("links") * F.col("_files")).alias("file_count"))
    )
    return _ranked(counted, "file_count", "file_project")


def method_count(t: Tables) -> DataFrame:
    """A5: changed methods per project, most first."""
    counted = (
        _links(t).join(_methods_per_commit(t), "hash")
        .groupBy(F.col("repo_url").alias("method_project"))
        .agg(F.sum(F.col("links") * F.col("_methods")).alias("method_count"))
    )
    return _ranked(counted, "method_count", "method_project")


def project_counts(t: Tables) -> DataFrame:
    """A3, A4 and A5 in one pass: (repo_url, commit_count, file_count, method_count), 0 where a project has none."""
    joined = _links(t).join(_files_per_commit(t), "hash", "left").join(_methods_per_commit(t), "hash", "left")
    return joined.groupBy("repo_url").agg(
        F.sum("links").alias("commit_count"),
        F.coalesce(F.sum(F.col("links") * F.col("_files")), F.lit(0)).alias("file_count"),
        F.coalesce(F.sum(F.col("links") * F.col("_methods")), F.lit(0)).alias("method_count"),
    )


def project_totals(t: Tables, limit: int = 10) -> DataFrame:
    """Projects with commits, files and methods, by these counts, short names."""
    whole = project_counts(t).where("file_count > 0 AND method_count > 0")
    top = whole.orderBy(*[F.desc(count) for count in COUNTS], "repo_url").limit(limit)
    return fill_null(top.select(last_segment(F.col("repo_url")).alias("commit_project"), *COUNTS), COUNTS)


def ranked_columns(t: Tables) -> DataFrame:
    """The project rankings by commits, files and methods side by side, by rank.

    Shorter rankings end in NULL names and count 0.
    """
    rows = project_counts(t).unpivot(["repo_url"], list(COUNTS), "kind", "amount").where("amount > 0")
    ranked = running_total(rows, [F.desc("amount"), F.col("repo_url")], "rank", group=["kind"])
    columns = []
    for count in COUNTS:
        mine = F.col("kind") == count
        project = count.replace("_count", "_project")
        columns.append(F.max(F.when(mine, last_segment(F.col("repo_url")))).alias(project))
        columns.append(F.max(F.when(mine, F.col("amount"))).alias(count))
    side_by_side = ranked.groupBy("rank").agg(*columns)
    return replace_all_strings(fill_null(side_by_side, COUNTS), {"_": "-"})


def cve_cwe_per_project(t: Tables) -> DataFrame:
    """Distinct advisories and weaknesses per project, most advisories first.

    One of an advisory's weaknesses is marked, so that one pass over the pairs counts both.
    """
    return _count_advisories(t, t["fixes"])


def _count_advisories(t: Tables, fixes: DataFrame) -> DataFrame:
    """A8 from the links."""
    pairs = spread(fixes.select("repo_url", "cve_id").where("cve_id IS NOT NULL"), "cve_id").distinct()
    first = F.row_number().over(Window.partitionBy("cve_id").orderBy("cwe_id")) == 1
    classes = (
        t["cwe_classification"].select("cve_id", "cwe_id").distinct()
        .join(t["cve"].select("cve_id").distinct(), "cve_id", "left_semi")
        .withColumn("_first", first.cast("bigint"))
    )
    counted = (
        pairs.join(classes, "cve_id").groupBy(F.col("repo_url").alias("projects"), "cwe_id")
        .agg(F.sum("_first").alias("_firsts"))
        .groupBy("projects").agg(F.sum("_firsts").alias("cve_count"), F.count("cwe_id").alias("cwe_count"))
    )
    return _ranked(counted, "cve_count", "projects")


def weakness_summary(t: Tables) -> DataFrame:
    """Per weakness the distinct advisories, commits, files and methods, most advisories first.

    Files and methods are counted per commit before any fan-out and summed over
    each weakness's distinct commits; a file belongs to one commit and a method
    to one file, so the sums are the distinct counts. Commits without files count.
    """
    files = spread(t["file_change"].select("hash", "file_change_id"), "file_change_id").distinct()
    named = t["method_change"].select("file_change_id", "method_change_id").where("file_change_id IS NOT NULL")
    methods = (
        spread(named, "file_change_id").distinct()
        .groupBy("file_change_id").agg(F.count("method_change_id").alias("_methods"))
    )
    per_commit = files.join(methods, "file_change_id", "left").groupBy("hash").agg(
        F.count("file_change_id").alias("_files"), F.sum("_methods").alias("_methods")
    )
    return _count_weaknesses(t, t["fixes"], t["commits"].select("hash").distinct(), per_commit)


def _count_weaknesses(t: Tables, fixes: DataFrame, loaded: DataFrame, per_commit: DataFrame) -> DataFrame:
    """A9 from the links, the distinct hashes of the commits and ``per_commit`` (hash, _files, _methods)."""
    links = spread(
        spread(fixes.select("cve_id", "hash").where("cve_id IS NOT NULL AND hash IS NOT NULL"), "hash").distinct()
        .join(loaded, "hash", "left_semi"), "cve_id"
    ).join(t["cve"].select("cve_id").distinct(), "cve_id", "left_semi")
    classes = t["cwe_classification"].select("cve_id", "cwe_id").distinct()
    # One of an advisory's links is marked: the marks of a weakness add up to its advisories.
    first = F.row_number().over(Window.partitionBy("cve_id").orderBy("cve_id")) == 1
    reached = classes.join(links.withColumn("_first", first.cast("bigint")), "cve_id").select("cwe_id", "hash", "_first")
    # Laid out by commit once, for the grouping and for the join.
    commits = spread(reached, "hash").groupBy("cwe_id", "hash").agg(F.sum("_first").alias("_firsts"))
    counted = commits.join(per_commit, "hash", "left").groupBy("cwe_id").agg(
        F.sum("_firsts").alias("cve_count"), F.count("*").alias("commit_count"),
        F.coalesce(F.sum("_files"), F.lit(0)).alias("file_count"),
        F.coalesce(F.sum("_methods"), F.lit(0)).alias("method_count"),
    )
    names = t["cwe"].select("cwe_id", F.col("cwe_name").alias("description"))
    summary = counted.join(names, "cwe_id").select(
        F.col("cwe_id").alias("CWE"), "description", "cve_count", *COUNTS
    )
    return _ranked(summary, "cve_count", "CWE")


def _top_sum(df: DataFrame, count: str, name: str, limit: int) -> DataFrame:
    return df.orderBy(F.desc(count), name).limit(limit).agg(F.sum(count).alias("_sum"))


def _top_sums(projects: DataFrame, limit: int) -> DataFrame:
    """One row with the sum of the ``limit`` greatest values of each count.

    The rank limit is applied in every task before the shuffle, so that a window
    sees ``limit`` rows per task.
    """
    rows = projects.unpivot(["repo_url"], list(COUNTS), "kind", "amount")
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("amount"), "repo_url"))
    top = rows.withColumn("_rank", rank).where(F.col("_rank") <= limit)
    return top.agg(*[F.sum(F.when(F.col("kind") == count, F.col("amount"))).alias(count) for count in COUNTS])


def _share(part: Column, whole: Column) -> Column:
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, 6)


def commit_fold(t: Tables) -> DataFrame:
    """One row per hash of commits or files: numbers of commit, file and method rows, and of distinct files and methods.

    (hash, commits, files, methods, file_ids, method_ids); files and methods without an id are not counted.
    """
    def rows_with(key: str) -> Column:
        return F.sum(F.when(F.col(key).isNotNull(), F.col("_rows")))

    named = t["method_change"].select("file_change_id", "method_change_id").where("file_change_id IS NOT NULL")
    methods = (
        spread(named, "file_change_id").groupBy("file_change_id", "method_change_id").agg(F.count("*").alias("_rows"))
        .groupBy("file_change_id").agg(rows_with("method_change_id").alias("_methods"),
                                       F.count("method_change_id").alias("_method_ids"))
    )
    files = spread(t["file_change"].select("file_change_id", "hash"), "file_change_id") \
        .groupBy("file_change_id", "hash").agg(F.count("*").alias("_rows"))
    per_file = files.join(methods, "file_change_id", "left").groupBy("hash").agg(
        rows_with("file_change_id").alias("files"), F.sum(F.col("_rows") * F.col("_methods")).alias("methods"),
        F.count("file_change_id").alias("file_ids"), F.sum("_method_ids").alias("method_ids"),
    )
    commits = t["commits"].groupBy("hash").agg(F.count("*").alias("commits"))
    both = commits.unionByName(per_file, allowMissingColumns=True)
    names = ("commits", "files", "methods", "file_ids", "method_ids")
    return both.groupBy("hash").agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])


def top_share(t: Tables, limit: int = 10) -> DataFrame:
    """A10: percent of advisories, commits, files and methods held by the top projects and the top weaknesses.

    Commits, files and methods are folded once to a row per commit, and links to a row each, both written while the
    plan is built; projects (written too), weaknesses and the number of commits are taken from these tables.
    """
    fold = materialise(commit_fold(t))
    links = materialise(t["fixes"].groupBy("cve_id", "hash", "repo_url").agg(F.count("*").alias("_fixes")))
    loaded = fold.where("commits > 0 AND hash IS NOT NULL")
    weaknesses = _count_weaknesses(t, links, loaded.select("hash"), loaded.select(
        "hash", F.col("file_ids").alias("_files"), F.col("method_ids").alias("_methods")))
    hashed = spread(links.select("repo_url", "hash", "_fixes").where("hash IS NOT NULL"), "hash")
    fixes = hashed.groupBy("repo_url", "hash").agg(F.sum("_fixes").alias("_fixes"))
    projects = materialise(fixes.join(loaded, "hash").groupBy("repo_url").agg(*[
        F.sum(F.col("_fixes") * F.col("commits") * rows).alias(count)
        for count, rows in zip(COUNTS, (F.lit(1), F.col("files"), F.col("methods")))]))

    def scalar(df: DataFrame) -> Column:
        return df.scalar()

    def sizes(table: str, key: str) -> Column:
        return scalar(t[table].agg(F.struct(F.count_distinct(key).alias("ids"), F.count(key).alias("rows"))))

    top_weaknesses = weaknesses.orderBy(F.desc("cve_count"), "CWE").limit(limit)
    weak = scalar(top_weaknesses.agg(F.struct(*[F.sum(c).alias(c) for c in ("cve_count", *COUNTS)])))
    spark = t["fixes"].sparkSession
    parts = spark.range(1).select(
        _top_sum(_count_advisories(t, links), "cve_count", "projects", limit).scalar().alias("_p_cve"),
        scalar(_top_sums(projects, limit).select(F.struct(*COUNTS))).alias("_p"),
        weak.alias("_w"),
        sizes("cve", "cve_id").alias("_cve"),
        sizes("file_change", "file_change_id").alias("_file"),
        sizes("method_change", "method_change_id").alias("_method"),
        scalar(projects.agg(F.sum("commit_count"))).alias("_linked"),
        scalar(fold.agg(F.sum("commits"))).alias("_commits"),
    )
    c = F.col
    return parts.select(
        _share(c("_p_cve"), c("_cve.ids")).alias("project_cve_percent"),
        _share(c("_p.commit_count"), c("_linked")).alias("project_commit_percent"),
        _share(c("_p.file_count"), c("_file.ids")).alias("project_file_percent"),
        _share(c("_p.method_count"), c("_method.ids")).alias("project_method_percent"),
        _share(c("_w.cve_count"), c("_cve.rows")).alias("cwe_cve_percent"),
        _share(c("_w.commit_count"), c("_commits")).alias("cwe_commit_percent"),
        _share(c("_w.file_count"), c("_file.rows")).alias("cwe_file_percent"),
        _share(c("_w.method_count"), c("_method.rows")).alias("cwe_method_percent"),
    )


def dataset_summary(t: Tables) -> DataFrame:
    """One row with the size of the dataset at each level."""
    linked = (
        t["fixes"].select("cve_id", "hash").distinct()
        .join(t["commits"].select("hash").distinct(), "hash", "left_semi")
        .select("cve_id").distinct()
        .join(t["cve"].select("cve_id").distinct(), "cve_id", "left_semi")
    )
    weaknesses = (
        t["cwe_classification"].select("cve_id", "cwe_id").distinct()
        .join(linked, "cve_id", "left_semi").select("cwe_id").distinct()
        .join(t["cwe"].select("cwe_id").distinct(), "cwe_id", "left_semi")
    )
    projects = (
        t["fixes"].select("repo_url", "hash").distinct()
        .join(t["commits"].select("hash").distinct(), "hash", "left_semi").select("repo_url").distinct()
    )
    known = F.when(F.col("programming_language") != UNKNOWN_LANGUAGE, F.col("programming_language"))

    def value(df: DataFrame, measure: Column, name: str) -> Column:
        return df.agg(measure).scalar().alias(name)

    return t["fixes"].sparkSession.range(1).select(
        value(t["fixes"], F.count_distinct("cve_id"), "cves"),
        value(weaknesses, F.count("*"), "cwes"),
        value(projects, F.count("repo_url"), "projects"),
        value(t["commits"], F.count_distinct("hash"), "commits"),
        value(t["file_change"], F.count_distinct("file_change_id"), "files"),
        value(t["method_change"], F.count("method_change_id"), "methods"),
        value(t["cve"], F.count_distinct("cve_id"), "registered_cves"),
        value(t["fixes"], F.count_distinct("hash"), "registered_commits"),
        value(t["fixes"], F.count_distinct("repo_url"), "registered_projects"),
        value(t["fixes"], F.count("*"), "links"),
        value(t["file_change"], F.count_distinct(known), "languages"),
    )


# ---- scores ---------------------------------------------------------------------------------------------------------

def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _number(df: DataFrame, name: str) -> Column:
    """A measure as double, whether stored as text or as number."""
    return decode(F.col(name)).try_cast("double") if _is_text(df, name) else F.col(name).cast("double")


def _stored_text(df: DataFrame, name: str) -> Column:
    """A measure as the stored text, a typed NULL being the text of a missing value."""
    return F.col(name) if _is_text(df, name) else F.coalesce(F.col(name).cast("string"), F.lit("None"))


def score_frame(t: Tables) -> DataFrame:
    """The four scores of advisories that have a version-3 score."""
    cve = t["cve"]
    return cve.select(*[_number(cve, name).alias(name) for name in SCORES]).dropna(subset=[SCORES[0]])


def box_stats(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Per measure the count, quartiles, whiskers at 1.5 times their distance, and number of outliers.

    Exact: equal values are folded, running counts over the sorted values locate
    the ranks that the quartiles lie between. No task holds all values of a measure.
    """
    values = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "measure", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("measure", "value").agg(F.count("*").alias("_n"))
    )
    summed = running_total(values, ["value"], "_upto", group=["measure"], weight="_n")
    # All further steps read the folded, materialised values, not the source again.
    totals = summed.groupBy("measure").agg(F.sum("_n").alias("_total"))
    placed = summed.join(F.broadcast(totals), "measure")  # one row per measure

    def at(rank: Column) -> Column:
        here = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
        return F.max(F.when(here, F.col("value")))

    def quartile(share: float) -> Column:
        place = (F.max("_total") - 1) * share
        row_place = (F.col("_total") - 1) * share
        low, high = at(F.floor(row_place)), at(F.ceil(row_place))
        return low + (high - low) * (place - F.floor(place))

    boxes = placed.groupBy("measure").agg(
        F.max("_total").alias("n"),
        quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    whole = summed.join(F.broadcast(boxes), "measure")  # one row per measure
    return whole.groupBy("measure", "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"),
    ).select(
        "measure", "n",
        *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        "outliers",
    )


def density(df: DataFrame, columns: Sequence[str], low: float, high: float, bins: int) -> DataFrame:
    """(measure, bin, amount), the number of values in each of ``bins`` equal parts of low … high.

    Bin 0 is below ``low``; ``high`` itself belongs to the last bin, values above it to bin ``bins`` + 1.
    """
    value = F.col("value")
    bucket = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins))
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], list(columns), "measure", "value")
        .where(value.isNotNull() & ~F.isnan("value"))
        .groupBy("measure", F.when(value == high, F.lit(bins).cast("bigint")).otherwise(bucket).alias("bin"))
        .agg(F.count("*").alias("amount"))
    )


def project_scores(t: Tables, digits: int = 2) -> DataFrame:
    """Advisories and four mean scores per project, most advisories first.

    Zeros and missing scores are left out; ``…_as_stored`` are the means over stored text, where both count as 0 (Q1).
    """
    cve = t["cve"]
    numbers = cve.select(
        "cve_id", *[_number(cve, s).alias(s) for s in SCORES], *[_stored_text(cve, s).alias(f"_{s}") for s in SCORES]
    )
    linked = spread(t["fixes"].select("repo_url", "cve_id").where("cve_id IS NOT NULL"), "cve_id")
    links = linked.groupBy("repo_url", "cve_id").agg(F.count("*").alias("_n"))
    n = F.col("_n")
    means = [F.round(mean_above_zero(F.col(s), n), digits).alias(MEAN_NAMES[s]) for s in SCORES]
    stored = [F.round(mean_as_stored(F.col(f"_{s}"), n), digits).alias(f"{MEAN_NAMES[s]}_as_stored") for s in SCORES]
    scored = links.join(numbers, "cve_id").groupBy(F.col("repo_url").alias("projects")).agg(
        F.sum("_n").alias("cve_count"), *means, *stored
    )
    return _ranked(scored, "cve_count", "projects")


def days_to_fix(t: Tables, digits: int = 3) -> DataFrame:
    """Mean, median, longest and shortest days between publication and fix per project.

    Equal day counts of a project are folded first, so a project's median works on
    as many numbers as there are different day counts.
    """
    linked = t["fixes"].select("repo_url", "cve_id", "hash").where("cve_id IS NOT NULL AND hash IS NOT NULL")
    links = spread(linked, "cve_id").groupBy("repo_url", "cve_id", "hash").agg(F.count("*").alias("_n"))
    published = spread(links.join(t["cve"].select("cve_id", "published_date"), "cve_id").drop("cve_id"), "hash")
    dated = published.join(t["commits"].select("hash", "committer_date"), "hash")
    days = dated.groupBy(
        F.col("repo_url").alias("project"), days_between(F.col("committer_date"), F.col("published_date")).alias("_d")
    ).agg(F.sum("_n").alias("_n"))
    weight = F.when(F.col("_d").isNotNull(), F.col("_n"))
    return days.groupBy("project").agg(
        F.round(F.sum(F.col("_d") * F.col("_n")) / F.sum(weight), digits).alias("mean_days_to_fix"),
        F.round(F.percentile("_d", F.lit(0.5), F.col("_n")), digits).alias("median_days_to_fix"),
        F.max("_d").alias("max_days_to_fix"),
        F.min("_d").alias("min_days_to_fix"),
    )


def severity_summary(t: Tables, score_digits: int = 2, digits: int = 3) -> DataFrame:
    """Mean scores, advisories, weaknesses and days to fix per project, most advisories first, short names."""
    means = list(MEAN_NAMES.values())
    scores = project_scores(t, score_digits).select("projects", *means)
    days = days_to_fix(t, digits).withColumnRenamed("project", "projects")
    joined = scores.join(cve_cwe_per_project(t), "projects").join(days, "projects", "left")
    whole = round_all(joined, digits).orderBy(F.desc("cve_count"), "projects")
    return whole.withColumn("projects", last_segment(F.col("projects")))


# ---- delta maintainability ------------------------------------------------------------------------------------------

def project_dmm(t: Tables, digits: int = 2) -> DataFrame:
    """Mean maintainability measures per project, zeros and missing left out, and the mean of these means."""
    commits = t["commits"]
    names = {unit: f"dmm_{unit}" for unit in UNITS}
    means = [F.round(mean_above_zero(_number(commits, c)), digits).alias(f"avg_{u}") for u, c in names.items()]
    stored = [
        F.round(mean_as_stored(_stored_text(commits, c)), digits).alias(f"avg_{u}_as_stored") for u, c in names.items()
    ]
    grouped = commits.groupBy(F.col("repo_url").alias("projects")).agg(*means, *stored)
    total = F.col("avg_unit_size") + F.col("avg_unit_complexity") + F.col("avg_unit_interfacing")
    return grouped.withColumn("avg_unit_score", total / 3).withColumn("projects", last_segment(F.col("projects")))


def risky_share(scores: DataFrame, column: str, limit: float = 0.5) -> DataFrame:
    """Percent of all rows whose score is below ``limit``; rows without score count in the whole."""
    risky = F.count_if(F.col(column) < limit)
    return scores.agg((risky / F.nullif(F.count("*"), F.lit(0)) * 100).alias("risky_percent"))


def commit_dmm(t: Tables) -> DataFrame:
    """The maintainability measures of commits that have all three, and their mean."""
    commits = t["commits"]
    measured = commits.select(*[_number(commits, f"dmm_{unit}").alias(unit) for unit in UNITS]).dropna()
    total = F.col("unit_size") + F.col("unit_complexity") + F.col("unit_interfacing")
    return measured.withColumn("unit_score", total / 3)


# ---- languages ------------------------------------------------------------------------------------------------------

def language_counts(t: Tables, limit: int = 15) -> DataFrame:
    """Files per language, most first."""
    counted = t["file_change"].where("programming_language IS NOT NULL").groupBy("programming_language").agg(
        F.count("*").alias("file_count"))
    return _ranked(counted, "file_count", "programming_language").limit(limit)


def language_share(t: Tables, languages: Sequence[str]) -> DataFrame:
    """Percent of files in the given languages; of these only rows without any NULL count."""
    files = t["file_change"]
    complete = F.lit(True)
    for name in files.columns:
        complete = complete & F.col(name).isNotNull()
    # Two scans: the whole needs the language alone, and the language filter of the part reaches the scan.
    part = files.where(F.col("programming_language").isin(*languages) & complete).agg(F.count("*").alias("part"))
    whole = files.agg(F.count("programming_language").alias("whole"))
    return whole.select((part.select("part").scalar() / F.nullif(F.col("whole"), F.lit(0)) * 100)
                        .alias("language_percent"))


def language_levels(t: Tables, limit: int = 15) -> DataFrame:
    """Distinct files and methods per language, most methods first; files without methods are left out."""
    methods = (
        t["method_change"].select("file_change_id", "method_change_id").distinct()
        .groupBy("file_change_id").agg(F.count("method_change_id").alias("_methods"))
    )
    files = t["file_change"].select("file_change_id", "programming_language").distinct()
    counted = files.join(methods, "file_change_id").groupBy("programming_language").agg(
        F.count("*").alias("file_count"), F.sum("_methods").alias("method_count")
    )
    return _ranked(counted, "method_count", "programming_language").limit(limit)
