"""Hot keys give the same results, and plans keep their shape."""

import random
import re

import duckdb
import pandas as pd
import pytest
from compare import SAME_TYPE, _rows
from pyspark.sql import functions as F

from fixtrail.checks import analytics_queries as Q
from fixtrail.operators import integrity, linking
from fixtrail.plans import analytics as A

HOT = 3  # one key in this many rows


def hot(rng, name, among):
    return f"{name}0" if rng.randrange(HOT) == 0 else f"{name}{rng.randrange(among)}"


@pytest.fixture(scope="module")
def skewed(spark):
    """The tables with one advisory, weakness, commit, file, project and language that holds a third of all rows."""
    rng = random.Random(5)
    score = lambda: rng.choice(["nan", "0.0", "0", "None", "5.5", "7.25", "9"])
    frames = {
        "cve": pd.DataFrame([(f"c{i}", pd.Timestamp(2020, 1 + i % 12, 3).date(), score(), score(), score(), score())
                             for i in range(60)], columns=["cve_id", "published_date", *A.SCORES]),
        "fixes": pd.DataFrame({(hot(rng, "c", 70), hot(rng, "h", 80), hot(rng, "o/r_", 9)) for _ in range(400)},
                              columns=["cve_id", "hash", "repo_url"]),
        "commits": pd.DataFrame([(f"h{i}", hot(rng, "o/r_", 9), pd.Timestamp(2020, 3, 1 + i % 28), score(), score(), score())
                                 for i in range(70)],
                                columns=["hash", "repo_url", "committer_date", "dmm_unit_size", "dmm_unit_complexity",
                                         "dmm_unit_interfacing"]),
        "file_change": pd.DataFrame([(f"f{i}", hot(rng, "h", 80), f"n{i}", rng.randrange(3), rng.randrange(3), "b",
                                      rng.choice(["a", None]), hot(rng, "L", 20)) for i in range(500)],
                                    columns=["file_change_id", "hash", "filename", "num_lines_added", "num_lines_deleted",
                                             "code_before", "code_after", "programming_language"]),
        "method_change": pd.DataFrame([(f"m{i}", hot(rng, "f", 520), rng.choice(["", "x"]), rng.random() < 0.5)
                                       for i in range(900)],
                                      columns=["method_change_id", "file_change_id", "name", "before_change"]),
        "cwe": pd.DataFrame([(f"w{i}", f"name {i}") for i in range(12)], columns=["cwe_id", "cwe_name"]),
        "cwe_classification": pd.DataFrame({(hot(rng, "c", 70), hot(rng, "w", 14)) for _ in range(200)},
                                           columns=["cve_id", "cwe_id"]),
        "repository": pd.DataFrame([("o/r_1", "one")], columns=["repo_url", "repo_name"]),
    }
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(f"_{name}", frame)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}")
    return {name: spark.createDataFrame(frame).repartition(7) for name, frame in frames.items()}, con


CASES = {
    "small_fixes": (A.small_fixes, Q.SMALL_FIXES),
    "commit_count": (A.commit_count, Q.COMMIT_COUNT),
    "file_count": (A.file_count, Q.FILE_COUNT),
    "method_count": (A.method_count, Q.METHOD_COUNT),
    "cve_cwe": (A.cve_cwe_per_project, Q.CVE_CWE),
    "weaknesses": (A.weakness_summary, Q.WEAKNESSES),
    "shares": (A.top_share, Q.TOP_SHARE),
    "scores": (lambda t: A.project_scores(t, Q.D), Q.PROJECT_SCORES),
    "days": (lambda t: A.days_to_fix(t, Q.D), Q.DAYS_TO_FIX),
    "dmm": (lambda t: A.project_dmm(t, Q.D).withColumn("avg_unit_score", F.round("avg_unit_score", 12)),
            f"SELECT * REPLACE (round(avg_unit_score, 12) AS avg_unit_score) FROM ({Q.PROJECT_DMM})"),
    "levels": (A.language_levels, Q.LANGUAGE_LEVELS),
    "boxes": (lambda t: A.box_stats(A.score_frame(t), A.SCORES), Q._box_sql(Q.SCORE_FRAME, A.SCORES)),
    "pruned_methods": (lambda t: integrity.prune(t)["method_change"], """
        SELECT * FROM {method_change} WHERE name <> '' AND file_change_id IN (
            SELECT file_change_id FROM {file_change} WHERE NOT (num_lines_added = 0 AND num_lines_deleted = 0)
            AND hash IN (SELECT hash FROM {fixes}) AND hash IN (SELECT hash FROM {commits}))"""),
}


@pytest.mark.parametrize("case", CASES)
def test_hot_keys(spark, skewed, case):
    tables, con = skewed
    build, sql = CASES[case]
    # Sort-merge joins only, split where a key is hot.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    try:
        df = build(tables)
        got = df.collect()
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes",
                    "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{key}")
    rel = con.sql(re.sub(r"\{(\w+)\}", r"\1", sql))
    wanted = dict(zip(rel.columns, map(str, rel.types)))
    skipped = {"num_lines_added", "num_lines_deleted"}  # pandas gives both engines wide integers
    assert all(SAME_TYPE[kind] == wanted[name] for name, kind in df.dtypes if name not in skipped)
    assert _rows(df.columns, got) == _rows(rel.columns, rel.fetchall())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_all_rows(spark):
    import __spark_entry__ as entry

    for name, query in entry.queries().items():
        if name[0] in "acdlp":
            text = plan(query(spark, "/root/testdata/sf0.001"))
            assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_top_ranks_are_limited_before_the_shuffle(spark, skewed):
    text = plan(A._top_sums(A.project_counts(skewed[0]), 10))
    assert text.count("WindowGroupLimit") == 2  # once per task, once after the shuffle


@pytest.fixture
def stored(spark, skewed, tmp_path):
    for name, df in skewed[0].items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in skewed[0]}


def scan_of(text, table):
    """Read schemas of the scans of a stored table."""
    return re.findall(rf"FileScan parquet[^\n]*/{table}\][^\n]*ReadSchema: struct<([^>]*)>", text)


def test_texts_are_not_read_for_counts(stored):
    for schema in scan_of(plan(A.weakness_summary(stored)), "file_change"):
        assert "code" not in schema and "filename" not in schema


def test_limits_reach_the_scan(stored):
    text = plan(A.small_fixes(stored, language="L1"))
    assert "LessThanOrEqual(num_lines_added,1)" in text and "EqualTo(programming_language,L1)" in text


def test_texts_are_shuffled_once(spark, stored):
    """The source texts pass one exchange on their way through the five-way join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(A.small_fixes(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [s for s in scan_of(text, "file_change") if "code_before" in s]
    assert len(wide) == 1


def test_methods_are_paired_on_one_shuffle(spark):
    from fixtrail.operators.diffs import method_patches, pair_methods

    from test_changes import versions

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(pair_methods(versions(spark))).count("Exchange hashpartitioning") == 1
        files = spark.createDataFrame([("f", "C")], "file_change_id string, programming_language string")
        # One for the methods, one for the keys of the language's files.
        assert plan(method_patches(versions(spark), files, "C")).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_repository_in_links(spark, rows):
    """A third of all links in one project and one commit."""
    fixes = [("c%d" % i, "abcd%03d" % (i % 5 if i % 3 else 0), "r0" if i % 3 == 0 else f"r{i % 7}") for i in range(300)]
    commits = [("abcd%03dfull" % i, f"r{j}") for i in range(5) for j in range(7)]
    got = rows(linking.resolve_short_hashes(
        spark.createDataFrame(fixes, "cve_id string, hash string, repo_url string"),
        spark.createDataFrame(commits, "hash string, repo_url string"), strict=True))
    assert got == sorted(((c, h + "full", r) for c, h, r in fixes), key=repr)


def scanned(text):
    """{table: number of distinct scans of a stored table}; subqueries that are used twice are printed twice."""
    found = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/(\w+)\]", text)
    return {table: len({columns for columns, other in found if other == table}) for _, table in found}


def test_shares_fold_files_and_methods_once(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fold, whole = scanned(plan(A.commit_fold(stored))), scanned(plan(A.top_share(stored)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fold == {"commits": 1, "file_change": 1, "method_change": 1}
    # Besides the fold only the distinct totals read files and methods.
    assert whole["file_change"] == whole["method_change"] == 1 and "commits" not in whole


def test_adjacent_pairs_move_code_once(spark):
    from fixtrail.operators.diffs import pair_adjacent

    from test_changes import versions

    text = plan(pair_adjacent(versions(spark), ["file_change_id", "method_change_id"]))
    assert len(re.findall(r"Exchange hashpartitioning\(file_change_id#\d+, name#\d+, 8\)", text)) == 1
    # What was range shuffled and written to number the rows has no code.
    written = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert written and not any("code" in schema for schema in written)


def test_other_languages_code_is_dropped_before_the_shuffle(spark, tmp_path):
    from fixtrail.operators.diffs import method_patches

    from test_changes import versions

    versions(spark).write.parquet(str(tmp_path / "methods"))
    spark.createDataFrame([("f", "C"), ("g", "D")], "file_change_id string, programming_language string") \
        .write.parquet(str(tmp_path / "files"))
    methods, files = (spark.read.parquet(str(tmp_path / name)) for name in ("methods", "files"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    try:
        text = plan(method_patches(methods, files, "C"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
    assert text.index("might_contain") > text.index("Exchange hashpartitioning(file_change_id")


def links_on_disk(spark, folder):
    """The tables that A8, A9, A10 and A17 read, as files."""
    rows = {
        "fixes": [(f"v{n % 40}", f"h{n % 90}", f"r/{n % 7}") for n in range(400)],
        "cve": [(f"v{n}", *["1.5"] * 4) for n in range(35)],
        "cwe_classification": [(f"v{n % 40}", f"w{n % 6}") for n in range(80)],
        "cwe": [(f"w{n}", f"name {n}") for n in range(6)],
        "commits": [(f"h{n}",) for n in range(80)],
        "file_change": [(f"f{n}", f"h{n % 90}", n % 3, n % 2) for n in range(300)],
        "method_change": [(f"m{n}", f"f{n % 200}", "g") for n in range(500)],
    }
    kinds = {
        "fixes": "cve_id string, hash string, repo_url string",
        "cve": "cve_id string, " + ", ".join(f"{score} string" for score in A.SCORES),
        "cwe_classification": "cve_id string, cwe_id string", "cwe": "cwe_id string, cwe_name string",
        "commits": "hash string", "file_change": "file_change_id string, hash string, num_lines_added int, num_lines_deleted int",
        "method_change": "method_change_id string, file_change_id string, name string",
    }
    for name, kind in kinds.items():
        spark.createDataFrame(rows[name], kind).write.parquet(f"{folder}/{name}")
    t = {name: spark.read.parquet(f"{folder}/{name}") for name in kinds}
    t["cve"] = t["cve"].withColumn("published_date", F.to_date(F.lit("2020-01-01")))
    t["commits"] = t["commits"].withColumn("committer_date", F.to_date(F.lit("2020-02-01")))
    return t, rows


def first_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_spread_grows_with_the_files(spark, tmp_path, monkeypatch):
    from fixtrail import session

    spark.range(20000).write.parquet(str(tmp_path / "some numbers"))
    df = spark.read.parquet(str(tmp_path / "some numbers"))
    size = sum(file.stat().st_size for file in (tmp_path / "some numbers").glob("*.parquet"))
    monkeypatch.setattr(session, "BYTES_PER_TASK", size // 50)
    assert session.spread(df, "id").rdd.getNumPartitions() in (50, 51)
    monkeypatch.setattr(session, "BYTES_PER_TASK", size)
    assert session.spread(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert session.spread(spark.createDataFrame([(1,)], "id int"), "id").rdd.getNumPartitions() == 8


def test_links_fan_out_over_numbered_tasks(spark, tmp_path):
    t, rows = links_on_disk(spark, tmp_path)
    known = {c for c, *_ in rows["cve"]}
    classes = {}
    for cve, cwe in rows["cwe_classification"]:
        classes.setdefault(cve, set()).add(cwe)
    wanted = {}
    for cve, _, project in rows["fixes"]:
        if cve in known and cve in classes:
            cves, cwes = wanted.setdefault(project, (set(), set()))
            cves.add(cve)
            cwes |= classes[cve]
    counted = A.cve_cwe_per_project(t)
    assert {r[0]: (r[1], r[2]) for r in counted.collect()} == {p: (len(a), len(b)) for p, (a, b) in wanted.items()}
    assert "Expand" not in first_plan(counted) and re.search(r"RepartitionByExpression \[cve_id#\d+\], \d", first_plan(counted))
    for df in (A.weakness_summary(t), A.severity_summary(t)):
        found = re.findall(r"RepartitionByExpression \[(\w+)#\d+\], \d", first_plan(df))
        assert {"cve_id", "hash"} <= set(found)


def test_top_share_reads_links_once(spark, tmp_path):
    t, _ = links_on_disk(spark, tmp_path)
    top = A.top_share(t)
    assert str(tmp_path / "fixes") not in plan(top) and top.count() == 1


def test_pruned_counts_shuffle_files_and_methods_once_per_key(spark, tmp_path):
    t, rows = links_on_disk(spark, tmp_path)
    fixes = t["fixes"].select("hash").distinct()
    t["file_change"] = integrity.keep_linked(t["file_change"], fixes, "hash")
    both = t["method_change"].unionAll(t["method_change"].withColumn("method_change_id", F.concat("method_change_id", F.lit("x"))))
    kept = integrity.keep_linked(both, t["file_change"], "file_change_id")
    assert first_plan(kept).index("Join") < first_plan(kept).index("Union")
    t["repository"] = t["fixes"].select("repo_url")
    counts = integrity.check_counts({**t, "method_change": kept})
    got = {r.rule: (r.left_count, r.right_count) for r in counts.collect()}
    assert got["commits_files"] == (80, 90) and got["files_methods"] == (300, 200)
    assert got["textual_files"] == (sum(a == b == 0 for *_, a, b in rows["file_change"]), 0)
    text = counts._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Expand \[\[(?:(?!Expand)[^\n])*file_change_id", text)


def test_sources_without_a_method_to_keep_are_not_split(spark):
    from fixtrail.operators.changes import method_rows

    method = "array<struct<name:string,long_name:string,parameters:array<string>,start_line:int,end_line:int,nloc:int," \
             "complexity:int,token_count:int,top_nesting_level:int>>"
    line = "array<struct<line:int,text:string>>"
    files = spark.createDataFrame(
        [(1, "a\nb\nc", None, [("f", "f", [], 2, 3, 1, 1, 1, 0)], None, ([(3, "x")], [])),
         (2, "a\nb\nc", "a", [("f", "f", [], 2, 3, 1, 1, 1, 0)], [("f", "f", [], 1, 1, 1, 1, 1, 0)], ([(1, "x")], [(1, "x")]))],
        f"file_change_id long, source_code string, source_code_before string, methods {method}, methods_before {method}, "
        f"diff_parsed struct<added:{line},deleted:{line}>")
    got = method_rows(files)
    assert sorted((r.file_change_id, r.code, r.before_change) for r in got.collect()) == [(1, "b\nc", False), (2, "a", True)]
    assert len(re.findall(r"CASE WHEN \(isnotnull\(source_code\w*#\d+\) AND array_contains", first_plan(got))) >= 2
