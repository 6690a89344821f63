import re

from fixtrail.operators import integrity as P


def raw(spark):
    make = spark.createDataFrame
    return {
        "cve": make([("c1",), ("c2",), ("c3",)], "cve_id string"),
        "fixes": make([("c1", "h1", "o/r1"), ("c2", "gone", "o/r2"), ("c1", "h2", "o/r3")],
                      "cve_id string, hash string, repo_url string"),
        "commits": make([("h1", "o/r1.git"), ("h2", "o/r3"), ("stray", "o/r1")], "hash string, repo_url string"),
        "file_change": make([("f1", "h1", 1, 0), ("f2", "h1", 0, 0), ("f3", "stray", 1, 1)],
                            "file_change_id string, hash string, num_lines_added int, num_lines_deleted int"),
        "method_change": make([("m1", "f1", "a", True), ("m2", "f1", "", True), ("m3", "f2", "b", False), ("m4", "f3", "c", True)],
                              "method_change_id string, file_change_id string, name string, before_change boolean"),
        "cwe": make([("w1", "n"), ("w2", "n")], "cwe_id string, cwe_name string"),
        "cwe_classification": make([("c1", "w1"), ("c2", "w2"), ("c3", "w2")], "cve_id string, cwe_id string"),
        "repository": make([("o/r1", "one", "o")], "repo_url string, repo_name string, owner string"),
    }


def ids(tables, column=0):
    return {name: sorted(row[column] for row in df.collect()) for name, df in tables.items()}


def test_prune_cascades(spark):
    kept = ids(P.prune(raw(spark)))
    assert kept["commits"] == ["h1", "h2"] and kept["cve"] == ["c1"] and kept["fixes"] == ["c1", "c1"]
    assert kept["file_change"] == ["f1"] and kept["method_change"] == ["m1"]
    assert kept["cwe"] == ["w1"] and kept["cwe_classification"] == ["c1"]
    assert kept["repository"] == ["o/r1", "o/r3"]


def test_orphans_can_be_kept(spark):
    """Methods of a file dropped as non-textual survive in the stored form (Q6)."""
    assert ids(P.prune(raw(spark), keep_orphans=True))["method_change"] == ["m1", "m3"]


def test_prune_is_idempotent(spark):
    once = P.prune(raw(spark), materialise_links=True)
    twice = P.prune(once)
    for name, table in once.items():
        assert sorted(map(repr, table.collect())) == sorted(map(repr, twice[name].collect()))


def test_pruned_tables_pass_the_count_rules(spark):
    before = {row.rule: row.holds for row in P.check_counts(raw(spark)).collect()}
    after = {row.rule: row.holds for row in P.check_counts(P.prune(raw(spark))).collect()}
    assert not before["textual_files"] and not before["cve_fixes"]
    assert len(after) == 8 and all(after.values())


def test_placeholder_rows(spark, rows):
    tables = raw(spark)
    filled = rows(P.fill_missing_repos(tables["fixes"], tables["repository"]))
    assert ("o/r2", P.PLACEHOLDER, "o") in filled and len(filled) == 3


def test_key_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, n int")
    assert rows(P.check_unique(df, ["k"])) == [("a", 2)]
    assert rows(P.check_foreign_key(df, df.where("k = 'a'"), "k")) == [("b", 1)]


def test_unknown_line_counts_stay(spark):
    files = spark.createDataFrame([(None, 0), (0, 0), (0, 1)], "num_lines_added int, num_lines_deleted int")
    assert P.drop_non_textual(files).count() == 2


def test_count_rules_read_each_table_once(spark, tmp_path):
    from fixtrail.schemas import TABLES

    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in TABLES}
    counted = P.check_counts(stored)
    # Each table is read by one subquery, whatever the number of rules that ask for it.
    optimized = counted._jdf.queryExecution().optimizedPlan().toString()
    assert len(set(re.findall(r"scalar-subquery#(\d+)", optimized))) == len(TABLES)
    assert [r.holds for r in counted.collect()] == [True] * 8
