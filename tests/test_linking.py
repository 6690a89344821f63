import pytest

from fixtrail.operators import linking as L

URLS = [
    ("http://github.com/a/b/commit/abc123#diff-1", ("https://github.com/a/b", "abc123")),
    ("https://bitbucket.org/o/p/commits/77?at=x", ("https://bitbucket.org/o/p", "77")),
    ("see https://github.com/a/b/commit/1#https://github.com/c/d/commit/2", ("https://github.com/c/d", "2")),
    ("https://gitlab.com/o/p/-/commit/ff", None),
    ("https://github.com/a/b/pull/3/commits/abc", None),
    ("https://www.github.com/a/b/commit/1", None),
    ("https://github.com/a/b/issues/1", None),
]


@pytest.mark.parametrize("url, expected", URLS)
def test_commit_links(spark, url, expected):
    cve = spark.createDataFrame([("c", [(url,)])], "cve_id string, reference_json array<struct<url:string>>")
    found = [(row.repo_url, row.hash) for row in L.extract_fix_links(cve).collect()]
    assert found == ([expected] if expected else [])


def test_links_are_distinct_and_survive_missing_references(spark, rows):
    link = ("https://github.com/a/b/commit/1",)
    cve = spark.createDataFrame([("c", [link, link]), ("d", None), ("e", [])],
                                "cve_id string, reference_json array<struct<url:string>>")
    assert rows(L.extract_fix_links(cve)) == [("c", "1", "https://github.com/a/b")]


def test_classify(spark, rows):
    schema = "cve_id string, problemtype_json array<struct<description:array<struct<lang:string,value:string>>>>"
    cve = spark.createDataFrame([
        ("a", [([("en", "CWE-1"), ("fr", "CWE-1"), ("en", "CWE-2")],)]), ("b", [([],)]), ("c", None),
    ], schema)
    assert rows(L.classify(cve)) == [("a", "CWE-1"), ("a", "CWE-2"), ("b", L.NO_INFO), ("c", L.NO_INFO)]


def test_weakness_dim_keeps_the_first_of_an_id(spark):
    nodes = spark.createDataFrame([
        (1, "cat", "d", "", True), (1, "weak", "d", "e", False), (0, "zero", "d", "e", False),
    ], "id bigint, name string, description string, extended_description string, is_category boolean")
    dim = {row.cwe_id: row for row in L.build_weakness_dim(nodes).collect()}
    assert set(dim) == {"CWE-1", "CWE-0", "NVD-CWE-noinfo", "NVD-CWE-Other"}
    assert dim["CWE-1"].cwe_name == "weak" and dim["CWE-1"].url.endswith("/1.html")
    assert dim["CWE-0"].url is None


def test_latest_probe_decides(spark, rows):
    log = spark.createDataFrame([
        ("u1", 1, 404, None), ("u1", 2, 200, None),               # came back
        ("u2", 1, 302, L.LOGIN_PAGE), ("u3", 1, 302, "elsewhere"),
        ("u4", 1, 200, None), ("u4", 2, 429, None),               # asked to slow down
        ("u5", 1, 500, None),
    ], "url string, probed_at int, status int, location string")
    fixes = spark.createDataFrame([("c", "h", f"u{i}") for i in range(1, 7)], "cve_id string, hash string, repo_url string")
    assert [row[2] for row in rows(L.drop_unavailable(fixes, log))] == ["u1", "u3", "u4", "u6"]


FIXES = "cve_id string, hash string, repo_url string"


def test_short_hashes(spark, rows):
    commits = spark.createDataFrame([("abcd999", "r"), ("abcd111", "r"), ("abcd000", "s"), ("ffff000", "r")],
                                    "hash string, repo_url string")
    fixes = spark.createDataFrame([("1", "abcd9", "r"), ("2", "ffff000", "r"), ("3", "zzzz", "r")], FIXES)
    assert [r[1] for r in rows(L.resolve_short_hashes(fixes, commits))] == ["abcd111", "ffff000", "zzzz"]
    assert [r[1] for r in rows(L.resolve_short_hashes(fixes, commits, strict=True))] == ["abcd999", "ffff000", "zzzz"]


def test_strict_short_hashes_against_all_pairs(spark, rows):
    """Nearest-candidate search equals the join of all pairs with the same lead."""
    full = [f"abcd{i:03x}" for i in range(0, 300, 7)]
    short = ["abcd", "abcd0", "abcd1", "abcd00", "abcd07", "abcd0e", "abcd2", "abcd999", "abce"]
    commits = spark.createDataFrame([(h, "r") for h in full], "hash string, repo_url string")
    fixes = spark.createDataFrame([(str(i), h, "r") for i, h in enumerate(short)], FIXES)
    expected = [(str(i), min([f for f in full if f.startswith(h)], default=h), "r") for i, h in enumerate(short)]
    assert rows(L.resolve_short_hashes(fixes, commits, strict=True)) == expected


def test_work_units_cut_large_repositories_only(spark):
    fixes = spark.createDataFrame(
        [("c", f"{i:04d}", "https://github.com/big/one") for i in range(1000)] + [("c", "x", "small")] * 3, FIXES)
    units = L.work_units(fixes, batch=50).collect()
    big = [u for u in units if u.repo_url != "small"]
    assert sorted(h for u in big for h in u.hashes) == [f"{i:04d}" for i in range(1000)]
    assert len(big) == 20 and max(len(u.hashes) for u in big) < 100
    assert all(u.clone_url.endswith(".git") and not u.single_hash for u in big)
    assert [(u.single_hash, u.hashes) for u in units if u.repo_url == "small"] == [(True, ["x"])]


def test_sample_leaves_out_large_projects(spark, rows):
    fixes = spark.createDataFrame([("1", "a", L.LARGE_PROJECTS[0]), ("2", "b", "r"), ("3", "c", "r")], FIXES)
    assert rows(L.sample_fixes(fixes, 1)) == [("2", "b", "r")]
