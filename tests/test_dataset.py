"""Readers, sinks and the whole job on small files."""

import json
import re
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fixtrail.operators import integrity, linking, shaping
from fixtrail.plans import dataset, reports
from fixtrail.schemas import FEED, SNAPSHOT, TABLES
from fixtrail.sources import feed, tables, weaknesses
from fixtrail.streaming.incremental import incremental_ingest

BOTTLE, MAILER = "https://github.com/bottlepy/bottle", "https://github.com/PHPMailer/PHPMailer"


def advisory(name, weakness, links, v3, v2, published):
    references = [{"url": url, "name": url, "refsource": "X", "tags": ["Patch"]} for url in links]
    impact = {"baseMetricV2": {"cvssV2": {"version": "2.0", "baseScore": v2, "accessVector": "NETWORK"},
                               "severity": "MEDIUM", "exploitabilityScore": 9.9, "obtainAllPrivilege": False}}
    if v3 is not None:
        impact["baseMetricV3"] = {"cvssV3": {"version": "3.0", "baseScore": v3, "attackVector": "NETWORK"},
                                  "exploitabilityScore": 2.8, "impactScore": 3.6}
    described = [{"description": [{"lang": "en", "value": w} for w in ([weakness] if weakness else [])]}]
    return {
        "cve": {"data_type": "CVE", "CVE_data_meta": {"ID": name, "ASSIGNER": "a"},
                "problemtype": {"problemtype_data": described}, "references": {"reference_data": references},
                "description": {"description_data": [{"lang": "en", "value": f"about {name}"}]}},
        "configurations": {"CVE_data_version": "4.0", "nodes": [{"operator": "OR", "children": [], "cpe_match": [
            {"vulnerable": True, "cpe23Uri": "cpe:x", "versionEndExcluding": "0.12.19", "cpe_name": []}]}]},
        "impact": impact, "publishedDate": published, "lastModifiedDate": published,
    }


ADVISORIES = [
    advisory("CVE-2016-9964", "CWE-93", [f"{BOTTLE}/issues/913", f"{BOTTLE}/commit/6d7e13da0f99"], 6.5, 4.3,
             "2016-12-16T09:59Z"),
    advisory("CVE-2020-28473", "CWE-444", ["https://example.org/x"], 6.8, 5.8, "2021-01-18T12:15Z"),
    advisory("CVE-2022-31799", "", [f"{BOTTLE}/commit/e140e1b5", f"{BOTTLE}/commit/a2b0ee6b"], 9.8, 7.5,
             "2022-06-02T14:15Z"),
    advisory("CVE-2008-5619", "CWE-94", [f"{MAILER}/commit/8beacc64"], None, 10.0, "2008-12-17T02:30Z"),
    advisory("CVE-2009-1", "CWE-94", [], None, 1.0, "2009-12-17T02:30Z"),
]

CATALOG = """<?xml version="1.0"?>
<Weakness_Catalog xmlns="http://cwe.mitre.org/cwe-6">
  <Weaknesses>
    <Weakness ID="93" Name="CRLF &amp; more" Status="Draft">
      <Description>About 93.</Description>
      <Extended_Description><p>Long <b>text</b> &amp; more.</p></Extended_Description>
      <Related_Weaknesses><Related_Weakness CWE_ID="74"/></Related_Weaknesses>
    </Weakness>
    <Weakness ID="94" Name="Code"><Description>About 94.</Description></Weakness>
  </Weaknesses>
  <Categories>
    <Category ID="2" Name="Environment"><Summary>A category.</Summary></Category>
  </Categories>
  <Views><View ID="600" Name="No row"/></Views>
</Weakness_Catalog>
"""


def commit(repo, name, files):
    who = {"name": "n", "date": "2017-01-01T00:00:00Z", "timezone": 0}
    return {"hash": name, "repo_url": repo, "author": who, "committer": who, "msg": "fix", "merge": False,
            "parents": ["p"], "modified_files": files}


def method(name, start, end):
    return {"name": name, "long_name": f"{name}( a )", "parameters": ["a"], "start_line": start, "end_line": end,
            "nloc": end - start + 1, "complexity": 1, "token_count": 5, "top_nesting_level": 0}


CHANGED = {
    "filename": "m.py", "old_path": "m.py", "new_path": "m.py", "change_type": "MODIFY", "diff": "-b\n+B",
    "diff_parsed": {"added": [{"line": 2, "text": "B"}], "deleted": [{"line": 2, "text": "b"}]},
    "source_code": "a\nB\nc\nd", "source_code_before": "a\nb\nc\nd", "nloc": 4, "complexity": 1, "token_count": 9,
    "methods": [method("f", 1, 2), method("g", 3, 4)], "methods_before": [method("f", 1, 2), method("g", 3, 4)],
}
BINARY = {**CHANGED, "filename": "x.bin", "old_path": "x.bin", "new_path": "x.bin", "source_code": None,
          "source_code_before": None, "diff_parsed": {"added": [], "deleted": []}, "methods": [], "methods_before": []}
SNAPSHOTS = [
    commit(f"{BOTTLE}.git", "6d7e13da0f99", [CHANGED, BINARY]),
    commit(f"{BOTTLE}.git", "e140e1b538", []),                      # named by a short hash
    commit(f"{MAILER}.git", "8beacc64", [CHANGED]),
    commit(f"{MAILER}.git", "unlinked", [CHANGED]),
]


@pytest.fixture
def inputs(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    for at, part in enumerate((ADVISORIES[:2], ADVISORIES[2:])):
        (tmp_path / "feed" / f"{at}.json").write_text(json.dumps(
            {"CVE_data_timestamp": f"2024-05-0{at + 1}T07:00Z", "CVE_Items": part}, indent=2))
    (tmp_path / "catalog.xml").write_text(CATALOG)
    (tmp_path / "snapshots.json").write_text("\n".join(map(json.dumps, SNAPSHOTS)))
    return tmp_path


def test_feed_becomes_the_advisory_table(spark, inputs, rows):
    cve = feed.advisories(feed.read_advisory_feed(spark, str(inputs / "feed")))
    assert len(cve.columns) == 34
    got = {r.cve_id: r for r in cve.collect()}
    assert set(got) == {"CVE-2016-9964", "CVE-2020-28473", "CVE-2022-31799", "CVE-2008-5619"}  # no references, no row
    first, old = got["CVE-2016-9964"], got["CVE-2008-5619"]
    assert (first.cvss3_base_score, first.cvss2_base_score, first.exploitability_score) == (6.5, 4.3, 2.8)
    assert first.cvss3_attack_vector == "NETWORK" and first.severity == "MEDIUM" and first.obtain_all_privilege is False
    assert (old.cvss3_base_score, old.cvss2_base_score, old.exploitability_score) == (None, 10.0, None)
    assert first.published_date.strftime("%Y-%m-%d %H:%M") == "2016-12-16 09:59"
    links = rows(linking.extract_fix_links(cve))
    assert len(links) == 4 and len({l[0] for l in links}) == 3 and {l[2] for l in links} == {BOTTLE, MAILER}
    assert len(rows(linking.classify(cve))) == 4
    windowed = feed.year_window(cve, first=2016, last=2021)
    assert sorted(r.cve_id for r in windowed.collect()) == ["CVE-2016-9964", "CVE-2020-28473"]
    assert feed.year_window(cve, sample=True, today=date(2022, 3, 1)).count() == 1


def test_version_limits_and_odd_dates_are_kept(spark, inputs):
    items = feed.read_advisory_feed(spark, str(inputs / "feed"))
    match = feed.advisories(items).first().nodes[0].cpe_match[0]
    assert (match.versionEndExcluding, match.versionStartIncluding) == ("0.12.19", None)
    odd = items.withColumn("publishedDate", F.lit("no date"))
    assert feed.advisories(odd).where("published_date IS NOT NULL").count() == 0
    assert tuple(feed.malformed_dates(odd).first()) == (items.count(), 0)


def test_feed_date(spark, inputs):
    raw = spark.read.schema(FEED).option("multiLine", True).json(str(inputs / "feed"))
    assert feed.feed_timestamp(raw).first().feed_date == date(2024, 5, 2)


def test_catalog(spark, inputs):
    got = {r.id: r for r in weaknesses.read_weakness_catalog(spark, str(inputs / "catalog.xml")).collect()}
    assert set(got) == {93, 94, 2}
    assert got[93].name == "CRLF & more" and got[93].description == "About 93."
    assert got[93].extended_description.startswith("Long text") and "<" not in got[93].extended_description
    assert got[94].extended_description is None and not got[94].is_category
    assert (got[2].description, got[2].extended_description, got[2].is_category) == ("A category.", "", True)


def test_whole_job(spark, inputs):
    built = dataset.build_dataset(
        str(inputs / "out"),
        items=feed.read_advisory_feed(spark, str(inputs / "feed")),
        catalog=weaknesses.read_weakness_catalog(spark, str(inputs / "catalog.xml")),
        snapshots=spark.read.schema(SNAPSHOT).json(str(inputs / "snapshots.json")),
    )
    assert set(built) == set(TABLES)
    got = {name: table.collect() for name, table in built.items()}
    assert sorted(r.hash for r in got["commits"]) == ["6d7e13da0f99", "8beacc64", "e140e1b538"]
    assert sorted((r.cve_id, r.hash) for r in got["fixes"]) == [
        ("CVE-2008-5619", "8beacc64"), ("CVE-2016-9964", "6d7e13da0f99"), ("CVE-2022-31799", "e140e1b538")]
    assert {r.repo_url for r in got["commits"]} == {BOTTLE, MAILER}
    assert sorted(r.filename for r in got["file_change"]) == ["m.py", "m.py"]
    methods = [(r.name, r.before_change, r.code) for r in got["method_change"]]
    assert sorted(methods) == [("f", False, "a\nB")] * 2 + [("f", True, "a\nb")] * 2
    assert {r.file_change_id for r in got["method_change"]} == {r.file_change_id for r in got["file_change"]}
    assert sorted(r.cwe_id for r in got["cwe"]) == ["CWE-93", "CWE-94", "NVD-CWE-noinfo"]
    assert sorted((r.repo_url, r.repo_name) for r in got["repository"]) == [
        (MAILER, "visit repo url"), (BOTTLE, "visit repo url")]
    again = dataset.collect(
        feed.read_advisory_feed(spark, str(inputs / "feed")), weaknesses.read_weakness_catalog(spark, str(inputs / "catalog.xml")),
        spark.read.schema(SNAPSHOT).json(str(inputs / "snapshots.json")), loaded=built["commits"])
    assert [r.hash for r in again["commits"].collect()] == ["unlinked"]


def sources(spark, inputs, items=slice(None), snapshots=slice(None)):
    folder = inputs / f"part-{len(list(inputs.iterdir()))}"
    folder.mkdir()
    (folder / "feed.json").write_text(json.dumps({"CVE_Items": ADVISORIES[items]}))
    (folder / "snapshots.json").write_text("\n".join(map(json.dumps, SNAPSHOTS[snapshots])))
    return {
        "items": feed.read_advisory_feed(spark, str(folder / "feed.json")),
        "catalog": weaknesses.read_weakness_catalog(spark, str(inputs / "catalog.xml")),
        "snapshots": spark.read.schema(SNAPSHOT).json(str(folder / "snapshots.json")),
    }


def test_two_runs_equal_one(spark, inputs, rows):
    first, second, whole = (str(inputs / name) for name in ("first", "second", "whole"))
    dataset.build_dataset(first, **sources(spark, inputs, slice(0, 3), slice(0, 2)))
    # The second delivery repeats some of the first.
    extended = dataset.build_dataset(second, previous=first, **sources(spark, inputs, slice(2, 5), slice(1, 4)))
    at_once = dataset.build_dataset(whole, **sources(spark, inputs))
    for name in TABLES:
        assert rows(extended[name]) == rows(at_once[name]), name


def test_a_second_run_writes_only_its_own_files(spark, inputs, rows):
    """Wide tables of earlier runs stay where they are; the manifest names them, over several runs."""
    runs = [str(inputs / f"run{n}") for n in range(3)]
    one = dataset.build_dataset(runs[0], **sources(spark, inputs, slice(0, 3), slice(0, 2)))
    before = {name: rows(table) for name, table in one.items()}
    two = dataset.build_dataset(runs[1], previous=runs[0], **sources(spark, inputs, slice(2, 5), slice(1, 3)))
    three = dataset.build_dataset(runs[2], previous=runs[1], **sources(spark, inputs, slice(0, 5), slice(2, 4)))
    assert "manifest" not in {p.name for p in (inputs / "run0").iterdir()}
    for name in ("commits", "file_change", "method_change"):
        listed = tables.live_folders(spark, runs[2])[name]
        assert [folder.rsplit("/", 2)[1] for folder in listed] == ["run0", "run1", "run2"]
        own = [rows(spark.read.schema(TABLES[name]).parquet(folder)) for folder in listed]
        # No row is written twice, and the folders together are the table.
        assert sorted(sum(own, []), key=repr) == rows(three[name])
        assert not set(map(repr, own[0])) & set(map(repr, own[1] + own[2]))
        assert sorted(own[0] + own[1], key=repr) == rows(two[name])
    compacted = dataset.compact(spark, runs[2], str(inputs / "compacted"))
    for name in TABLES:
        assert rows(three[name]) == rows(compacted[name]), name
        assert len(tables.live_folders(spark, str(inputs / "compacted"))[name]) == 1
    assert {name: rows(table) for name, table in tables.load_tables(spark, runs[0]).items()} == before
    with pytest.raises(FileExistsError):
        dataset.compact(spark, runs[2], str(inputs / "compacted"))


def test_a_failing_check_publishes_nothing(spark, inputs, monkeypatch):
    first, second = str(inputs / "first"), str(inputs / "second")
    dataset.build_dataset(first, **sources(spark, inputs))

    def broken(tables):
        raise ValueError("a key")

    monkeypatch.setattr(integrity, "verify", broken)
    with pytest.raises(ValueError):
        dataset.build_dataset(second, previous=first, **sources(spark, inputs))
    assert not tables.table_exists(spark, f"{second}/cve")
    assert tables.load_tables(spark, first)["commits"].count() == 3
    with pytest.raises(FileExistsError):
        dataset.build_dataset(first, **sources(spark, inputs))


def test_years_of_the_job(spark, inputs):
    got = dataset.collect(**sources(spark, inputs), years=(2016, 2021))
    assert sorted(r.cve_id for r in got["cve"].collect()) == ["CVE-2016-9964", "CVE-2020-28473"]
    assert dataset.collect(**sources(spark, inputs), sample_year=True)["cve"].count() == 0


def test_job_from_the_command_line(spark, inputs):
    (inputs / "meta.json").write_text(json.dumps({"repo_url": BOTTLE, "repo_name": "bottlepy/bottle", "owner": "bottlepy"}))
    (inputs / "probes.json").write_text(json.dumps(
        {"url": MAILER, "probed_at": "2024-01-01T00:00:00Z", "status": 404, "location": None}))
    (inputs / "samples.json").write_text("\n".join(json.dumps(s) for s in (
        {"text": "a\nB\nc\nd", "lang": "letters"}, {"text": "12345678", "lang": "digits"})))
    dataset.main([
        "--feed", str(inputs / "feed" / "0.json"), str(inputs / "feed" / "1.json"), "--catalog", str(inputs / "catalog.xml"),
        "--snapshots", str(inputs / "snapshots.json"), "--repo-meta", str(inputs / "meta.json"),
        "--probe-log", str(inputs / "probes.json"), "--language-samples", str(inputs / "samples.json"),
        "--languages", "letters", "digits", "--output", str(inputs / "out")])
    got = {name: table.collect() for name, table in tables.load_tables(spark, str(inputs / "out"), views=True).items()}
    assert [(r.repo_url, r.repo_name, r.owner) for r in got["repository"]] == [(BOTTLE, "bottlepy/bottle", "bottlepy")]
    assert sorted(r.hash for r in got["commits"]) == ["6d7e13da0f99", "e140e1b538"]
    assert [(r.filename, r.programming_language) for r in got["file_change"]] == [("m.py", "letters")]
    assert spark.sql("SELECT count(*) AS n FROM method_change").first().n == 2
    for name in TABLES:
        spark.catalog.dropTempView(name)


def test_broken_keys_are_reported(spark):
    make = spark.createDataFrame
    broken = {
        "cve": make([("c",), ("c",)], "cve_id string"), "fixes": make([("c", "h", "r")], "cve_id string, hash string, repo_url string"),
        "commits": make([("h", "r")], "hash string, repo_url string"),
        "file_change": make([], "file_change_id string, hash string, num_lines_added int, num_lines_deleted int"),
        "method_change": make([], "method_change_id string, file_change_id string"),
        "cwe": make([("w",)], "cwe_id string"), "cwe_classification": make([("c", "v")], "cve_id string, cwe_id string"),
        "repository": make([("r",)], "repo_url string"),
    }
    with pytest.raises(ValueError) as error:
        integrity.verify(broken)
    message = str(error.value)
    assert "cve_id is not unique" in message and "cwe lacks" in message and "count rules" not in message


def test_incremental_ingest_restarts_without_gaps_or_repeats(spark, tmp_path):
    schema = "cve_id string, at timestamp"
    inbox = tmp_path / "in"
    inbox.mkdir()
    known = spark.createDataFrame([("old",)], "cve_id string")

    def deliver(name, *ids):
        (inbox / name).write_text("\n".join(json.dumps({"cve_id": i, "at": "2024-01-01T00:00:00Z"}) for i in ids))

    def start(event_time=None, place="a"):
        incremental_ingest(spark, str(inbox), schema, str(tmp_path / place), str(tmp_path / f"{place}-progress"), "cve_id",
                           known, event_time=event_time, files_per_batch=1).awaitTermination()
        return sorted(r.cve_id for r in spark.read.parquet(str(tmp_path / place)).collect())

    deliver("1.json", "x", "y", "old")
    assert start() == ["x", "y"]
    assert start() == ["x", "y"]
    deliver("2.json", "y", "z", "z")
    assert start() == ["x", "y", "z"]
    assert start(event_time="at", place="b") == ["x", "y", "z"]


def test_feed_documents_as_a_stream(spark, inputs):
    target = str(inputs / "stream")
    schema = "CVE_Items array<struct<cve:struct<CVE_data_meta:struct<ID:string>>,publishedDate:string>>"
    (inputs / "lines").mkdir()
    for at, item in enumerate(ADVISORIES[:3]):
        (inputs / "lines" / f"{at}.json").write_text(json.dumps({"CVE_Items": [item]}))
    incremental_ingest(spark, str(inputs / "lines"), schema, target, str(inputs / "p"), "publishedDate",
                       items="CVE_Items").awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_indented_feeds_as_a_stream_give_the_advisory_table(spark, inputs, rows):
    def ingest(target, lines):
        incremental_ingest(spark, str(inputs / "feed"), FEED, target, f"{target}-progress", "cve_id", items="CVE_Items",
                           lines=lines, rows=feed.advisories).awaitTermination()

    target = str(inputs / "stream")
    ingest(target, lines=False)
    batch = feed.advisories(feed.read_advisory_feed(spark, str(inputs / "feed")))
    assert rows(spark.read.schema(batch.schema).parquet(target)) == rows(batch)
    # Read as lines, such a file is an error, not an empty delivery.
    with pytest.raises(StreamingQueryException):
        ingest(str(inputs / "other"), lines=True)


def test_insert_if_absent_and_catalogue_tables(spark, tmp_path):
    target = str(tmp_path / "repos")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "repo_url string, n int")
    second = spark.createDataFrame([("b", 9), ("c", 2), ("c", 1)], "repo_url string, n int")
    assert not tables.table_exists(spark, target)
    tables.insert_if_absent(first, target, "repo_url", ["n"])
    tables.insert_if_absent(second, target, "repo_url", ["n"])
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [("a", 1), ("b", 1), ("c", 1)]
    assert not tables.table_exists(spark, "no_such_table")


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("fixes", "commits"):
        df = spark.range(200).select(F.col("id").cast("string").alias("hash"), F.lit(name).alias(f"{name}_v"))
        tables.write_table(df, name, buckets=4)
        assert tables.table_exists(spark, name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("fixes").join(spark.table("commits"), "hash")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("fixes", "commits"):
            spark.sql(f"DROP TABLE {name}")


def test_report_and_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "k string, n int")
    tables.write_report(df, str(tmp_path / "r"), [F.desc("n")], limit=2)
    files = list((tmp_path / "r").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().split() == ["k,n", "b,3", "c,2"]
    folder = tables.export_jsonl(df, str(tmp_path), "2024-05-02")
    assert folder.endswith("advisories-2024-05-02.jsonl") and spark.read.json(folder).count() == 3
    with pytest.raises(Exception):
        tables.write_tables({"r": df}, str(tmp_path))  # never writes over a table that is there


def test_shaping(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("x"), F.struct(F.lit("v").alias("y")).alias("d.z")).alias("a"))
    flat = shaping.flatten(df)
    assert flat.columns == ["a.x", "a.d.z.y"] and tuple(flat.first()) == (1, "v")
    aligned = shaping.align_schema(flat, "b string, `a.x` bigint, n int", missing="")
    assert tuple(aligned.first()) == ("", 1, None)
    text = spark.createDataFrame([("a_'b',\"c\"", 1)], "s string, n int")
    assert tuple(shaping.replace_all_strings(text, {"_": "-", "'": "", '"': "", ",": ""}).first()) == ("a-bc", 1)
    nulls = spark.createDataFrame([(None, None)], "n bigint, s string")
    assert tuple(shaping.fill_null(nulls, ["n"]).first()) == (0, None)
    assert shaping.to_text(nulls, ["n"]).first().n == "None"


def test_all_advisories_stay_unless_years_are_asked_for(spark, inputs, capsys):
    """The job by its arguments, with an advisory of 1999, one without a date and one with a bad one."""
    days = ("1999-05-01T00:00Z", None, "no date")
    odd = [json.loads(json.dumps(ADVISORIES[0])) | {"publishedDate": day} for day in days]
    for n, item in enumerate(odd):
        item["cve"]["CVE_data_meta"]["ID"] = f"CVE-1999-{n}"
    (inputs / "feed" / "2.json").write_text(json.dumps({"CVE_Items": odd}))

    dataset.main(["--feed", str(inputs / "feed" / "*.json"), "--catalog", str(inputs / "catalog.xml"),
                  "--snapshots", str(inputs / "snapshots.json"), "--output", str(inputs / "all")])
    odd_ones = lambda cve: {r.cve_id for r in cve.collect() if r.cve_id.startswith("CVE-1999")}
    assert odd_ones(tables.load_tables(spark, str(inputs / "all"))["cve"]) == {"CVE-1999-0", "CVE-1999-1", "CVE-1999-2"}
    assert re.search(r"\|\s*1\|\s*0\|", capsys.readouterr().out)


def test_one_limit_of_years_is_one_limit(spark):
    cve = spark.createDataFrame([("a", "1999-05-01"), ("b", None), ("c", "2016-01-01")], "cve_id string, day string") \
        .select("cve_id", F.col("day").cast("timestamp").alias("published_date"))
    kept = lambda **years: "".join(sorted(r.cve_id for r in feed.year_window(cve, **years).collect()))
    assert (kept(first=None, last=2010), kept(first=2002), kept(first=None)) == ("a", "c", "ac")


def test_a_report_of_all_rows_has_several_files(spark, tmp_path):
    assert reports.REPORTS["severity_summary"][2] is None
    df = spark.range(20_000).select((F.col("id") % 100).alias("n"), F.repeat(F.col("id").cast("string"), 50).alias("k"))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_report(df, str(tmp_path / "r"), [F.desc("n"), "k"], limit=None)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    files = sorted((tmp_path / "r").glob("*.csv"))
    lines = [line for file in files for line in file.read_text().splitlines()[1:]]
    assert len(files) > 1 and len(lines) == 20_000
    keys = [(-int(n), k) for n, k in (line.split(",") for line in lines)]
    assert keys == sorted(keys)


def test_five_reports_of_a_built_dataset(spark, inputs):
    built = dataset.build_dataset(str(inputs / "out"), **sources(spark, inputs))
    reports.write_reports(built, str(inputs / "reports"))
    got = {name: [line for file in (inputs / "reports" / name).glob("*.csv") for line in file.read_text().splitlines()]
           for name in reports.REPORTS}
    assert got["cwe_summary"][0] == "CWE,description,cve_count,commit_count,file_count"
    assert [line.split(",")[0] for line in got["cwe_summary"][1:]] == ["CWE-93", "CWE-94", "NVD-CWE-noinfo"]
    assert "CRLF & more" in got["cwe_summary"][1]
    assert got["dataset_summary_cve_cwe"][0] == "projects,cve_count,cwe_count" and len(got["dataset_summary_cve_cwe"]) == 3
    assert len(got["dataset_summary"]) == 2 and all(len(lines) >= 2 for lines in got.values())
