from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtrail.functions import code, diffs, paths, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("name, expected", [
    ("impact.baseMetricV3.cvssV3.vectorString", "cvss3_vector_string"),
    ("impact.baseMetricV2.cvssV2.baseScore", "cvss2_base_score"),
    ("impact.baseMetricV2.obtainAllPrivilege", "obtain_all_privilege"),
    ("cve.references.reference_data", "reference_json"),
    ("cve.problemtype.problemtype_data", "problemtype_json"),
    ("cve.description.description_data", "description"),
    ("configurations.nodes", "nodes"),
    ("publishedDate", "published_date"),
    ("cve_id", "cve_id"),
])
def test_snake_name(spark, name, expected):
    assert text.snake_name(name) == expected
    assert value(spark, text.snake_column(F.lit(name))) == expected


@pytest.mark.parametrize("number, expected", [
    (4500.0, "4.5K"), (4000.0, "4K"), (999.0, "999"), (1.25, "1.2"), (0.0, "0"), (2_500_000.0, "2.5M"),
    (3_000_000_000.0, "3B"), (-5.0, "-5"), (12_000_000_000_000_000.0, "12000000B"),
])
def test_short_number(spark, number, expected):
    assert value(spark, text.short_number(F.lit(number))) == expected


def test_hms_rounds_seconds_only(spark):
    assert tuple(value(spark, text.hms(F.lit(3725.6)))) == (1, 2, 6)


def test_days_between_is_never_negative(spark):
    stamp, day = F.lit("2020-01-10 23:00:00+00:00"), F.lit(date(2020, 1, 1))
    assert value(spark, text.days_between(F.substring(stamp, 1, 19).cast("timestamp"), day)) == 9
    assert value(spark, text.days_between(day, F.substring(stamp, 1, 19).cast("timestamp"))) == 9


@pytest.mark.parametrize("stored, expected", [
    ("nan", None), ("None", None), ("", None), ("0", 0.0), ("0.0", 0.0), ("10", 10.0), (None, None), ("x", None),
])
def test_markers_are_decoded_before_the_cast(spark, stored, expected):
    assert value(spark, text.decode(F.lit(stored).cast("string")).try_cast("double")) == expected


def test_mean_with_and_without_markers(spark):
    scores = spark.createDataFrame([(v,) for v in ("nan", "0", "0.0", "5.0", "10", "None", "2")], "s string")
    number = text.decode(F.col("s")).try_cast("double")
    row = scores.agg(text.mean_above_zero(number).alias("a"), text.mean_as_stored(F.col("s")).alias("b"),
                     text.mean_above_zero(number, F.lit(3)).alias("c")).first()
    assert (row.a, row.b, row.c) == (pytest.approx(17 / 3), pytest.approx(17 / 7), pytest.approx(17 / 3))


@pytest.mark.parametrize("literal, expected", [
    ("['CWE-1', ' CWE-2 ']", ["CWE-1", "CWE-2"]), ('["a"]', ["a"]), ("[]", []),
])
def test_parse_list(spark, literal, expected):
    assert value(spark, text.parse_list(F.lit(literal))) == expected


def test_clean_signature(spark):
    assert value(spark, text.clean_signature(F.lit("\t f ( int a ) \n"))) == "f(inta)"


def test_addresses(spark):
    url = F.lit("https://github.com/a/x.github.io.git")
    assert value(spark, paths.canonical_repo(url)) == "https://github.com/a/x.github.io"
    assert value(spark, paths.canonical_repo(url, first_mark=True)) == "https://github.com/a/x"
    assert value(spark, paths.last_segment(F.lit("https://github.com/a/b"))) == "b"
    assert value(spark, paths.owner_of(F.lit("https://github.com/a/b"))) == "a"
    assert value(spark, paths.owner_of(F.lit("b"))) is None
    assert value(spark, paths.with_git_suffix(F.lit("https://gitlab.com/a/b"))) == "https://gitlab.com/a/b"
    assert value(spark, paths.commit_url(F.lit("https://gitlab.com/a/b"), F.lit("1"))).endswith("/b/-/commit/1")
    assert value(spark, paths.commit_url(F.lit("https://github.com/a/b"), F.lit("1"))).endswith("/b/commit/1")


@pytest.mark.parametrize("start, end, expected", [(1, 1, "a"), (2, 3, "b\nc"), (3, 9, "c"), (5, 9, ""), (2, 1, "")])
def test_method_code(spark, start, end, expected):
    assert value(spark, code.method_code(F.lit("a\nb\nc"), F.lit(start), F.lit(end))) == expected


def test_method_code_of_missing_source(spark):
    assert value(spark, code.method_code(F.lit(None).cast("string"), F.lit(1), F.lit(2))) is None


@pytest.mark.parametrize("whole, expected", [
    ("", []), ("a", ["a"]), ("a\n", ["a"]), ("a\r\nb\n\n", ["a", "b", ""]), ("\n", [""]),
])
def test_text_lines(spark, whole, expected):
    assert value(spark, code.text_lines(F.lit(whole))) == expected


def test_measures(spark):
    source = F.lit("if (a && b) {\n\n  return x ? 1 : 2;\n}\n")
    assert value(spark, code.line_count(source)) == 3
    assert value(spark, code.token_count(source)) == 16
    assert value(spark, code.decision_count(source)) == 4


def test_surrogate_id_is_48_bits_and_stable(spark):
    ids = [value(spark, code.surrogate_id(F.lit("a"), F.lit("b"))) for _ in range(2)]
    assert ids[0] == ids[1] and 0 <= ids[0] < 1 << 48


def test_diff_texts(spark):
    diff = F.lit("-old 1\n+ new 1 \n same\n-old 2\n")
    assert value(spark, diffs.diff_dict(diff)).asDict() == {"added": ["new 1"], "deleted": ["old 1", "old 2"]}
    assert tuple(value(spark, diffs.single_change(diff))) == ("old 2", "new 1")
    assert tuple(value(spark, diffs.single_change(F.lit(" same")))) == (None, None)
    assert value(spark, diffs.join_changes(F.array(F.lit(" a "), F.lit("b")))) == "a b"
