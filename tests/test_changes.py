import random

import pytest
from pyspark.sql import functions as F

from fixtrail.operators import changes as C
from fixtrail.operators import diffs as D


def test_changed_methods_against_brute_force(spark, rows):
    """Spans within, across and over many bins of lines; one file holds most rows."""
    rng = random.Random(3)
    files = ["hot"] * 8 + ["x", "y"]
    lines = [(rng.choice(files), rng.random() < 0.5, rng.randrange(0, 3000)) for _ in range(60)]
    spans = set()
    for _ in range(300):
        start = rng.randrange(0, 3000)
        spans.add((rng.choice(files), rng.random() < 0.5, start, start + rng.choice([0, 1, 62, 63, 64, 65, 200, 900])))
    expected = sorted(
        (s for s in spans if any(s[:2] == n[:2] and s[2] <= n[2] <= s[3] for n in lines)), key=repr)
    got = C.changed_methods(
        spark.createDataFrame(lines, "file_change_id string, before_change boolean, line int"),
        spark.createDataFrame(list(spans), "file_change_id string, before_change boolean, start_line int, end_line int"))
    assert rows(got) == expected


@pytest.mark.parametrize("line, hit", [(0, True), (63, True), (64, False)])
def test_edges_of_a_bin(spark, line, hit):
    lines = spark.createDataFrame([("f", True, line)], "file_change_id string, before_change boolean, line int")
    spans = spark.createDataFrame([("f", True, 0, 63)],
                                  "file_change_id string, before_change boolean, start_line int, end_line int")
    assert (C.changed_methods(lines, spans).count() == 1) is hit


METHODS = "file_change_id string, hash string, nloc int, complexity int, parameter_count int, before_change boolean"


@pytest.mark.parametrize("methods, size", [
    ([("f", "h", 10, 1, 0, False)], 1.0),                                   # low-risk code was added
    ([("f", "h", 20, 1, 0, False)], 0.0),                                   # high-risk code was added
    ([("f", "h", 20, 1, 0, True), ("f", "h", 15, 1, 0, False)], 1.0),       # high became low
    ([("f", "h", 10, 1, 0, True), ("f", "h", 10, 1, 0, False)], None),      # no movement
    ([("f", "h", 10, 1, 0, False), ("g", "h", 30, 1, 0, False)], 0.25),
])
def test_maintainability(spark, methods, size):
    df = spark.createDataFrame(methods, METHODS)
    files = df.select("file_change_id", "hash").distinct()
    assert C.maintainability(df.drop("hash"), files).first()["dmm_unit_size"] == size


def test_languages_of_short_and_empty_texts(spark):
    samples = spark.createDataFrame(
        [("the quick brown fox and the dog",  "en"), ("le renard brun et le chien la", "fr"), ("xx", None)],
        "text string, lang string")
    model = C.train_language(samples, ["en", "fr"])
    assert model.count() == C.FEATURES
    texts = spark.createDataFrame([(1, "the dog and the fox"), (2, "le chien et la"), (3, "ab"), (4, None), (5, "  \n")],
                                  "id int, text string")
    got = {r.id: r.programming_language for r in C.label_language(texts, model, "id", "text").collect()}
    assert got == {1: "en", 2: "fr", 3: C.UNKNOWN, 4: C.UNKNOWN, 5: C.UNKNOWN}


def test_line_numbers_of_a_diff(spark, rows):
    diff = " a\n-b  \n+c\n+d\n\\ No newline at end of file\n-e\n f"
    df = spark.createDataFrame([(1, diff)], "id int, diff string")
    assert rows(D.number_diff(df, "id")) == [
        (1, "+", 2, "c"), (1, "+", 3, "d"), (1, "-", 2, "b"), (1, "-", 3, "e")]


TEXTS = "id int, before_change boolean, text string"


def changed(df):
    return sorted((r.before_change, r.line) for r in df.collect())


def test_line_diff(spark):
    texts = spark.createDataFrame([(1, True, "a\n\nb\na\n"), (1, False, "\na\nc")], TEXTS)
    assert changed(D.line_diff(texts, ["id"])) == [(False, "c"), (True, "a"), (True, "b")]


def test_equal_texts_have_no_diff(spark):
    texts = spark.createDataFrame([(1, side, "x\n\n\ny\nx") for side in (True, False)], TEXTS)
    assert D.line_diff(texts, ["id"]).count() == 0


def test_diff_of_texts_in_one_row(spark):
    pairs = spark.createDataFrame([(1, "a\nb", "b\nc"), (2, None, "x"), (3, "", "")], "id int, old string, new string")
    got = sorted((r.id, r.before_change, r.line) for r in D.pair_diff(pairs, ["id"], "old", "new").collect())
    assert got == [(1, False, "c"), (1, True, "a"), (2, False, "x")]


VERSIONS = "method_change_id string, file_change_id string, name string, start_line int, before_change boolean, code string"


def versions(spark):
    return spark.createDataFrame([
        ("b1", "f", "m", 1, True, "x\ny"), ("b2", "f", "m", 9, True, "p"), ("b3", "f", "only", 20, True, "q"),
        ("a1", "f", "m", 1, False, "x\n  z "), ("a2", "f", "m", 12, False, "p"),
        ("c1", "g", "m", 1, True, "x"), ("c2", "g", "m", 1, False, "w"),
    ], VERSIONS)


def test_methods_pair_by_name_and_occurrence(spark, rows):
    pairs = D.pair_methods(versions(spark)).select("before_id", "after_id")
    assert rows(pairs) == [("b1", "a1"), ("b2", "a2"), ("c1", "c2")]


def test_spread_pairing_gives_the_same_pairs(spark, rows):
    """One name of one file holds most rows."""
    methods = spark.range(400).select(
        F.concat(F.lit("m"), "id").alias("method_change_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("f").alias("file_change_id"),
        F.lit("x").alias("name"), (F.col("id") * 7 % 50).cast("int").alias("start_line"),
        (F.col("id") % 5 < 2).alias("before_change"), F.concat(F.lit("code"), "id").alias("code"))
    pairs = rows(D.pair_methods(methods))
    assert len(pairs) > 100 and rows(D.pair_methods(methods, spread=True)) == pairs


def test_adjacent_rows_pair_by_position(spark, rows):
    pairs = D.pair_adjacent(versions(spark), ["file_change_id", "before_change", "method_change_id"], ["before_change"])
    # b1-b2 share file and name, b3-a1 and a2-c1 do not, c2 is left over.
    assert rows(pairs.select("first_id", "second_id")) == [("b1", "b2")]


def test_patches_keep_unchanged_pairs(spark, rows):
    files = spark.createDataFrame([("f", "C"), ("g", "Go")], "file_change_id string, programming_language string")
    got = rows(D.method_patches(versions(spark), files, "C"))
    assert got == [("f", "m", 1, "z", "y"), ("f", "m", 2, "", "")]


def test_parsed_diff_as_struct_and_as_json(spark):
    native = spark.range(1).select(F.struct(
        F.array(F.struct(F.lit(3).alias("line"), F.lit("x").alias("text"))).alias("added"),
        F.array().cast("array<struct<line:int,text:string>>").alias("deleted")).alias("diff_parsed"))
    for df in (native, native.select(F.to_json("diff_parsed").alias("diff_parsed"))):
        row = D.parse_diff(df).first()
        assert [tuple(e) for e in row.diff_added] == [(3, "x")] and row.diff_deleted == []


def test_changed_methods_of_a_file_against_brute_force(spark):
    """Lines of 0 and below, touching bounds, repeated spans, one very large file."""
    rng = random.Random(9)
    files = []
    for i in range(12):
        length = 3000 if i == 5 else 300
        source = "\n".join(f"line {n}" for n in range(length))
        methods = [(n, n, [], s, s + rng.randrange(-2, 40), 1, 1, 1, 0)
                   for n, s in ((f"m{j % 15}" if j % 5 else C.ANONYMOUS, rng.randrange(-3, length - 20))
                                for j in range(900 if i == 5 else 20))]
        methods += methods[:3]
        lines = [(rng.randrange(-3, length), "x") for _ in range(600 if i == 5 else 4)] + [(methods[3][3], "y")]
        files.append((i, source, source if i % 4 else None, methods, methods[:10] if i % 5 else None,
                      (lines, lines[:2] if i % 3 else None)))
    method = ("array<struct<name:string,long_name:string,parameters:array<string>,start_line:int,end_line:int,nloc:int,"
              "complexity:int,token_count:int,top_nesting_level:int>>")
    line = "array<struct<line:int,text:string>>"
    df = spark.createDataFrame(files, f"file_change_id bigint, source_code string, source_code_before string, methods {method}, "
                                      f"methods_before {method}, diff_parsed struct<added:{line},deleted:{line}>")
    want = []
    for i, after, before, methods, methods_before, (added, deleted) in files:
        for source, found, changed, flag in ((after, methods, added, False), (before, methods_before, deleted, True)):
            want += [(i, m[0], m[3], m[4], flag) for m in found or () if m[0] != C.ANONYMOUS and source is not None
                     and any(m[3] <= n <= m[4] for n, _ in changed or ())]
    got = C.method_rows(df).select("file_change_id", "name", "start_line", "end_line", "before_change").collect()
    assert want and sorted(map(tuple, got)) == sorted(want)


def test_labels_in_the_row_are_those_of_the_join(spark, rows):
    texts = spark.createDataFrame([(1, "def f(x): return x"), (2, "int main() { return 0; }"), (3, "ab"), (4, None)],
                                  "key int, text string")
    samples = spark.createDataFrame([("def g(y): yield y", "py"), ("int f(int a) { return a; }", "c")],
                                    "text string, lang string")
    model = C.train_language(samples, ["py", "c"])
    label = C.language_of(model)
    got = rows(texts.select("key", label(F.col("text")).alias("programming_language")))
    assert got == rows(C.label_language(texts, model, "key", "text"))
    with pytest.raises(ValueError):
        C.language_of(model.where("feature > 5"))
