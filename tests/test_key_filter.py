"""Exact membership in the row, and the plans that rest on it."""

import random

import pytest
from pyspark.sql import functions as F

from fixtrail.operators import changes, key_filter, linking


@pytest.mark.parametrize("listed, bits", [(10_000, 10), (5, 10), (5, 2), (0, 3)])
def test_the_cascade_is_exact(spark, monkeypatch, listed, bits):
    """Few bits let many keys pass by chance, so that several levels are needed."""
    monkeypatch.setattr(key_filter, "BITS", bits)
    numbers = random.Random(1).sample(range(10**9), 6_000)
    inside, outside = ([f"k{n}" for n in part] for part in (numbers[:2_000], numbers[2_000:]))
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    found = key_filter.key_cascade(frame(inside), frame(outside), "key", listed=listed)
    rows = spark.createDataFrame([(k,) for k in inside + outside + [None]], "key string")
    got = {r.key for r in rows.where(found(F.col("key"))).collect()}
    assert got == set(inside)
    assert key_filter.key_cascade(frame(inside), frame(outside), "key", most=1_999) is None


def test_the_cascade_of_no_keys(spark):
    none = spark.createDataFrame([], "key bigint")
    some = spark.createDataFrame([(n,) for n in range(50)], "key bigint")
    assert some.where(key_filter.key_cascade(none, some, "key")(F.col("key"))).count() == 0
    assert some.where(key_filter.key_cascade(some, none, "key", listed=3)(F.col("key"))).count() == 50


def test_pending_rows_do_not_move(spark, monkeypatch):
    wide = spark.createDataFrame([(str(n % 300) if n % 50 else None, f"text {n}") for n in range(900)], "hash string, source string")
    loaded = spark.createDataFrame([(str(n),) for n in range(100, 5_000)] * 2, "hash string")
    want = sorted(r.source for r in wide.collect() if r.hash is None or int(r.hash) < 100)
    monkeypatch.setattr(key_filter, "LISTED", 10)
    monkeypatch.setattr(linking.key_cascade, "__defaults__", (key_filter.MOST, 10))
    pending = linking.pending_rows(wide, loaded, "hash")
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted(r.source for r in pending.collect()) == want
    monkeypatch.setattr(linking.key_cascade, "__defaults__", (20, 10))
    assert sorted(r.source for r in linking.pending_rows(wide, loaded, "hash").collect()) == want


METHOD = ("array<struct<name:string,long_name:string,parameters:array<string>,start_line:int,end_line:int,nloc:int,"
          "complexity:int,token_count:int,top_nesting_level:int>>")


def test_maintainability_is_the_same_inside_the_row(spark, rows):
    draw = random.Random(4)

    def methods():
        if draw.random() < 0.1:
            return None
        return [(draw.choice(["f", "g", changes.ANONYMOUS, None]), "l", draw.choice([None, [], ["a"], ["a", "b", "c"]]), 1, 2,
                 draw.choice([None, 1, 15, 16, 40]), draw.choice([None, 1, 5, 6]), 3, 0) for _ in range(draw.randrange(5))]

    files = spark.createDataFrame(
        [(n, f"h{n // 3}", draw.choice([None, "x\ny"]), draw.choice([None, "x\ny"]), methods(), methods()) for n in range(240)],
        f"file_change_id bigint, hash string, source_code string, source_code_before string, methods {METHOD}, "
        f"methods_before {METHOD}").withColumn("diff_parsed", F.lit(None).cast(
            "struct<added:array<struct<line:int,text:string>>,deleted:array<struct<line:int,text:string>>>"))
    flat = changes.method_rows(files, changed_only=False).withColumn(
        "parameter_count", F.coalesce(F.size("parameters"), F.lit(0)))
    got = changes.nested_maintainability(files)
    assert rows(got) == rows(changes.maintainability(flat, files)) and got.count() > 50
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
