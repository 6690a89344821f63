import itertools

from pyspark.sql import functions as F

from fixtrail.ranking import running_total


def test_row_numbers_over_a_total_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    numbered = running_total(df, [F.desc("v")], "n").collect()
    assert {row.v: row.n for row in numbered} == {v: 1000 - v for v in range(1000)}


def test_totals_of_a_group_that_spans_partitions(spark):
    """One group holds most rows; NULL is a group of its own."""
    data = [("hot" if i % 10 else ("a" if i % 20 else None), i, i % 4) for i in range(600)]
    df = spark.createDataFrame(data, "g string, v int, w int")
    got = {(r.g, r.v): r.t for r in running_total(df, ["v"], "t", group=["g"], weight="w").collect()}
    expected = {}
    for group in ("hot", "a", None):
        mine = [(v, w) for g, v, w in sorted(data, key=lambda d: d[1]) if g == group]
        for (v, _), total in zip(mine, itertools.accumulate(w for _, w in mine)):
            expected[(group, v)] = total
    assert got == expected


def test_empty_input(spark):
    assert running_total(spark.range(0), ["id"], "n").count() == 0
