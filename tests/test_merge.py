"""Upsert: matches, inserts, NULL keys, repeated keys."""

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import upsert


def frame(spark, rows, names="k long, j long, v string, w string"):
    return spark.createDataFrame(rows, names)


def test_upsert_of_composite_keys(spark):
    target = frame(spark, [(1, 1, "a", "x"), (1, 2, "b", "x"), (None, 1, "n", "x"), (3, 3, "c", "x"), (3, 3, "c", "x")])
    source = spark.createDataFrame([("A", 1, 1, 9), ("new", 2, 7, 9), ("new", 2, 7, 9), ("N", None, 1, 9), ("C", 3, 3, 9)], "v string, k int, j int, extra int")
    got = sorted(map(tuple, upsert(target, source, ["k", "j"], ["v"]).collect()), key=str)
    want = [(1, 1, "A", "x"), (1, 2, "b", "x"), (None, 1, "n", "x"), (3, 3, "C", "x"), (3, 3, "C", "x"),
            (2, 7, "new", None), (2, 7, "new", None), (None, 1, "N", None)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("columns", [["k"], ["v"], ["w"], []])
def test_repeated_source_key_fails_whatever_is_read(spark, columns):
    target = frame(spark, [(1, 0, "x", "x"), (2, 0, "y", "y")])
    merged = upsert(target, frame(spark, [(1, 0, "p", "p"), (1, 0, "q", "q")]), ["k"], ["v"])
    with pytest.raises(Exception, match="several source rows"):
        merged.select(*columns).collect() if columns else merged.count()


def test_upsert_with_empty_sides(spark):
    rows = frame(spark, [(1, 0, "x", "x"), (None, 0, "y", "y")])
    none = rows.where("false")
    assert upsert(rows, none, ["k"], ["v"]).exceptAll(rows).count() == 0
    assert upsert(none, rows, ["k"], ["v"]).exceptAll(rows).count() == 0
    assert upsert(rows, rows.withColumn("v", F.lit(None).cast("string")), ["k"], ["v"]).where("v IS NULL").count() == 2
