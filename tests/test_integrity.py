import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.integrity import orphan_references

DAY = dt.datetime(2024, 1, 1)
LATER = dt.datetime(2024, 6, 1)


def kinds(df, *cols):
    return sorted((tuple(r[c] for c in cols), r["kind"]) for r in df.collect())


def test_missing_deleted_and_late(spark):
    targets = spark.createDataFrame([("a", DAY, None), ("b", DAY, LATER), ("c", LATER, None), ("d", DAY, LATER), ("d", LATER, None), (None, DAY, None)], "k string, created timestamp, deleted timestamp")
    refs = spark.createDataFrame([(x, DAY) for x in "abcdz"] + [("z", DAY), (None, DAY), ("c", LATER), ("c", None)], "k string, seen timestamp")
    found = orphan_references(refs, ["k"], targets, observed_at="seen", created_at="created", deleted_at="deleted")
    assert kinds(found, "k") == [(("b",), "deleted"), (("c",), "late"), (("d",), "late"), (("z",), "missing"), (("z",), "missing")]


@pytest.mark.parametrize("match, want", [
    ("simple", [((9, 9), "missing")]),
    ("partial", [((7, None), "missing"), ((9, 9), "missing")]),
    ("full", [((1, None), "missing"), ((7, None), "missing"), ((9, 9), "missing")]),
])
def test_composite_keys_by_null_mask(spark, match, want):
    targets = spark.createDataFrame([(1, 2), (None, 9)], "a int, b int")
    refs = spark.createDataFrame([(1, 2), (1, None), (7, None), (None, None), (9, 9)], "x int, y int")
    assert kinds(orphan_references(refs, ["x", "y"], targets, ["a", "b"], match=match), "x", "y") == want


def test_clashing_columns_and_empty_tables(spark):
    refs = spark.createDataFrame([("a", 1, {"x": 1}), ("b", 2, None)], "`_salt` string, kind2 int, m map<string,int>")
    none = spark.createDataFrame([], "k string")
    found = orphan_references(refs, ["_salt"], none, ["k"])
    assert found.columns == ["_salt", "kind2", "m", "kind"] and found.count() == 2
    assert orphan_references(refs.limit(0), ["_salt"], none, ["k"]).count() == 0


def test_hot_key_is_spread(spark):
    refs = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    assert orphan_references(refs, ["k"], spark.createDataFrame([("hot",)], "k string")).count() == 20_000
