import pytest
from pyspark.sql import functions as F

from corpusmill.operators.distributed import cut, group_rank, group_running_sum, latest, require_at_most


def test_group_rank_is_a_permutation(spark):
    df = spark.range(5_000).select((F.col("id") % 3 == 0).cast("int").alias("g"), "id")
    got = group_rank(df, ["g"], ["id"], salt_on=["id"], salts=7).groupBy("g").agg(F.count("rank").alias("n"), F.countDistinct("rank").alias("d"), F.min("rank").alias("a"), F.max("rank").alias("b")).collect()
    assert all(r.n == r.d == r.b and r.a == 1 for r in got)


def test_running_sum_adds_up(spark):
    df = spark.range(1_000).select(F.lit("x").alias("g"), "id", F.col("id").alias("v"))
    got = group_running_sum(df, ["g"], "v", ["id"], salt_on=["id"], salts=5).orderBy("before", "v").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.v


def test_latest_takes_one_row_in_full(spark):
    df = spark.createDataFrame([("a", 1, "p", "q"), ("a", 2, None, "z"), ("a", 2, "b", None), (None, None, "n", "n")], "k string, at int, x string, y string")
    assert {tuple(r) for r in latest(df, ["k"], ["at"]).collect()} == {("a", 2, "b", None), (None, None, "n", "n")}


def test_bound_is_an_error_and_cut_keeps_rows(spark):
    with pytest.raises(ValueError):
        require_at_most(spark.range(3), 2, "rows")
    assert cut(spark.range(3)).count() == 3
