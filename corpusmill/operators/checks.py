"""Assertions over tables as one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(name: str, df: DataFrame, measure: Column, passes: str) -> DataFrame:
    """One row: ``check``, ``pass``, ``detail``; ``passes`` is a condition over ``value``, the measure of ``df``."""
    return df.agg(measure.cast("long").alias("value")).select(F.lit(name).alias("check"), F.expr(passes).alias("pass"), F.col("value").cast("string").alias("detail"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def unique(name: str, df: DataFrame, *key: str) -> DataFrame:
    return check(name, df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), F.count(F.lit(1)), "value = 0")


def referenced(name: str, df: DataFrame, key: str, target: DataFrame, target_key: str) -> DataFrame:
    missing = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k")).distinct().join(target.select(F.col(target_key).alias("_k")), "_k", "left_anti")
    return check(name, missing, F.count(F.lit(1)), "value = 0")


def none_where(name: str, df: DataFrame, condition: Column) -> DataFrame:
    return check(name, df, F.count_if(condition), "value = 0")
