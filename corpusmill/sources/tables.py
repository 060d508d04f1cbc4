"""Readers of the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, its schema from the file's footer; columns and filters are pushed down by the caller's plan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
