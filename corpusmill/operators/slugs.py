"""Unique slugs in a fixed order of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .distributed import cut


def free_slugs(rows: DataFrame, base: str, order: list[str], *, rounds: int = 1_000) -> DataFrame:
    """Adds ``slug``: ``base``, or ``base-2``, ``base-3`` and so on, the first that no row before in ``order`` (a unique key) has.

    Rows of one base start with their places among each other. Then all rows claim their slugs at once; of several
    the first in order keeps it and the others take their next numbers, as do the rows of the same base after them, until
    no slug is claimed twice. That is the result of going through the rows one by one, in as many rounds as names
    such as ``a-2`` beside ``a`` lean on each other, mostly one. A null base counts as empty.
    """
    key = F.struct(*order)
    by_base = W.partitionBy("_base").orderBy(*order)
    now = rows.withColumn("_base", F.coalesce(F.col(base), F.lit(""))).withColumn("_at", F.row_number().over(by_base)).withColumn("_lost", F.lit(0))
    for _ in range(rounds):
        lost = F.sum("_lost").over(by_base.rowsBetween(W.unboundedPreceding, 0))
        placed = now.withColumn("_n", F.col("_at") + lost)
        placed = placed.withColumn("slug", F.when(F.col("_n") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.col("_n").cast("string"))))
        firsts = placed.groupBy("slug").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_claims"))
        checked = cut(placed.join(firsts, "slug").withColumn("_loses", (F.col("_claims") > 1) & (key != F.col("_first"))))
        if checked.where("_loses").isEmpty():
            return checked.select(*rows.columns, "slug")
        now = checked.withColumn("_lost", F.col("_lost") + F.col("_loses").cast("int")).drop("slug", "_first", "_claims", "_loses", "_n")
    raise ValueError(f"slugs still clash after {rounds} rounds")
