"""Edits and checks of a taxonomy of areas and domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def edit_taxonomy(dim: DataFrame, edits: DataFrame, *, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """The taxonomy (``area_name``, ``domain_name``, ``definition``) after ``edits``, and the edits that were refused.

    ``edits``: ``action`` (``append`` to a definition or ``add`` a domain), ``area_name``, ``domain_name``, ``definition``, ``at`` (their order).
    Appended texts follow the definition, trailing white space off, after two spaces, in order. Refused, with a reason: an ``append`` to a domain that is
    not there, an ``add`` of one that is (or was added before), and one to an area that has ``most`` domains or is unknown.
    """
    keys = ["area_name", "domain_name"]
    there = dim.select(*keys).distinct().withColumn("_there", F.lit(True))
    sizes = dim.groupBy("area_name").agg(F.count(F.lit(1)).alias("_size"))
    known = edits.join(there, keys, "left").join(sizes, "area_name", "left")
    adds = known.where("action = 'add'").withColumn("_again", F.row_number().over(W.partitionBy(*keys).orderBy("at")))
    new = F.col("_there").isNull() & (F.col("_again") == 1) & F.col("_size").isNotNull()
    # Edits are a control table; an area has at most ``most`` domains.
    adds = adds.withColumn("_place", F.col("_size") + F.sum(new.cast("int")).over(W.partitionBy("area_name").orderBy("at").rowsBetween(W.unboundedPreceding, 0)))
    reason = F.when(F.col("_size").isNull(), "unknown area").when(~new, "duplicate domain").when(F.col("_place") > most, "area is full")
    adds = adds.withColumn("reason", reason)
    appends = known.where("action = 'append'").withColumn("reason", F.when(F.col("_there").isNull(), "unknown domain"))
    texts = appends.where("reason IS NULL").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", F.trim("definition").alias("t")))).alias("_texts"))
    trimmed = F.rtrim(F.coalesce("definition", F.lit("")))
    longer = dim.join(texts, keys, "left").withColumn("definition", F.when(F.col("_texts").isNull(), F.col("definition")).otherwise(F.concat_ws("  ", F.array(trimmed), F.transform("_texts", lambda x: x["t"])))).drop("_texts")
    edited = longer.select(*keys, "definition").unionByName(adds.where("reason IS NULL").select(*keys, "definition"))
    cols = ["action", *keys, "reason"]
    return edited, adds.where("reason IS NOT NULL").select(*cols).unionByName(appends.where("reason IS NOT NULL").select(*cols))
