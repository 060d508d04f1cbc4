"""Facet cube: counts and member lists over several sets of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Sets of keys that a facet row may have; each needs its own keys to be there.
MASKS = (("area_id",), ("domain_id",), ("domain_id", "subdomain_id"), ("area_id", "domain_id"), ("area_id", "domain_id", "subdomain_id"))


def _masked(facts: DataFrame, masks: tuple[tuple[str, ...], ...], keep: list[str]) -> DataFrame:
    """Each fact once per mask that it has all keys of, the other keys null: one pass over the facts."""
    keys = list(dict.fromkeys(k for m in masks for k in m))

    def row(i: int, mask: tuple[str, ...]) -> Column:
        whole = F.lit(True)
        for k in mask:
            whole = whole & F.col(k).isNotNull()
        return F.when(whole, F.struct(F.lit(i).alias("mask"), *[(F.col(k) if k in mask else F.lit(None).cast("string")).alias(k) for k in keys]))

    rows = F.array_compact(F.array(*[row(i, m) for i, m in enumerate(masks)]))
    return facts.select(F.explode(rows).alias("_m"), *keep).select("_m.*", *keep)


def facet_counts(facts: DataFrame, *, entity: str, by: str | None = None, masks: tuple[tuple[str, ...], ...] = MASKS, distinct_of: str | None = None) -> DataFrame:
    """Distinct ``entity`` per facet, and per facet and ``by`` where that is not null.

    Distinct, then counted: a null entity counts once. With ``distinct_of`` rows where that is null
    are left out first. Both steps aggregate before their shuffle, so a facet with
    a third of all facts is no hot spot. Out: ``mask``, keys, ``by`` (null: all), ``n``.
    """
    keys = list(dict.fromkeys(k for m in masks for k in m))
    rows = facts.where(F.col(distinct_of).isNotNull()) if distinct_of else facts
    cells = _masked(rows, masks, [entity, *([by] if by else [])])
    if by:
        both = F.array_compact(F.array(F.struct(F.lit(0).alias("g"), F.lit(None).cast("string").alias("v")), F.when(F.col(by).isNotNull(), F.struct(F.lit(1).alias("g"), F.col(by).alias("v")))))
        cells = cells.withColumn("_b", F.explode(both)).select("mask", *keys, F.col("_b.g").alias("_g"), F.col("_b.v").alias(by), entity)
        return cells.distinct().groupBy("mask", *keys, "_g", by).agg(F.count(F.lit(1)).alias("n")).drop("_g")
    return cells.distinct().groupBy("mask", *keys).agg(F.count(F.lit(1)).alias("n"))


def facet_members(facts: DataFrame, *, member: str, entity: str, masks: tuple[tuple[str, ...], ...] = MASKS, top: int = 500) -> DataFrame:
    """Per facet the members with the most distinct entities, at most ``top`` (a top-k report), and how many there are.

    Order: entities descending, then the member's name. The rank window drops members beyond ``top``
    before its shuffle; lists are bounded by ``top``.
    """
    keys = list(dict.fromkeys(k for m in masks for k in m))
    cells = _masked(facts.where(F.col(member).isNotNull()), masks, [member, entity]).distinct()
    per = cells.groupBy("mask", *keys, member).agg(F.count(F.lit(1)).alias("_n"))
    total = per.groupBy("mask", *keys).agg(F.count(F.lit(1)).alias("member_total"))
    at = W.partitionBy("mask", *keys).orderBy(F.desc("_n"), member)
    ranked = per.withColumn("_r", F.row_number().over(at)).where(F.col("_r") <= top)
    lists = ranked.groupBy("mask", *keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", member))), lambda x: x[member]).alias("members"))
    on = [lists.mask == total.mask, *[lists[k].eqNullSafe(total[k]) for k in keys]]
    return lists.join(total, on).select(lists.mask, *[lists[k] for k in keys], "members", "member_total")
