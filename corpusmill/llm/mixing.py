"""Mixing sources to target weights."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import key
from ..operators.distributed import group_running_sum, replicate, require_at_most, salt_of

#: Sources a plan, a control table, may name.
MAX_SOURCES = 10_000
#: Parts of the mix in which weights are expressed; the longest period of a schedule.
RESOLUTION = 100_000


def mix_uses(sizes: DataFrame, plan: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", size_col: str = "n_tokens", salts: int = 64) -> DataFrame:
    """How often each document is used so that its source takes its target share.

    ``plan`` has ``source``, ``target_share``, ``max_repeats``, ``total_tokens``. Sources are
    compared without regard to case and white space at the ends. A source's documents are all
    used as often as fits its target, at most ``max_repeats`` times, and once more those that
    come first in a fixed random order, until the target is met to within half a document.

    Out: ``id_col``, ``source`` (as in the plan, else the plain form of the document's), ``n_tokens``,
    ``full_passes``, ``n_uses``, ``before`` (tokens of the source that precede it in the order) and
    ``source_tokens``. Documents of sources outside the plan, or without a source, have 0 uses.
    Null and negative sizes count as 0. A plan line with a null source or share asks for nothing;
    of plan lines with one plain name the last by name counts. Repeated ids are items of their own.
    """
    lines = plan_lines(plan)
    docs = sizes.select(F.col(id_col), F.coalesce(key(source_col), F.lit("")).alias("_source"), F.greatest(F.coalesce(F.col(size_col), F.lit(0)), F.lit(0)).cast("long").alias("n_tokens"))
    totals = source_totals(docs, lines)
    ordered = group_running_sum(docs, ["_source"], "n_tokens", [id_col], salt_on=["_source", id_col], salts=salts)
    salted = ordered.withColumn("_salt", salt_of(["_source", id_col], 16))
    joined = salted.join(replicate(totals.drop("n_documents"), 16), ["_source", "_salt"], "left")
    rest = F.col("target_tokens") - F.col("full_passes") * F.col("source_tokens")
    once_more = (F.col("full_passes") < F.col("max_repeats")) & (F.col("before") + F.col("n_tokens") / 2 <= rest)
    return joined.select(
        id_col,
        F.coalesce("source", "_source").alias("source"),
        "n_tokens",
        F.coalesce("full_passes", F.lit(0)).alias("full_passes"),
        F.coalesce(F.col("full_passes") + F.when(once_more, 1).otherwise(0), F.lit(0)).cast("int").alias("n_uses"),
        "before",
        "source_tokens",
    )


def plan_lines(plan: DataFrame) -> DataFrame:
    """The plan with the plain name ``_source`` and the target in tokens, one line per plain name."""
    return (
        plan.select("source", "target_share", "max_repeats", "total_tokens")
        .where(F.col("source").isNotNull())
        .groupBy(key("source").alias("_source"))
        .agg(F.max(F.struct("source", "target_share", "max_repeats", "total_tokens")).alias("l"))
        .select("_source", "l.source", F.coalesce("l.target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("l.max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"), (F.coalesce("l.target_share", F.lit(0.0)) * F.coalesce("l.total_tokens", F.lit(0))).alias("target_tokens"))
    )


def source_totals(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Every plan line with its source's size and the passes over it; a source without documents has size 0."""
    sizes = docs.groupBy("_source").agg(F.sum("n_tokens").alias("source_tokens"), F.count(F.lit(1)).alias("n_documents"))
    fits = F.floor(F.coalesce(F.col("target_tokens") / F.nullif(F.col("source_tokens"), F.lit(0)), F.lit(0.0)))
    return (
        lines.join(sizes, "_source", "left")
        .withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
        .withColumn("n_documents", F.coalesce("n_documents", F.lit(0)))
        .withColumn("full_passes", F.least(fits, F.col("max_repeats").cast("long")).cast("int"))
    )


def pfair_slots(blocks: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot): earliest deadline first among released blocks.

    With weight w = the source's share of all blocks, its block k (from 1) is released at slot
    floor((k-1)/w) and due by slot ceil(k/w). In every prefix of the schedule a source is then
    less than one block away from its share. Ties: the source with more blocks, then its name.
    """
    total = sum(blocks.values())
    release = [(0, s) for s, n in sorted(blocks.items()) if n]
    heapq.heapify(release)
    done = dict.fromkeys(blocks, 0)
    ready: list[tuple[int, int, str]] = []
    out = []
    for slot in range(total):
        while release and release[0][0] <= slot:
            _, s = heapq.heappop(release)
            k = done[s] + 1
            heapq.heappush(ready, (-(-k * total // blocks[s]), -blocks[s], s))
        _, _, s = heapq.heappop(ready)
        out.append((s, done[s], slot))
        done[s] += 1
        if done[s] < blocks[s]:
            heapq.heappush(release, (done[s] * total // blocks[s], s))
    return out


def weights(plan: DataFrame, resolution: int = RESOLUTION) -> dict[str, int]:
    """Slots of each source in one period of the schedule: its target share in parts of 1/``resolution``, without common factors.

    Shares of up to five decimals are exact at the default. A positive share gets a slot at least.
    """
    rows = require_at_most(plan_lines(plan).select("source", "target_share").where("target_share > 0"), MAX_SOURCES, "sources of the plan")
    parts = {r.source: max(1, round(r.target_share * resolution)) for r in rows}
    common = math.gcd(*parts.values()) if parts else 1
    return {s: n // common for s, n in parts.items()}


def mix_order(uses: DataFrame, plan: DataFrame, *, id_col: str = "doc_id", block_tokens: int = 1, resolution: int = RESOLUTION, salts: int = 16) -> DataFrame:
    """The mix as a stream: one row per use of a document, with the slot of its block and its place in the block.

    Out: ``id_col``, ``source``, ``copy`` (from 0), ``n_tokens``, ``source_tokens``, ``block``, ``slot``, ``offset``; read by (slot, offset).
    A source's uses follow each other, pass by pass; cut into blocks of ``block_tokens``, or of the largest
    document if that is more, a document belongs to the block in which it starts. Blocks get slots
    earliest deadline first (``pfair_slots``) from the target weights. At the end of every slot a
    source that has not run out is less than one block from its share of the slots, and so its tokens are less than one
    block and one document from its share of the tokens; slots of sources that ran out stay empty.

    Weights are whole numbers of slots in a period, at whose end every source has exactly its share. So the
    schedule repeats: one period is scheduled, its length bound by ``resolution`` whatever the size of the mix,
    and a block finds its slot by arithmetic and one lookup. ``uses`` is read twice: pass a table or a checkpoint.
    """
    spark = uses.sparkSession
    used = uses.where("n_uses > 0")
    block = max(1, block_tokens, used.agg(F.max("n_tokens")).first()[0] or 0)
    slots = weights(plan, resolution)
    period = sum(slots.values())
    schedule = spark.createDataFrame(pfair_slots(slots), "source string, _place long, _slot long")
    per = spark.createDataFrame(list(slots.items()), "source string, _per long")
    each = used.select(id_col, "source", "n_tokens", "before", "source_tokens", F.explode(F.sequence(F.lit(0), F.col("n_uses") - 1)).alias("copy"))
    at = F.col("copy") * F.col("source_tokens") + F.col("before")
    # At most MAX_SOURCES rows and resolution + MAX_SOURCES rows.
    placed = each.withColumn("_at", at).withColumn("block", F.floor(at / block)).join(F.broadcast(per), "source").withColumn("_place", F.pmod("block", "_per"))
    placed = placed.join(F.broadcast(schedule), ["source", "_place"])
    slot = F.floor(F.col("block") / F.col("_per")) * period + F.col("_slot")
    return placed.select(id_col, "source", "copy", "n_tokens", "source_tokens", "block", slot.alias("slot"), (F.col("_at") - F.col("block") * block).alias("offset"))


def mix_shares(order: DataFrame, uses: DataFrame, plan: DataFrame) -> DataFrame:
    """Per plan line, from the scheduled mix: target and actual share, tokens, blocks, last slot, the largest number of uses, and whether the source falls short.

    A source falls short if its scheduled tokens end below the target although every document is used as often as it may be.
    """
    got = order.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"), (F.max("copy") + 1).alias("most_uses"), (F.max("block") + 1).alias("n_blocks"), F.max("slot").alias("last_slot"))
    sizes = uses.groupBy("source").agg(F.max("source_tokens").alias("source_tokens"))
    joined = plan_lines(plan).join(got, "source", "left").join(sizes, "source", "left").fillna(0, ["used_tokens", "most_uses", "n_blocks", "source_tokens"])
    return joined.join(got.agg(F.sum("used_tokens").alias("_all")), how="cross").select(  # one row
        "source", "target_share", F.coalesce(F.col("used_tokens") / F.nullif(F.col("_all"), F.lit(0)), F.lit(0.0)).alias("actual_share"),
        F.round("target_tokens").cast("long").alias("target_tokens"), "used_tokens", "source_tokens", "most_uses", "n_blocks", "last_slot",
        ((F.col("used_tokens") < F.col("target_tokens")) & (F.col("source_tokens") * F.col("max_repeats") <= F.col("used_tokens"))).alias("falls_short"),
    )
