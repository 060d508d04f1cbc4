"""Deterministic sampling by hash order, quotas by largest remainder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def hash_order(seed: str, key: str) -> Column:
    return F.md5(F.concat(F.lit(seed + "-"), F.col(key).cast("string")))


def largest_remainder(counts: DataFrame, weight: str, total: int, *keys: str) -> DataFrame:
    """Seats per stratum in proportion to ``weight``: whole parts, then the largest remainders; ties by ``keys``.

    One window over the strata; their number must be small, the rows behind them need not be.
    """
    exact = F.col(weight) * F.lit(total) / F.sum(weight).over(W.partitionBy())
    floors = counts.withColumn("_exact", exact).withColumn("seats", F.floor("_exact").cast("int")).withColumn("_rest", F.round(F.col("_exact") - F.col("seats"), 9))
    missing = F.lit(total) - F.sum("seats").over(W.partitionBy())
    at = F.row_number().over(W.orderBy(F.desc("_rest"), *keys))
    return floors.withColumn("_missing", missing).withColumn("seats", F.col("seats") + (at <= F.col("_missing")).cast("int")).drop("_exact", "_rest", "_missing")


def take_per_stratum(rows: DataFrame, seats: DataFrame, strata: list[str], key: str, seed: str) -> DataFrame:
    """In each stratum the first ``seats`` rows by hash order; strata without seats give none.

    The rank filter is pushed into the sort, so rows beyond the largest quota are dropped before the shuffle.
    """
    rank = F.row_number().over(W.partitionBy(*strata).orderBy(hash_order(seed, key), key))
    bound = int(seats.agg(F.max("seats")).first()[0] or 0)
    ranked = rows.withColumn("rank", rank).where(F.col("rank") <= bound)
    return ranked.join(seats.select(*strata, "seats"), strata).where(F.col("rank") <= F.col("seats")).drop("seats")


def band_allocation(cells: list[tuple[str, str, int]], per_group: dict[str, int], shares: dict[str, float]) -> list[tuple[str, str, int]]:
    """Seats per (group, band) under availability: shares rounded down and capped, then one seat at a time to bands with room, the largest share first.

    Seats that a group cannot fill go to cells of other groups, one at a time to the cell with most room left.
    ``cells`` are (group, band, available); groups and bands are few by definition.
    """
    room = {(g, b): n for g, b, n in cells}
    out = {}
    for g, want in per_group.items():
        bands = sorted((b for h, b in room if h == g), key=lambda b: (-shares.get(b, 0), b))
        got = {b: min(room[g, b], int(want * shares.get(b, 0))) for b in bands}
        while sum(got.values()) < want:
            open_bands = [b for b in bands if got[b] < room[g, b]]
            if not open_bands:
                break
            for b in open_bands[: want - sum(got.values())]:
                got[b] += 1
        out |= {(g, b): n for b, n in got.items()}
    for _ in range(sum(per_group.values()) - sum(out.values())):
        cell = min(out, key=lambda c: (out[c] - room[c], c), default=None)
        if cell is None or out[cell] >= room[cell]:
            break
        out[cell] += 1
    return [(g, b, n) for (g, b), n in sorted(out.items())]


def staged_sample(rows: DataFrame, stages: list[tuple[str, Column, int]], total: int, key: str, seed: str) -> DataFrame:
    """Rows picked stage by stage, each stage up to its own number from those not picked before, then any up to ``total``.

    Each stage is a top-k by hash order (no full sort); out: ``key``, ``stage``.
    """
    picked = None
    for name, condition, n in [*stages, ("fill", F.lit(True), total)]:
        left = rows.where(condition).select(key)
        if picked is not None:
            left = left.join(picked, key, "left_anti")
        chosen = left.orderBy(hash_order(seed, key), key).limit(n).select(key, F.lit(name).alias("stage"))
        picked = chosen if picked is None else picked.unionByName(chosen)
    order = W.orderBy((F.col("stage") == "fill").cast("int"), hash_order(seed, key), key)
    return picked.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= total).drop("_at")
