"""Filling fixed-capacity containers with items."""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.distributed import group_rank, require_at_most

#: The plan has at most one entry per size, so the capacity bounds what the driver holds.
MAX_CAPACITY = 1 << 20


def plan_containers(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Packs a histogram of sizes; rows (size, first item, items per container, first container, containers).

    Large-item matching: items above a third of the capacity share a container with at most one
    other of them, each with the greatest that still fits, greatest items first. Smaller items,
    greatest first, then go where they leave the least room (best fit); new containers are
    opened only when no gap takes them. Equal items are planned together, so the work depends on
    the number of different sizes, not of items. Containers are numbered from 0.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)
    left = {s: n for s, n in counts.items() if n > 0 and 0 < s <= capacity}
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    bins = 0

    def place(size: int, per: int, first: int, n: int) -> None:
        plan.append((size, used[size], per, first, n))
        used[size] += per * n
        left[size] -= per * n
        if not left[size]:
            del left[size]

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        at = bisect.bisect_right(large, capacity - s) - 1
        if at < 0:
            n = left[s]
            gap = capacity - s
            place(s, 1, bins, n)
        elif large[at] == s:
            n = left[s] // 2
            gap = capacity - 2 * s
            if n:
                place(s, 2, bins, n)
            elif at:  # the last of its size takes a smaller partner
                n, t = 1, large[at - 1]
                gap = capacity - s - t
                place(s, 1, bins, 1)
                place(t, 1, bins, 1)
            else:
                n, gap = 1, capacity - s
                place(s, 1, bins, 1)
        else:
            t = large[at]
            n = min(left[s], left[t])
            gap = capacity - s - t
            place(s, 1, bins, n)
            place(t, 1, bins, n)
        if n:
            if gap:
                gaps[gap].append((bins, n))
            bins += n
        large = [x for x in large if x in left]

    open_gaps = sorted(gaps)
    for s in sorted(left, reverse=True):
        while s in left:
            at = bisect.bisect_left(open_gaps, s)
            if at == len(open_gaps):
                gap, first, n = capacity, bins, -(-left[s] // (capacity // s))
                bins += n
            else:
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    open_gaps.pop(at)
            per = gap // s
            full = min(n, left[s] // per)
            runs = [(first, full, per)] if full else []
            if full < n and (rest := left[s] - full * per):
                runs.append((first + full, 1, rest))
            for start, m, k in runs:
                place(s, k, start, m)
            touched = sum(m for _, m, _ in runs)
            for start, m, room in [(a, m, gap - k * s) for a, m, k in runs] + [(first + touched, n - touched, gap)]:
                if m and room:
                    if not gaps[room]:
                        bisect.insort(open_gaps, room)
                    gaps[room].append((start, m))
    return plan


def pack(sizes: DataFrame, capacity: int, *, id_col: str = "doc_id", size_col: str = "n_tokens", salts: int = 64) -> DataFrame:
    """A container for each document, or for each piece of a document larger than ``capacity``.

    Out: ``id_col``, ``piece`` (from 0), ``n_pieces``, ``first_token``, ``piece_tokens``, ``container``.
    A larger document is cut into full pieces, which fill a container each, and a remainder, which
    is packed like a document; no other is split. Null and non-positive sizes take no room and go
    to container 0. Repeated ids are items of their own. An empty table gives an empty result.
    ``sizes`` is read several times: pass a table or a checkpoint, not a tokenizer's output.

    The containers are planned on the histogram of sizes (at most ``capacity`` rows, whatever the
    number of documents); items find their place by their rank among items of their size.
    """
    if not 0 < capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must be between 1 and {MAX_CAPACITY}")
    spark = sizes.sparkSession
    n = F.coalesce(F.greatest(F.col(size_col), F.lit(0)), F.lit(0)).cast("long")
    base = sizes.select(F.col(id_col), n.alias("_n"), F.monotonically_increasing_id().alias("_item"))
    pieces = F.greatest(F.ceil(F.col("_n") / capacity), F.lit(1)).cast("int")
    items = base.select(id_col, "_item", "_n", pieces.alias("n_pieces"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece")).select(
        id_col, "_item", "piece", "n_pieces",
        (F.col("piece").cast("long") * capacity).alias("first_token"),
        F.least(F.col("_n") - F.col("piece").cast("long") * capacity, F.lit(capacity)).alias("piece_tokens"),
    )
    counts = {r[0]: r[1] for r in require_at_most(items.groupBy("piece_tokens").agg(F.count(F.lit(1))), capacity + 1, "histogram of sizes")}
    by_size: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for size, first_item, per, first, _ in plan_containers(counts, capacity):
        by_size[size].append((first_item, per, first))
    flat = [(s, *row) for s in sorted(by_size) for row in sorted(by_size[s])]
    # One sorted key for (size, first item): sizes are at most 2**20, ranks below 2**42.
    shared = spark.sparkContext.broadcast((np.array([(s << 42) + a for s, a, _, _ in flat], dtype="int64"), np.array([a for _, a, _, _ in flat], dtype="int64"), np.array([p for _, _, p, _ in flat], dtype="int64"), np.array([b for _, _, _, b in flat], dtype="int64")))

    @F.pandas_udf("long")
    def container(size: pd.Series, rank: pd.Series) -> pd.Series:
        starts, first, per, bins = shared.value
        item = rank.to_numpy() - 1
        if not len(starts):
            return pd.Series(np.zeros(len(item), dtype="int64"))
        at = np.maximum(np.searchsorted(starts, (size.to_numpy() << 42) + item, side="right") - 1, 0)
        return pd.Series(np.where(size.to_numpy() > 0, bins[at] + (item - first[at]) // per[at], 0))

    ranked = group_rank(items, ["piece_tokens"], ["_item", "piece"], salt_on=["_item", "piece"], salts=salts, name="_rank")
    return ranked.select(id_col, "piece", "n_pieces", "first_token", "piece_tokens", container("piece_tokens", "_rank").alias("container"))


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, tokens, mean fill, documents split, and the fewest containers that any packing needs."""
    fills = packed.groupBy("container").agg(F.sum("piece_tokens").alias("fill"), F.count_if((F.col("n_pieces") > 1) & (F.col("piece") == 0)).alias("split"))
    return fills.agg(
        F.count(F.lit(1)).alias("n_containers"),
        F.sum("fill").alias("n_tokens"),
        F.round(F.sum("fill") / (F.count(F.lit(1)) * F.lit(capacity)), 6).alias("mean_fill"),
        F.max("fill").alias("largest_fill"),
        F.sum("split").alias("n_split"),
        F.ceil(F.sum("fill") / F.lit(capacity)).alias("least_containers"),
    )


def split_documents(packed: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Documents whose pieces were placed in more than one container, and the first and last of these."""
    placed = packed.groupBy(id_col).agg(F.min("container").alias("first_container"), F.max("container").alias("last_container"))
    return placed.where("first_container <> last_container")
