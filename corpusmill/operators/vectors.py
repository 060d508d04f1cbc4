"""Vector operators over array columns; all arithmetic in doubles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .distributed import require_at_most

#: Centroids that a scan may carry along; each is one vector.
MAX_CENTROIDS = 10_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def length(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    n = F.nullif(length(a), F.lit(0.0))
    return F.transform(a, lambda x: x.cast("double") / n)


def centroids(vectors: DataFrame, group: str, vector: str, *, normalise: bool = True) -> DataFrame:
    """Mean vector per group, of unit length if asked; groups and vectors that are null are left out.

    Vectors are added position by position before the shuffle, so a group's size does not matter.
    """
    each = vectors.where(F.col(group).isNotNull()).select(group, F.posexplode(vector).alias("pos", "x"))
    means = each.groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    out = means.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"), F.max("n").alias("n"))
    return out.withColumn("centroid", unit(F.col("centroid"))) if normalise else out


def nearest_centroids(vectors: DataFrame, cents: DataFrame, *, id_col: str, vector: str, group: str, k: int = 1) -> DataFrame:
    """The ``k`` most similar centroids (dot product) of each vector: ``id_col``, ``group``, ``similarity``, ``rank``.

    Ties go to the smaller group. The centroids, at most ``MAX_CENTROIDS``, travel with the task and
    a batch of vectors is one matrix product; no pair of vector and centroid becomes a row.
    """
    rows = sorted(require_at_most(cents.select(group, "centroid"), MAX_CENTROIDS, "centroids"), key=lambda r: r[0])
    names = [r[0] for r in rows]
    matrix = np.array([r[1] for r in rows], dtype="float64")
    kind = vectors.schema[id_col].dataType.simpleString()
    label = cents.schema[group].dataType.simpleString()

    def batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part) or not names:
                continue
            sims = np.stack(part[vector].to_list()).astype("float64") @ matrix.T
            order = np.argsort(-np.round(sims, 12), axis=1, kind="stable")[:, :k]
            for r in range(order.shape[1]):
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), group: [names[j] for j in order[:, r]], "similarity": sims[np.arange(len(part)), order[:, r]], "rank": np.full(len(part), r + 1, dtype="int32")})

    return vectors.where(F.col(vector).isNotNull()).select(id_col, vector).mapInPandas(batch, f"{id_col} {kind}, {group} {label}, similarity double, rank int")


def representatives(vectors: DataFrame, cents: DataFrame, *, id_col: str, vector: str, group: str, top: int) -> DataFrame:
    """Per group the ``top`` members nearest to its centroid, ties by id (a top-k report)."""
    scored = vectors.join(cents.select(group, "centroid"), group).select(group, id_col, dot(F.col(vector), F.col("centroid")).alias("similarity"))
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.desc(F.round("similarity", 9)), id_col))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top)


def nearest_to(vectors: DataFrame, seed: DataFrame, name: str, *, id_col: str, vector: str, top: int) -> DataFrame:
    """The ``top`` vectors most like the one of ``seed`` (one row), ties by id: a top-k, no sort of all rows in one task."""
    scored = vectors.join(F.broadcast(seed), how="cross").withColumn("similarity", dot(F.col(vector), F.col(name))).drop(name)
    return scored.orderBy(F.desc(F.round("similarity", 9)), id_col).limit(top)


def cluster_share(rows: DataFrame, cluster: str, groups: DataFrame) -> DataFrame:
    """Per group (``group``, ``clusters``, an array) the rows of its clusters and their share of all rows."""
    sizes = rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"))
    each = groups.select("group", F.explode(F.array_distinct("clusters")).alias(cluster)).join(sizes, cluster, "left")
    total = sizes.agg(F.sum("_n").alias("_all"))
    sums = each.groupBy("group").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    return sums.join(total, how="cross").select("group", "n", F.round(F.col("n") / F.col("_all"), 3).alias("share"))  # one row


def cluster_range(n: Column) -> tuple[Column, Column]:
    """Least and largest number of clusters to try for a group of ``n`` rows."""
    low = F.when(n >= 350, 8).otherwise(F.greatest(F.lit(5), F.floor(n / 50))).cast("int")
    return low, F.least(F.lit(14), F.greatest(low, F.floor(n / 40))).cast("int")


def kmeans_sweep(vectors: DataFrame, vector: str, ks: list[int], *, seeds: int = 2, sample: int = 2_000) -> DataFrame:
    """Per number of clusters the least cost over several seeds, the Euclidean silhouette, and whether it is the first best.

    Clustering is distributed; the silhouette is taken on a sample of at most ``sample`` rows by hash
    order, as pairs of all rows would be quadratic.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = vectors.sparkSession
    data = vectors.select(array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"), F.col(vector).alias("_v")).persist()
    out = []
    for k in ks:
        models = [KMeans(k=k, seed=42 + s, maxIter=20, initSteps=2).fit(data) for s in range(seeds)]
        best = min(models, key=lambda m: m.summary.trainingCost)
        rows = best.transform(data).select("_v", "prediction").orderBy(F.xxhash64("_v")).limit(sample).toPandas()
        out.append((k, float(best.summary.trainingCost), silhouette(np.stack(rows["_v"].to_list()).astype("float64"), rows["prediction"].to_numpy())))
    data.unpersist()
    best = max(out, key=lambda r: r[2])[0] if out else None
    return spark.createDataFrame([(*r, r[0] == best) for r in out], "k int, cost double, silhouette double, is_best boolean")


def silhouette(x: np.ndarray, labels: np.ndarray) -> float:
    """Mean Euclidean silhouette; rows alone in their cluster count 0."""
    square = (x * x).sum(axis=1)
    d = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * x @ x.T, 0))
    kinds = np.unique(labels)
    if len(kinds) < 2:
        return 0.0
    member = labels[:, None] == kinds[None, :]
    sizes = member.sum(axis=0)
    sums = d @ member
    own = member.argmax(axis=1)
    at = np.arange(len(x))
    inside = sums[at, own] / np.maximum(sizes[own] - 1, 1)
    means = sums / sizes
    means[at, own] = np.inf
    outside = means.min(axis=1)
    s = np.where(sizes[own] > 1, (outside - inside) / np.maximum(inside, outside), 0.0)
    return float(s.mean())


def merge_smallest(groups: dict[str, tuple[int, list[float]]], most: int, protected: frozenset[str] = frozenset()) -> dict[str, str]:
    """Merges the smallest group that is not protected into its most similar one until ``most`` are left; group -> final group."""
    left = {g: (n, np.array(v, dtype="float64")) for g, (n, v) in groups.items()}
    into = {g: g for g in groups}
    while len(left) > most:
        free = sorted((n, g) for g, (n, _) in left.items() if g not in protected)
        if not free:
            break
        n, g = free[0]
        _, v = left.pop(g)
        best = max(sorted(left), key=lambda h: float(left[h][1] @ v))
        m, w = left[best]
        both = (w * m + v * n) / (m + n)
        left[best] = (m + n, both / (np.linalg.norm(both) or 1))
        into = {a: best if b == g else b for a, b in into.items()}
    return into
