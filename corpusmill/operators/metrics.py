"""Agreement, confusion and before/after analytics over labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def frequency(df: DataFrame, *by: str) -> DataFrame:
    """Rows per group with rank (ties by name) and share of all; one window over the groups, not the rows."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    order = W.orderBy(F.desc("n"), *[F.asc_nulls_last(c) for c in by])
    return counts.withColumn("rank", F.row_number().over(order)).withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Rows per interval [edge, next edge), empty intervals too; values outside and nulls are left out."""
    spark = df.sparkSession
    bins = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:]))], "bin int, low double, high double")
    v = F.col(value)
    which = F.coalesce(*[F.when((v >= a) & (v < b), i) for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    counts = df.select(which.alias("bin")).where("bin IS NOT NULL").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return bins.join(counts, "bin", "left").select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def rate(hit: Column, of: Column | None = None) -> Column:
    """Per cent of rows, to two digits; null where there are none."""
    return F.round(100 * F.try_divide(F.count_if(hit), F.count(of if of is not None else F.lit(1))), 2)


def agreement_sets(pairs: DataFrame, agree: str, sets: list[list[str]]) -> DataFrame:
    """Agreed and comparable rows over several groupings in one pass (grouping sets); ``agree`` null is not comparable.

    Out: the grouping columns (null where not grouped by), ``level``, ``n``, ``agreed``, ``pct``.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    grouped = pairs.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    out = grouped.agg(F.grouping_id().alias("level"), F.count(agree).alias("n"), F.count_if(F.col(agree)).alias("agreed"))
    return out.withColumn("pct", F.round(100 * F.try_divide(F.col("agreed"), F.col("n")), 2))


def confusion(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of labels; pairs with a null are left out."""
    return pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def purity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Per label ``a``: rows, those that stay in it under ``b``, those moved, and purity in per cent."""
    stays = F.col(a).eqNullSafe(F.col(b))
    return pairs.where(F.col(a).isNotNull()).groupBy(a).agg(F.count(F.lit(1)).alias("n"), F.count_if(stays).alias("stayed"), F.count_if(~stays).alias("moved"), rate(stays).alias("purity"))


def involvement(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """How often a label is on either side of a disagreement."""
    off = pairs.where(F.col(a) != F.col(b))
    return off.select(F.explode(F.array(a, b)).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def leverage(corpus: DataFrame, pairs: DataFrame, label: str, other: str) -> DataFrame:
    """Rows of a label in the corpus times its rate of disagreement in a judged subset."""
    sizes = corpus.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("corpus_n"))
    judged = pairs.where(F.col(label).isNotNull() & F.col(other).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("judged"), F.count_if(F.col(label) != F.col(other)).alias("disagreed"))
    joined = sizes.join(judged, label, "left")
    return joined.select(label, "corpus_n", F.coalesce("judged", F.lit(0)).alias("judged"), F.round(F.col("corpus_n") * F.try_divide(F.col("disagreed"), F.col("judged")), 4).alias("leverage"))


def before_after(old: DataFrame, new: DataFrame, label: str) -> DataFrame:
    """Rows per label in two versions and the change."""
    a = old.groupBy(label).agg(F.count(F.lit(1)).alias("n_old"))
    b = new.groupBy(label).agg(F.count(F.lit(1)).alias("n_new"))
    both = a.join(b, a[label].eqNullSafe(b[label]), "full").select(F.coalesce(a[label], b[label]).alias(label), F.coalesce("n_old", F.lit(0)).alias("n_old"), F.coalesce("n_new", F.lit(0)).alias("n_new"))
    return both.withColumn("delta", F.col("n_new") - F.col("n_old"))


def win_summary(judged: DataFrame, winner: str, *by: str) -> DataFrame:
    """Wins of ``new`` and ``old``, ties, margin and win rate without ties."""
    new, old = F.count_if(F.col(winner) == "new"), F.count_if(F.col(winner) == "old")
    return judged.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), new.alias("new_wins"), old.alias("old_wins"), F.count_if(F.col(winner) == "tie").alias("ties"), (new - old).alias("margin"), F.round(F.try_divide(new, new + old), 4).alias("win_rate"))


def top_groups(counts: DataFrame, n: int, order: str, *ties: str) -> DataFrame:
    return counts.orderBy(F.desc(order), *ties).limit(n)
