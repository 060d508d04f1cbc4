"""Sample matching target category proportions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.distributed import group_rank, replicate, salt_of


def target_lines(targets: DataFrame, line: str) -> DataFrame:
    """Targets with nulls as 0, negative ones too; one row per line."""
    return targets.select(F.col(line), F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("min_rows", F.lit(0)), F.lit(0)).alias("min_rows"), F.col("sample_size"))


def divisor_ranks(records: DataFrame, targets: DataFrame, *, line: str = "target_id", id_col: str = "id", seed: str = "1", salts: int = 64, slice_rows: int = 20_000) -> DataFrame:
    """Every record of a target line with its rank, its divisor-method priority and whether it is drawn.

    Each record of a category gets a random rank (by a hash of ``seed`` and ``id_col``) and the
    priority (rank - 0.5) / target share. Records with rank <= ``min_rows`` come first, then the
    globally smallest priorities until ``sample_size`` records are drawn; where a category is
    exhausted its seats go to the others by the same order. The floors are kept even where
    they add up to more than ``sample_size``. Categories without a share only get their floor.

    Out: the columns of ``records`` and ``rank``, ``priority`` (null without a share), ``drawn`` (columns of these names are replaced).
    Records whose ``line`` is null or not in ``targets`` are left out. Repeated ids are records of
    their own. Empty inputs give an empty result.

    No category and no sample is sorted in one task: ranks come from ``group_rank``, and since
    priorities of all categories together are spread evenly (about x records below priority x),
    slices of equal width in priority hold about ``slice_rows`` records each; slices are counted,
    and only the slice in which the sample ends is ranked.
    """
    lines = target_lines(targets, line).groupBy(line).agg(F.max("target_share").alias("target_share"), F.max("min_rows").alias("min_rows"), F.max("sample_size").alias("sample_size"))
    own = [c for c in records.columns if c not in ("rank", "priority", "drawn")]
    bare = records.where(F.col(line).isNotNull()).select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_record"), F.col(line).alias("_line"), F.col(id_col).alias("_id"))
    hashed = bare.withColumn("_random", F.md5(F.concat_ws("-", F.lit(seed), F.col("_id").cast("string"))))
    lines = lines.withColumnRenamed(line, "_line")
    ranked = group_rank(hashed, ["_line"], ["_random", "_id"], salt_on=["_random"], salts=salts)
    salted = ranked.withColumn("_salt", salt_of(["_random"], 16)).join(replicate(lines, 16), ["_line", "_salt"])
    share = F.nullif(F.col("target_share"), F.lit(0.0))
    scored = salted.withColumn("_floor", F.col("rank") <= F.col("min_rows")).withColumn("priority", (F.col("rank") - 0.5) / share)
    # Floors first, as one slice; then slices of priority; records with neither are in no slice.
    scored = scored.withColumn("_slice", F.when(F.col("_floor"), F.lit(-1)).otherwise(F.floor(F.col("priority") / slice_rows)))
    # The table of slices is smaller than the records by about slice_rows.
    slices = scored.where("_slice IS NOT NULL").groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"), F.max("sample_size").alias("_size"))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    ends = slices.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where((F.col("_slice") == -1) | (F.col("_before") < F.col("_size"))).select("_slice", "_before", "_n", "_size")
    joined = scored.drop("sample_size").join(ends, "_slice", "left")
    whole = (F.col("_slice") == -1) | (F.col("_before") + F.col("_n") <= F.col("_size"))
    out = ["_record.*", "rank", "priority"]
    ended = joined.where(whole.isNull() | whole)
    last = joined.where(~whole).withColumn("_at", F.row_number().over(W.partitionBy("_slice").orderBy("priority", "_line", "_random", "_id")))
    return ended.select(*out, whole.eqNullSafe(F.lit(True)).alias("drawn")).unionByName(last.select(*out, (F.col("_before") + F.col("_at") <= F.col("_size")).alias("drawn")))


def divisor_sample(records: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """The records that ``divisor_ranks`` draws, with ``rank`` and ``priority``."""
    return divisor_ranks(records, targets, **options).where("drawn").drop("drawn")


def quota_report(ranks: DataFrame, targets: DataFrame, *, line: str = "target_id") -> DataFrame:
    """Per target line, from ``divisor_ranks``: records available (the highest rank), wanted (the larger of floor and share), seats drawn, actual share, ``is_met``.

    A line is met if its seats reach what is wanted. Where they do not, because floors or lines of less need took
    the seats, the exact check follows: a record of the wanted rank would have to exist.
    A line without records has 0 available.
    """
    drawn = ranks.groupBy(line).agg(F.max("rank").alias("n_available"), F.count_if("drawn").alias("n_drawn"))
    wanted = F.greatest(F.col("min_rows").cast("double"), F.col("target_share") * F.col("sample_size"))
    out = target_lines(targets, line).join(drawn, line, "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_available", "n_drawn")}).withColumn("n_wanted", wanted)
    goal = F.coalesce("n_wanted", F.lit(0.0))
    out = out.withColumn("is_met", (F.col("n_drawn") >= goal) | (F.col("n_available") >= goal))
    # One row per target line, a control table.
    return out.withColumn("actual_share", F.coalesce(F.col("n_drawn") / F.nullif(F.sum("n_drawn").over(W.partitionBy()), F.lit(0)), F.lit(0.0)))
