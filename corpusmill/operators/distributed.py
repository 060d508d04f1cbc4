"""Building blocks that keep hot groups and long plans distributed."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where the session names none (tests on one machine), a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def salt_of(cols: list[str], salts: int) -> Column:
    """A salt from the row's own values, so that a task that runs again gets the same rows."""
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def replicate(df: DataFrame, salts: int, name: str = "_salt") -> DataFrame:
    """Each row once for each salt: the small side of a salted join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def latest(df: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order``, ties by the greatest values of the kept columns.

    An aggregate rather than a window: rows of a hot key are reduced before the shuffle.
    Null order values are the least; null keys form one group. Tied rows give one of the
    values in full, never a mixture.
    """
    keep = keep if keep is not None else [c for c in df.columns if c not in keys]
    plain = [c for c in keep if not isinstance(df.schema[c].dataType, T.MapType)]
    rank = F.struct(*[F.col(f"`{c}`") for c in order], *[F.col(f"`{c}`") for c in plain if c not in order])
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in keep]), rank)
    return df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(best.alias("_best")).select(*[F.col(f"`{c}`") for c in keys], *[F.col("_best")[c].alias(c) for c in keep])


def group_rank(df: DataFrame, group: list[str], order: list[str], *, salt_on: list[str], salts: int = 64, name: str = "rank") -> DataFrame:
    """1-based rank within each group without sorting a group in one task.

    The order is first by salt (a hash of ``salt_on``), then by ``order``: a fixed random
    order if ``salt_on`` is unique. Rows are counted by (group, salt), the counts give each
    salt its offset, and only rows of one (group, salt) are sorted together. Group columns must
    not be null.
    """
    salted = df.withColumn("_salt", salt_of(salt_on, salts))
    by = [*group, "_salt"]
    # At most ``salts`` rows of a group: the window below never sees the group itself.
    counts = salted.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = W.partitionBy(*by).orderBy(*order)
    ranked = salted.withColumn("_row", F.row_number().over(inner))
    return ranked.join(offsets, by).select(*df.columns, (F.col("_row") + F.col("_before")).alias(name))


def group_running_sum(df: DataFrame, group: list[str], value: str, order: list[str], *, salt_on: list[str], salts: int = 64, name: str = "before") -> DataFrame:
    """The sum of ``value`` over the rows before this one in its group, in the order of ``group_rank``."""
    salted = df.withColumn("_salt", salt_of(salt_on, salts))
    by = [*group, "_salt"]
    sums = salted.groupBy(*by).agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*group).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*by, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inner = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    run = salted.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return run.join(offsets, by).select(*df.columns, (F.col("_inner") + F.col("_before")).alias(name))


def require_at_most(df: DataFrame, rows: int, what: str) -> list:
    """The rows of a table whose size a parameter bounds; more rows are an error, not a cut."""
    got = df.limit(rows + 1).collect()
    if len(got) > rows:
        raise ValueError(f"{what}: more than {rows} rows")
    return got


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
