"""Rolling, cumulative and budget windows without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def rolling_sum(events: DataFrame, time: str, values: list[str], seconds: int, *, by: list[str] | None = None) -> DataFrame:
    """For each event the sums over the ``seconds`` before it, both ends included.

    Without ``by`` the whole stream is one series; it is cut into pieces of time, each with the part before it
    that its windows reach into, so pieces are summed apart. A piece spans many windows, so
    an event is copied about once.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    span = 1_000_000 * seconds
    piece = span * 64
    keyed = events.withColumn("_t", micros).withColumn("_p", F.floor(F.col("_t") / piece))
    # An event is also seen by the next piece if that piece's windows reach it.
    near = F.floor((F.col("_t") + span) / piece)
    copies = keyed.withColumn("_in", F.explode(F.when(near > F.col("_p"), F.array("_p", near)).otherwise(F.array("_p"))))
    frame = W.partitionBy("_in", *(by or [])).orderBy("_t").rangeBetween(-span, 0)
    summed = copies.select("*", *[F.sum(v).over(frame).alias(f"{v}_rolling") for v in values], F.count(F.lit(1)).over(frame).alias("n_rolling"))
    return summed.where(F.col("_in") == F.col("_p")).drop("_t", "_p", "_in")


def running_total(rows: DataFrame, order: str, value: str, *, width: float, name: str = "total") -> DataFrame:
    """Running sum over all rows in the order of an integer column: slices of ``width`` are summed, then rows within each slice."""
    sliced = rows.withColumn("_s", F.floor(F.col(order) / width))
    sums = sliced.groupBy("_s").agg(F.sum(value).alias("_v"))
    before = sums.select("_s", F.coalesce(F.sum("_v").over(W.orderBy("_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = W.partitionBy("_s").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return sliced.withColumn("_run", F.sum(value).over(inner)).join(before, "_s").withColumn(name, F.col("_run") + F.col("_before")).drop("_s", "_run", "_before")
