"""Differences between two copies of data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_or_null
from .distributed import latest


def _text(c: Column) -> Column:
    return norm_or_null(c.cast("string"))


def diff_copies(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fields: list[str],
    *,
    order: str | None = None,
    normal_key: Callable[[Column], Column] | None = None,
    normal: Callable[[Column], Column] = _text,
) -> DataFrame:
    """Null-safe full outer join of two copies on ``key``; rows that differ, field by field.

    Out: ``key``, ``side`` (``left_only``, ``right_only`` or ``both``) and ``differences``, an array
    of struct ``field``, ``left_value``, ``right_value`` (as normalised). Rows without any
    difference are left out. Keys are compared after ``normal_key``, values after ``normal``
    (by default: as text, without regard to case and white space, empty as null).

    On each side one row per key counts, the latest by ``order``; ties and repeated rows give the
    row with the greatest values. Null keys are one key like any other. An empty side makes
    every key of the other one-sided. Columns besides key, order and fields are not read.
    """
    normal_key = normal_key or (lambda c: c)

    def lean(df: DataFrame) -> DataFrame:
        cols = [normal_key(F.col(f"`{key}`")).alias("_key"), F.struct(*[normal(F.col(f"`{f}`")).alias(f"f{i}") for i, f in enumerate(fields)]).alias("_v")]
        cols.append((F.col(f"`{order}`") if order else F.lit(0)).alias("_order"))
        return latest(df.select(*cols), ["_key"], ["_order"], ["_v"] if not order else ["_v", "_order"]).select("_key", "_v")

    a, b = lean(left).alias("a"), lean(right).alias("b")
    joined = a.join(b, F.col("a._key").eqNullSafe(F.col("b._key")), "full")
    has_a, has_b = F.col("a._v").isNotNull(), F.col("b._v").isNotNull()
    each = [
        F.when(
            ~F.col(f"a._v.f{i}").eqNullSafe(F.col(f"b._v.f{i}")),
            F.struct(F.lit(f).alias("field"), F.col(f"a._v.f{i}").cast("string").alias("left_value"), F.col(f"b._v.f{i}").cast("string").alias("right_value")),
        )
        for i, f in enumerate(fields)
    ]
    return (
        joined.select(
            F.coalesce("a._key", "b._key").alias(key),
            F.when(~has_b, "left_only").when(~has_a, "right_only").otherwise("both").alias("side"),
            F.when(has_a & has_b, F.filter(F.array(*each), lambda x: x.isNotNull())).otherwise(F.array().cast("array<struct<field:string,left_value:string,right_value:string>>")).alias("differences"),
        )
        .where((F.col("side") != "both") | (F.size("differences") > 0))
    )
