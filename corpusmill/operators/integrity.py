"""References to records that do not exist."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .distributed import replicate, salt_of

MATCHES = ("simple", "partial", "full")


def orphan_references(
    refs: DataFrame,
    ref_cols: list[str],
    targets: DataFrame,
    target_cols: list[str] | None = None,
    *,
    match: str = "simple",
    observed_at: str | None = None,
    created_at: str | None = None,
    deleted_at: str | None = None,
    salts: int = 16,
) -> DataFrame:
    """The rows of ``refs`` whose composite key has no valid row in ``targets``, with column ``kind``.

    References are grouped by null mask; each mask is anti-joined on its non-null columns.
    ``match`` says what a key with nulls means: ``simple``: it is no reference; ``partial``: its
    other columns must be found together in one target row; ``full``: it is ``missing`` unless
    all columns are null. A key of nulls only is never a reference.

    ``kind`` is ``missing`` (no target row), ``deleted`` (every target row has ``deleted_at``) or
    ``late`` (the earliest ``created_at`` of the undeleted rows is after ``observed_at``); without
    the time columns only ``missing`` occurs. A null ``observed_at`` is never late.

    Repeated references stay repeated. Nulls in target keys match nothing. Empty targets make
    every reference ``missing``; other columns of ``refs`` pass through whatever their names.
    Targets are reduced to one row per key and repeated ``salts`` times, references take a
    salt of their own, so that a key with a third of all references is spread over tasks.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    target_cols = target_cols or ref_cols
    if len(ref_cols) != len(target_cols) or not 1 <= len(ref_cols) <= 8:
        raise ValueError("between 1 and 8 key columns, as many on both sides")
    out_cols = [f"`{c}`" for c in refs.columns]
    ghost = F.lit(None).cast("timestamp")
    lean = targets.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(target_cols)],
        (F.col(f"`{deleted_at}`") if deleted_at else ghost).alias("_deleted"),
        (F.col(f"`{created_at}`") if created_at else ghost).alias("_created"),
    )
    tagged = refs.select(
        F.struct(*[F.col(c) for c in out_cols]).alias("_ref"),
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(ref_cols)],
        (F.col(f"`{observed_at}`") if observed_at else ghost).alias("_seen"),
        salt_of(out_cols_hashable(refs), salts).alias("_salt"),
    )
    found = []
    for mask in product((True, False), repeat=len(ref_cols)):
        present = [f"_k{i}" for i, there in enumerate(mask) if there]
        if not present or (match == "simple" and not all(mask)):
            continue
        part = tagged
        for i, there in enumerate(mask):
            part = part.where(F.col(f"_k{i}").isNotNull() if there else F.col(f"_k{i}").isNull())
        if match == "full" and not all(mask):
            found.append(part.select("_ref", F.lit("missing").alias("kind")))
            continue
        known = (
            lean.dropna(subset=present)
            .groupBy(*present)
            .agg(
                F.count_if(F.col("_deleted").isNull()).alias("_live"),
                F.min(F.when(F.col("_deleted").isNull(), F.col("_created"))).alias("_since"),
            )
        )
        kind = (
            F.when(F.col("_live").isNull(), "missing")
            .when(F.col("_live") == 0, "deleted")
            .when(F.col("_since") > F.col("_seen"), "late")
        )
        joined = part.join(replicate(known, salts), [*present, "_salt"], "left").withColumn("kind", kind)
        found.append(joined.where(F.col("kind").isNotNull()).select("_ref", "kind"))
    if not found:
        return refs.limit(0).withColumn("kind", F.lit("missing"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("_ref.*", "kind")


def out_cols_hashable(df: DataFrame) -> list[str]:
    """Columns that a hash can be taken of (maps cannot)."""
    return [f"`{c}`" for c, kind in df.dtypes if "map<" not in kind]


def orphan_report(orphans: DataFrame, by: list[str], observed_at: str, entity: str) -> DataFrame:
    """Orphan references per ``by``, month of ``observed_at`` and kind: references and distinct entities."""
    return (
        orphans.withColumn("month", F.date_format(F.col(observed_at), "yyyy-MM"))
        .groupBy(*by, "month", "kind")
        .agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct(entity).alias("n_entities"))
    )
