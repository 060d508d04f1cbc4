"""Label algebra: validation, merging by precedence or rule, coverage, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import norm


def validate_labels(labels: DataFrame, dim: DataFrame, *, area: str = "area", domain: str = "domain", unclassifiable: str = "unclassifiable") -> DataFrame:
    """Adds ``area_name``, ``domain_name`` (as in ``dim``: ``area_name``, ``domain_name``), ``valid`` and ``note``.

    Names are compared without regard to case and white space; the domain must belong to the area. An
    unclassifiable label is valid without names. Null names are not in the taxonomy. ``dim`` has one row
    per domain. The two lookups are joins that the optimizer broadcasts if the taxonomy is small.
    """
    areas = dim.select(F.col("area_name"), norm("area_name").alias("_a")).groupBy("_a").agg(F.min("area_name").alias("area_name"))
    pairs = dim.select(norm("area_name").alias("_a"), norm("domain_name").alias("_d"), "domain_name").groupBy("_a", "_d").agg(F.min("domain_name").alias("domain_name"))
    joined = labels.withColumns({"_a": norm(area), "_d": norm(domain)}).join(areas, "_a", "left").join(pairs, ["_a", "_d"], "left")
    out = F.coalesce(F.col(unclassifiable), F.lit(False))
    note = (
        F.when(out, "")
        .when(F.col("area_name").isNull(), F.concat(F.lit("theme_not_in_taxonomy:"), F.coalesce("_a", F.lit(""))))
        .when(F.col("domain_name").isNull(), F.concat(F.lit("domain_not_in_theme:"), F.coalesce("_d", F.lit(""))))
        .otherwise("")
    )
    return joined.withColumn("note", note).withColumn("valid", F.col("note") == "").drop("_a", "_d")


def validate_strict(labels: DataFrame, dim: DataFrame, *, renames: dict[str, str] | None = None, locked: str | None = None, area: str = "area", domain: str = "domain", unclassifiable: str = "unclassifiable") -> DataFrame:
    """Adds ``final_area``, ``final_domain`` and ``note`` (``ok`` or why the label is refused), names compared exactly.

    A domain of ``renames`` takes its new name first. ``locked`` names a column with an area that replaces the label's
    own where it is not null; the domain must then be one of that area. An unclassifiable label is always ``ok``.
    """
    new = F.coalesce(*[F.when(F.col(domain) == a, F.lit(b)) for a, b in (renames or {}).items()], F.col(domain))
    lock = F.col(locked) if locked else F.lit(None).cast("string")
    named = labels.withColumn("final_area", F.coalesce(lock, F.col(area))).withColumn("final_domain", new)
    areas = dim.select(F.col("area_name").alias("final_area")).distinct().withColumn("_area", F.lit(True))
    pairs = dim.select(F.col("area_name").alias("final_area"), F.col("domain_name").alias("final_domain")).distinct().withColumn("_pair", F.lit(True))
    joined = named.join(areas, "final_area", "left").join(pairs, ["final_area", "final_domain"], "left")
    said = lambda what, c: F.concat(F.lit(what), F.coalesce(c, F.lit("")))
    note = (
        F.when(F.coalesce(F.col(unclassifiable), F.lit(False)) | F.col("_pair"), "ok")
        .when(lock.isNotNull(), said("domain_not_in_locked_theme:", F.col("final_domain")))
        .when(F.col("_area").isNull(), said("theme_not_in_taxonomy:", F.col("final_area")))
        .otherwise(said("domain_not_in_theme:", F.col("final_domain")))
    )
    return joined.select(*labels.columns, "final_area", "final_domain", note.alias("note"))


def resolve_by_domain(labels: DataFrame, dim: DataFrame, *, domain: str = "domain") -> DataFrame:
    """Adds ``owner``: the area that owns the domain, if its plain name occurs once in the taxonomy."""
    owners = dim.select(norm("domain_name").alias("_d"), "area_name").groupBy("_d").agg(F.count(F.lit(1)).alias("_n"), F.min("area_name").alias("owner")).where("_n = 1").drop("_n")
    return labels.withColumn("_d", norm(domain)).join(owners, "_d", "left").drop("_d")


def precedence_merge(base: DataFrame, sources: list[tuple[str, DataFrame]], key: str, fields: list[str], usable: str = "usable") -> DataFrame:
    """For each row of ``base`` the fields of the first source that has a usable row for its key.

    Out: ``key``, ``fields``, ``source`` (``none`` if no source has one). Sources must be unique by key.
    """
    out = base.select(key)
    for name, df in sources:
        out = out.join(df.select(key, F.when(F.col(usable), F.struct(*fields, F.lit(name).alias("source"))).alias(f"_{name}")), key, "left")
    best = F.coalesce(*[F.col(f"_{name}") for name, _ in sources])
    return out.withColumn("_best", best).select(key, *[F.col(f"_best.{f}").alias(f) for f in fields], F.coalesce("_best.source", F.lit("none")).alias("source"))


def conditional_merge(old: DataFrame, new: DataFrame, key: str, fields: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """Old rows with the new row's fields where a rule accepts it.

    ``rules`` are (name, condition) over ``o.*`` and ``n.*``; the first that holds is recorded in ``rule`` (null if
    none or if there is no new row). A new row counts whatever is null in it: a label may say that there is none. ``changed``: the merged fields differ from the old ones.
    """
    joined = old.alias("o").join(new.withColumn("_there", F.lit(True)).alias("n"), key, "left")
    rule = F.coalesce(*[F.when(F.col("n._there").isNotNull() & F.coalesce(condition, F.lit(False)), name) for name, condition in rules])
    pick = {f: F.when(F.col("_rule").isNotNull(), F.col(f"n.{f}")).otherwise(F.col(f"o.{f}")) for f in fields}
    changed = ~F.struct(*[pick[f] for f in fields]).eqNullSafe(F.struct(*[F.col(f"o.{f}") for f in fields]))
    return joined.withColumn("_rule", rule).select(key, *[c.alias(f) for f, c in pick.items()], F.col("_rule").alias("rule"), changed.alias("changed"))


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys by side: ``both``, ``left_only`` or ``right_only``, from one full outer join of distinct keys."""
    a = left.select(key).distinct().withColumn("_l", F.lit(True))
    b = right.select(key).distinct().withColumn("_r", F.lit(True))
    return a.join(b, key, "full").select(key, F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both").alias("side"))


def patch_rows(table: DataFrame, patch: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``table`` with the fields of rows that ``patch`` has; a new version, nothing in place."""
    got = patch.select(key, F.struct(*fields).alias("_p"))
    joined = table.join(got, key, "left")
    return joined.select(*[F.when(F.col("_p").isNotNull(), F.col(f"_p.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in table.columns])


def upsert_dimension(existing: DataFrame, wanted: DataFrame, name: str, id_col: str) -> DataFrame:
    """The wanted rows, with the id of an existing row of that name, else one derived from the name; and what happens to each row.

    Out: ``name``, ``id_col``, ``action`` (``keep``, ``insert`` or ``delete``). Names are unique on each side.
    """
    a = existing.select(F.col(name), F.col(id_col).alias("_old"))
    b = wanted.select(name).distinct().withColumn("_wanted", F.lit(True))
    joined = a.join(b, name, "full")
    action = F.when(F.col("_wanted").isNull(), "delete").when(F.col("_old").isNull(), "insert").otherwise("keep")
    return joined.select(name, F.coalesce("_old", F.substring(F.md5(F.col(name)), 1, 24)).alias(id_col), action.alias("action"))


def overwrite_nested(table: DataFrame, patch: DataFrame, key: str, nested: str) -> DataFrame:
    """Sets fields of the struct column ``nested`` from the columns of ``patch``; other fields stay."""
    kind = table.schema[nested].dataType
    assert isinstance(kind, T.StructType)
    fields = [c for c in patch.columns if c != key]
    joined = table.join(patch.select(key, F.struct(*fields).alias("_p")), key, "left")
    merged = F.struct(*[F.when(F.col("_p").isNotNull(), F.col(f"_p.{f.name}")).otherwise(F.col(f"{nested}.{f.name}")).alias(f.name) if f.name in fields else F.col(f"{nested}.{f.name}").alias(f.name) for f in kind])
    return joined.withColumn(nested, merged).drop("_p")
