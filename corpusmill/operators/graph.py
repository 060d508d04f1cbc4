"""Entity graph, explore index and inverted indices from author facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nodes(parts: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """One row per entity: ``id`` (with the kind as prefix), ``kind``, ``label``. ``parts`` are (kind, rows, id column, label column); of several labels the least."""
    out = None
    for kind, df, key, label in parts:
        rows = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(label).alias("label"))
        rows = rows.select(F.concat(F.lit(kind + ":"), F.col("_k").cast("string")).alias("id"), F.lit(kind).alias("kind"), "label")
        out = rows if out is None else out.unionByName(rows)
    return out


def edges(parts: list[tuple[str, DataFrame, str, str, str, str]]) -> DataFrame:
    """(label, rows, source kind, source column, target kind, target column) -> ``source``, ``target``, ``label``; repeated edges stay."""
    out = None
    for label, df, a, ac, b, bc in parts:
        rows = df.where(F.col(ac).isNotNull() & F.col(bc).isNotNull()).select(F.concat(F.lit(a + ":"), F.col(ac).cast("string")).alias("source"), F.concat(F.lit(b + ":"), F.col(bc).cast("string")).alias("target"), F.lit(label).alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


def explore_index(facts: DataFrame, term: str, department: str, person: str, entity: str) -> DataFrame:
    """Per term its departments, each with papers, people and the people's papers: nested arrays.

    Counts are of (person, entity) pairs. Three aggregations, each smaller than the last: pairs per
    person, people per department, departments per term; arrays are sorted by count, then name.
    """
    per = facts.where(F.col(term).isNotNull() & F.col(department).isNotNull() & F.col(person).isNotNull()).groupBy(term, department, person).agg(F.count_distinct(entity).alias("n"))
    people = per.groupBy(term, department).agg(
        F.sum("n").alias("paper_count"), F.count(F.lit(1)).alias("person_count"),
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("minus"), F.col(person).alias("person")))), lambda x: F.struct(x["person"].alias("person"), (-x["minus"]).alias("n"))).alias("people"),
    )
    return people.groupBy(term).agg(
        F.sum("paper_count").alias("count"),
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("paper_count")).alias("minus"), F.col(department).alias("department"), "person_count", "people"))), lambda x: F.struct(x["department"].alias("department"), (-x["minus"]).alias("paper_count"), x["person_count"].alias("person_count"), x["people"].alias("people"))).alias("departments"),
    )


def inverted_index(facts: DataFrame, key: str, value: str) -> DataFrame:
    """Per key its distinct values in order, and how many."""
    return facts.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("entries")).withColumn("n", F.size("entries"))
