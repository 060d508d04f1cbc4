"""Problem 3: orphan references of papers to people, departments and the taxonomy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import reference_key
from ..operators.integrity import orphan_references, orphan_report
from ..sources.tables import load
from .sqltext import reference_key as reference_key_sql


def references(papers: DataFrame) -> DataFrame:
    """One row per stored reference: paper, field, plain key (null if it is none), arrival of the paper's row."""
    author = lambda name: F.transform("iitd_authors", lambda a: F.struct(F.lit(name).alias("ref_field"), a[name].alias("raw")))
    stored = lambda name: F.array(F.struct(F.lit(name).alias("ref_field"), F.col(f"classification.{name}").alias("raw")))
    none = F.array().cast("array<struct<ref_field:string,raw:string>>")
    listed = F.concat(
        F.coalesce(author("faculty_ref"), none),
        F.coalesce(author("department_ref"), none),
        stored("thematic_area_id"),
        stored("domain_id"),
    )
    # Equal references of one row (an author listed twice) are one.
    return (
        papers.select(F.col("_id").alias("paper_id"), "ingested_at", F.explode(F.array_distinct(listed)).alias("r"))
        .where(F.col("r.raw").isNotNull())
        .select("paper_id", "ingested_at", "r.ref_field", reference_key("r.raw").alias("ref_key"))
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Life of every key that a reference may name, by the field that names it."""
    tables = [("faculty_ref", "faculties", "_id"), ("department_ref", "departments", "_id"), ("department_ref", "departments", "code"), ("thematic_area_id", "thematicareas", "_id"), ("domain_id", "domains", "_id")]
    parts = [load(spark, sf_dir, t).select(F.lit(field).alias("ref_field"), reference_key(column).alias("ref_key"), "created_at", "deleted_at") for field, t, column in tables]
    return reduce(DataFrame.unionByName, parts)


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_references(
        references(load(spark, sf_dir, "researchmetadatascopus")), ["ref_field", "ref_key"], targets(spark, sf_dir),
        match="simple", observed_at="ingested_at", created_at="created_at", deleted_at="deleted_at",
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("paper_id", "ref_field", "ref_key", "kind").distinct()


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references (distinct per paper row) by field, month of arrival and kind."""
    distinct = _orphans(spark, sf_dir).distinct()
    return orphan_report(distinct, ["ref_field"], "ingested_at", "paper_id")


def p3_area_domain_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key (thematic_area_id, domain_id) against domains, with partial match of keys that have a null."""
    papers = load(spark, sf_dir, "researchmetadatascopus").select(
        F.col("_id").alias("paper_id"), reference_key("classification.thematic_area_id").alias("thematic_area_id"), reference_key("classification.domain_id").alias("domain_id")
    )
    domains = load(spark, sf_dir, "domains").select(reference_key("thematic_area_id").alias("thematic_area_id"), reference_key("_id").alias("domain_id"), "deleted_at")
    found = orphan_references(papers.distinct(), ["thematic_area_id", "domain_id"], domains, match="partial", deleted_at="deleted_at")
    return found.groupBy("kind", F.col("thematic_area_id").isNull().alias("area_is_null"), F.col("domain_id").isNull().alias("domain_is_null")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"p3_found": p3_found, "p3_report": p3_report, "p3_area_domain_pairs": p3_area_domain_pairs}

_REFS = f"""
authors AS (SELECT _id, ingested_at, unnest(iitd_authors) AS a FROM researchmetadatascopus),
raw AS (
  SELECT _id, ingested_at, 'faculty_ref' AS ref_field, a.faculty_ref AS k FROM authors
  UNION SELECT _id, ingested_at, 'department_ref', a.department_ref FROM authors
  UNION SELECT _id, ingested_at, 'thematic_area_id', classification.thematic_area_id FROM researchmetadatascopus
  UNION SELECT _id, ingested_at, 'domain_id', classification.domain_id FROM researchmetadatascopus),
refs AS (SELECT DISTINCT _id AS paper_id, ingested_at, ref_field, {reference_key_sql("k")} AS ref_key FROM raw),
lives AS (
  SELECT 'faculty_ref' AS ref_field, {reference_key_sql("_id")} AS ref_key, created_at, deleted_at FROM faculties
  UNION ALL SELECT 'department_ref', {reference_key_sql("_id")}, created_at, deleted_at FROM departments
  UNION ALL SELECT 'department_ref', {reference_key_sql("code")}, created_at, deleted_at FROM departments
  UNION ALL SELECT 'thematic_area_id', {reference_key_sql("_id")}, created_at, deleted_at FROM thematicareas
  UNION ALL SELECT 'domain_id', {reference_key_sql("_id")}, created_at, deleted_at FROM domains),
known AS (SELECT ref_field, ref_key, count(*) FILTER (deleted_at IS NULL) AS live, min(created_at) FILTER (deleted_at IS NULL) AS since
  FROM lives WHERE ref_key IS NOT NULL GROUP BY ALL),
orphans AS (
  SELECT * FROM (SELECT r.*, CASE WHEN k.live IS NULL THEN 'missing' WHEN k.live = 0 THEN 'deleted' WHEN k.since > r.ingested_at THEN 'late' END AS kind
    FROM refs r LEFT JOIN known k USING (ref_field, ref_key) WHERE r.ref_key IS NOT NULL) WHERE kind IS NOT NULL)
"""
SQL = {
    "p3_found": f"WITH {_REFS} SELECT DISTINCT paper_id, ref_field, ref_key, kind FROM orphans",
    "p3_report": f"WITH {_REFS} SELECT ref_field, strftime(ingested_at AT TIME ZONE 'UTC', '%Y-%m') AS month, kind, count(*) AS n_references, count(DISTINCT paper_id) AS n_entities FROM orphans GROUP BY ALL",
    "p3_area_domain_pairs": f"""
WITH p AS (SELECT DISTINCT _id, {reference_key_sql("classification.thematic_area_id")} AS t, {reference_key_sql("classification.domain_id")} AS d FROM researchmetadatascopus),
g AS (SELECT {reference_key_sql("thematic_area_id")} AS t, {reference_key_sql("_id")} AS d, deleted_at FROM domains),
k AS (SELECT p.*, (SELECT count(*) FROM g WHERE (p.t IS NULL OR g.t = p.t) AND (p.d IS NULL OR g.d = p.d)) AS rows_found,
  (SELECT count(*) FROM g WHERE (p.t IS NULL OR g.t = p.t) AND (p.d IS NULL OR g.d = p.d) AND g.deleted_at IS NULL) AS live
  FROM p WHERE p.t IS NOT NULL OR p.d IS NOT NULL)
SELECT CASE WHEN rows_found = 0 THEN 'missing' ELSE 'deleted' END AS kind, t IS NULL AS area_is_null, d IS NULL AS domain_is_null, count(*) AS n
FROM k WHERE live = 0 GROUP BY ALL""",
}
