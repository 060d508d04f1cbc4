"""Frames that many queries start from, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import key, norm, norm_or_null, reference_key, squash
from ..operators.distributed import latest
from ..sources.tables import load
from .sqltext import norm as norm_sql
from .sqltext import norm_or_null as norm_or_null_sql
from .sqltext import reference_key as reference_key_sql
from .sqltext import stripped


def papers(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Latest row of each paper with the named columns, plain keys ``area_id`` and ``domain_id`` among those on offer."""
    rows = load(spark, sf_dir, "researchmetadatascopus").select(
        F.col("_id").alias("id"), "title", "abstract", F.col("publication_year").alias("year"), F.col("citation_count").alias("citations"), F.col("iitd_authors").alias("authors"),
        reference_key("classification.thematic_area_id").alias("area_id"), reference_key("classification.domain_id").alias("domain_id"), reference_key("classification.subdomain_id").alias("subdomain_id"), F.coalesce("classification.unclassifiable", F.lit(False)).alias("unclassifiable"), "updated_at", "ingested_at",
    )
    return latest(rows.select("id", *columns, *[c for c in ("updated_at", "ingested_at") if c not in columns]), ["id"], ["updated_at", "ingested_at"], list(columns) + [c for c in ("updated_at", "ingested_at") if c not in columns]).select("id", *columns)


def labels(spark: SparkSession, sf_dir: str, table: str = "audit50_v21_sample") -> DataFrame:
    """Latest label of each paper, names in plain form, empty ones null."""
    rows = load(spark, sf_dir, table).select(key("id").alias("id"), norm_or_null("thematic_area").alias("area"), norm_or_null("domain").alias("domain"), "confidence", "unclassifiable", norm("source_model").alias("model"), "escalated", "labelled_at")
    return latest(rows, ["id"], ["labelled_at"])


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains in use with their areas: ``area_id``, ``area_name``, ``domain_id``, ``domain_name``."""
    areas = load(spark, sf_dir, "thematicareas").where("deleted_at IS NULL").select(F.col("_id").alias("area_id"), F.col("name").alias("area_name"))
    domains = load(spark, sf_dir, "domains").where("deleted_at IS NULL").select(F.col("_id").alias("domain_id"), F.col("name").alias("domain_name"), F.col("thematic_area_id").alias("area_id"))
    return domains.join(areas, "area_id").select("area_id", "area_name", "domain_id", "domain_name")


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per paper and listed author: keys in plain form, departments by ``_id`` or code resolved to ``_id``."""
    each = papers(spark, sf_dir, "authors", "area_id", "domain_id", "subdomain_id", "unclassifiable").select("id", "area_id", "domain_id", "subdomain_id", "unclassifiable", F.posexplode("authors").alias("pos", "a"))
    plain = each.select("id", "area_id", "domain_id", "subdomain_id", "pos", squash("a.kerberos").alias("kerberos"), reference_key("a.faculty_ref").alias("faculty_id"), reference_key("a.department_ref").alias("_ref"))
    keys = load(spark, sf_dir, "departments").select(F.col("_id").alias("department_id"), reference_key("_id").alias("_by_id"), reference_key("code").alias("_by_code"))
    # An id goes before another department's code.
    both = F.array(F.struct(F.col("_by_id").alias("k"), F.lit(0).alias("at")), F.struct(F.col("_by_code").alias("k"), F.lit(1).alias("at")))
    named = keys.select("department_id", F.explode(both).alias("_e")).where("_e.k IS NOT NULL").groupBy(F.col("_e.k").alias("_ref")).agg(F.min_by("department_id", F.struct("_e.at", "department_id")).alias("department_id"))
    return plain.join(named, "_ref", "left").drop("_ref")


PAPERS = f"""papers AS (SELECT _id AS id, title, abstract, publication_year AS year, citation_count AS citations, iitd_authors AS authors,
  {reference_key_sql("classification.thematic_area_id")} AS area_id, {reference_key_sql("classification.domain_id")} AS domain_id, {reference_key_sql("classification.subdomain_id")} AS subdomain_id, coalesce(classification.unclassifiable, false) AS unclassifiable, updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY updated_at DESC, ingested_at DESC) AS rn FROM researchmetadatascopus) WHERE rn = 1)"""


def labels_sql(name: str = "labels", table: str = "audit50_v21_sample") -> str:
    return f"""{name} AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY labelled_at DESC, area DESC NULLS LAST, domain DESC NULLS LAST, confidence DESC NULLS LAST, unclassifiable DESC, model DESC, escalated DESC) AS rn
  FROM (SELECT {stripped("lower(id)")} AS id, {norm_or_null_sql("thematic_area")} AS area, {norm_or_null_sql("domain")} AS domain, confidence, unclassifiable, {norm_sql("source_model")} AS model, escalated, labelled_at FROM {table})) WHERE rn = 1)"""


TAXONOMY = """taxonomy AS (SELECT a._id AS area_id, a.name AS area_name, d._id AS domain_id, d.name AS domain_name FROM domains d JOIN thematicareas a ON d.thematic_area_id = a._id WHERE d.deleted_at IS NULL AND a.deleted_at IS NULL)"""
AUTHORS = f"""{PAPERS},
dept AS (SELECT k, arg_min(_id, (prio, _id)) AS department_id FROM (SELECT _id, {reference_key_sql("_id")} AS k, 0 AS prio FROM departments UNION ALL SELECT _id, {reference_key_sql("code")}, 1 FROM departments) WHERE k IS NOT NULL GROUP BY k),
listed AS (SELECT id, area_id, domain_id, subdomain_id, unnest(authors) AS a, generate_subscripts(authors, 1) - 1 AS pos FROM papers),
authors AS (SELECT l.id, l.area_id, l.domain_id, l.subdomain_id, l.pos, regexp_replace(regexp_replace(l.a.kerberos, '[\\s\\x{{85}}\\x{{a0}}\\p{{Z}}]+', ' ', 'g'), '^ +| +$', '', 'g') AS kerberos, {reference_key_sql("l.a.faculty_ref")} AS faculty_id, d.department_id
  FROM listed l LEFT JOIN dept d ON d.k = {reference_key_sql("l.a.department_ref")})"""
