"""Facet queries: papers, faculty members and member lists per area, domain and department."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.facets import facet_counts, facet_members
from .base import AUTHORS, PAPERS, authors, papers


def facet_paper_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers per facet, authors or not."""
    return facet_counts(papers(spark, sf_dir, "area_id", "domain_id", "subdomain_id"), entity="id").withColumnRenamed("n", "paper_count")


def facet_department_paper_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers per facet and department of an author; rows for all departments count papers with authors."""
    return facet_counts(authors(spark, sf_dir), entity="id", by="department_id").withColumnRenamed("n", "paper_count")


def facet_faculty_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct kerberos per facet and department, authors with a faculty reference; a null kerberos counts once."""
    return facet_counts(authors(spark, sf_dir), entity="kerberos", by="department_id", distinct_of="faculty_id").withColumnRenamed("n", "faculty_count")


def facet_top_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = facet_members(authors(spark, sf_dir).where("faculty_id IS NOT NULL"), member="kerberos", entity="id")
    return found.select("mask", "area_id", "domain_id", "subdomain_id", F.array_join("members", ",").alias("members"), "member_total")


QUERIES = {"agg_a15_facet_paper_count": facet_paper_count, "agg_a15_facet_department_count": facet_department_paper_count, "agg_a16_facet_faculty_count": facet_faculty_count, "agg_a17_facet_members": facet_top_members}

_MASKED = """masked AS (
  SELECT 0 AS mask, area_id, NULL AS domain_id, NULL AS subdomain_id, {c} FROM {t} WHERE area_id IS NOT NULL
  UNION ALL SELECT 1, NULL, domain_id, NULL, {c} FROM {t} WHERE domain_id IS NOT NULL
  UNION ALL SELECT 2, NULL, domain_id, subdomain_id, {c} FROM {t} WHERE domain_id IS NOT NULL AND subdomain_id IS NOT NULL
  UNION ALL SELECT 3, area_id, domain_id, NULL, {c} FROM {t} WHERE area_id IS NOT NULL AND domain_id IS NOT NULL
  UNION ALL SELECT 4, area_id, domain_id, subdomain_id, {c} FROM {t} WHERE area_id IS NOT NULL AND domain_id IS NOT NULL AND subdomain_id IS NOT NULL)"""


def _counts(entity: str, n: str, where: str = "true") -> str:
    return f"""WITH {AUTHORS}, facts AS (SELECT * FROM authors WHERE {where}), {_MASKED.format(c=f"{entity}, department_id", t="facts")},
cells AS (SELECT DISTINCT mask, area_id, domain_id, subdomain_id, 0 AS g, NULL AS department_id, {entity} FROM masked UNION ALL SELECT DISTINCT mask, area_id, domain_id, subdomain_id, 1, department_id, {entity} FROM masked WHERE department_id IS NOT NULL)
SELECT mask, area_id, domain_id, subdomain_id, department_id, count(*) AS {n} FROM cells GROUP BY ALL"""


SQL = {
    "agg_a15_facet_paper_count": f"WITH {PAPERS}, {_MASKED.format(c='id', t='papers')} SELECT mask, area_id, domain_id, subdomain_id, count(*) AS paper_count FROM masked GROUP BY ALL",
    "agg_a15_facet_department_count": _counts("id", "paper_count"),
    "agg_a16_facet_faculty_count": _counts("kerberos", "faculty_count", "faculty_id IS NOT NULL"),
    "agg_a17_facet_members": f"""WITH {AUTHORS}, facts AS (SELECT * FROM authors WHERE faculty_id IS NOT NULL AND kerberos IS NOT NULL), {_MASKED.format(c="kerberos, id", t="facts")},
per AS (SELECT mask, area_id, domain_id, subdomain_id, kerberos, count(DISTINCT id) AS n FROM masked GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY mask, area_id, domain_id, subdomain_id ORDER BY n DESC, kerberos) AS r, count(*) OVER (PARTITION BY mask, area_id, domain_id, subdomain_id) AS member_total FROM per)
SELECT mask, area_id, domain_id, subdomain_id, string_agg(kerberos, ',' ORDER BY r) AS members, member_total FROM ranked WHERE r <= 500 GROUP BY mask, area_id, domain_id, subdomain_id, member_total""",
}
