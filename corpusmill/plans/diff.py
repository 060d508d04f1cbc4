"""Problem 4: two copies of the same labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import key
from ..operators.diff import diff_copies
from ..sources.tables import load
from .sqltext import norm_or_null, stripped

FIELDS = ["thematic_area", "domain"]


def p4_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every differing id with its side and the array of field, left value, right value."""
    return diff_copies(load(spark, sf_dir, "audit50_v21_sample"), load(spark, sf_dir, "audit50_v21_batches"), "id", FIELDS, order="labelled_at", normal_key=key)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("side") == "left_only", F.array(F.lit("only_in_sample"))).when(F.col("side") == "right_only", F.array(F.lit("only_in_batches"))).otherwise(F.col("differences.field"))
    return p4_diff(spark, sf_dir).select("id", F.explode(named).alias("difference"))


def p4_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per differing field, both values as compared."""
    return p4_diff(spark, sf_dir).select("id", F.explode("differences").alias("d")).select("id", "d.field", "d.left_value", "d.right_value")


def p4_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_found(spark, sf_dir).groupBy("difference").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"p4_found": p4_found, "p4_fields": p4_fields, "p4_summary": p4_summary}


def _side(table: str) -> str:
    return f"""(SELECT k, arg_max(v, (labelled_at, v)) AS v FROM (
      SELECT {stripped("lower(id)")} AS k, labelled_at,
        {{'t': {norm_or_null("thematic_area")}, 'd': {norm_or_null("domain")}}} AS v FROM {table}) GROUP BY k)"""


_BOTH = f"""j AS (SELECT coalesce(a.k, b.k) AS id, a.k AS ak, b.k AS bk, a.v AS av, b.v AS bv FROM {_side("audit50_v21_sample")} a FULL JOIN {_side("audit50_v21_batches")} b ON a.k IS NOT DISTINCT FROM b.k),
found AS (
  SELECT id, 'only_in_sample' AS difference FROM j WHERE bk IS NULL
  UNION ALL SELECT id, 'only_in_batches' FROM j WHERE ak IS NULL
  UNION ALL SELECT id, 'thematic_area' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND av.t IS DISTINCT FROM bv.t
  UNION ALL SELECT id, 'domain' FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND av.d IS DISTINCT FROM bv.d)"""
SQL = {
    "p4_found": f"WITH {_BOTH} SELECT id, difference FROM found",
    "p4_summary": f"WITH {_BOTH} SELECT difference, count(*) AS n FROM found GROUP BY difference",
    "p4_fields": f"""WITH {_BOTH}
SELECT id, 'thematic_area' AS field, av.t AS left_value, bv.t AS right_value FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND av.t IS DISTINCT FROM bv.t
UNION ALL SELECT id, 'domain', av.d, bv.d FROM j WHERE ak IS NOT NULL AND bk IS NOT NULL AND av.d IS DISTINCT FROM bv.d""",
}
