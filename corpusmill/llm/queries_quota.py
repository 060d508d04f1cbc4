"""Problem 2: a sample of labels by area, band of confidence and model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import band, norm
from ..operators.distributed import cut, latest, replicate, salt_of
from ..plans.sqltext import norm as norm_sql
from ..sources.tables import load
from .quota import divisor_ranks, divisor_sample, quota_report

_LINE = ["_area", "band", "_model"]


def labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each id once with its latest label and its target line (null if none), and the targets."""
    rows = load(spark, sf_dir, "audit50_v21_sample").select(norm("id").alias("id"), "thematic_area", "confidence", "source_model", "unclassifiable", "labelled_at")
    now = latest(rows, ["id"], ["labelled_at"]).where(~F.coalesce("unclassifiable", F.lit(False)) & F.col("id").isNotNull())
    labels = now.select("id", "thematic_area", "confidence", "source_model", norm("thematic_area").alias("_area"), band("confidence").alias("band"), norm("source_model").alias("_model"))
    targets = load(spark, sf_dir, "sample_targets").withColumns({"_area": norm("thematic_area"), "_model": norm("source_model")})
    keys = replicate(targets.select("target_id", *_LINE), 16)
    joined = labels.withColumn("_salt", salt_of(["id"], 16)).join(keys, [*_LINE, "_salt"], "left")
    return joined.select("id", "thematic_area", "band", "source_model", "target_id"), targets


def p2_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, targets = labelled(spark, sf_dir)
    return divisor_sample(records, targets)


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target line: available, wanted and drawn."""
    records, targets = labelled(spark, sf_dir)
    return quota_report(divisor_ranks(cut(records), targets), targets)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_report(spark, sf_dir).where(~F.col("is_met")).select("target_id")


QUERIES = {"p2_found": p2_found, "p2_sample": p2_sample, "p2_report": p2_report}

_LABELS = f"""now AS (SELECT id, unnest(arg_max(v, (labelled_at, v.a, v.confidence, v.m, v.unclassifiable))) FROM (
  SELECT {norm_sql("id")} AS id, labelled_at, {{'a': {norm_sql("thematic_area")}, 'confidence': confidence, 'm': {norm_sql("source_model")}, 'unclassifiable': unclassifiable}} AS v FROM audit50_v21_sample) GROUP BY id),
labels AS (SELECT id, a, m, CASE WHEN confidence < 0.5 THEN '<0.5' WHEN confidence < 0.8 THEN '0.5-0.8' WHEN confidence >= 0.8 THEN '>=0.8' END AS band FROM now WHERE NOT unclassifiable),
available AS (SELECT t.target_id, t.target_share, t.min_rows, t.sample_size, count(l.id) AS n FROM sample_targets t
  LEFT JOIN labels l ON l.a = {norm_sql("t.thematic_area")} AND l.m = {norm_sql("t.source_model")} AND l.band = t.band GROUP BY ALL)"""
#: Floors first, then the smallest priorities of all lines; ties by line.
_DRAWN = f"""{_LABELS}, ranks AS (SELECT target_id, sample_size, r, r <= min_rows AS floor, (r - 0.5) / nullif(target_share, 0) AS priority FROM (SELECT *, unnest(range(1, n + 1)) AS r FROM available)),
seats AS (SELECT target_id, floor OR (priority IS NOT NULL AND row_number() OVER (ORDER BY NOT floor, priority NULLS LAST, target_id, r) <= sample_size) AS drawn FROM ranks),
counted AS (SELECT target_id, count(*) FILTER (drawn) AS k FROM seats GROUP BY 1)"""
SQL = {
    "p2_report": f"""WITH {_DRAWN} SELECT a.target_id, a.target_share, a.min_rows, a.sample_size, a.n AS n_available, coalesce(c.k, 0) AS n_drawn, greatest(a.min_rows, a.target_share * a.sample_size) AS n_wanted,
a.n >= greatest(a.min_rows, a.target_share * a.sample_size) AS is_met, coalesce(coalesce(c.k, 0) / nullif(sum(coalesce(c.k, 0)) OVER (), 0), 0.0) AS actual_share FROM available a LEFT JOIN counted c USING (target_id)""",
    "p2_found": f"WITH {_LABELS} SELECT target_id FROM available WHERE n < greatest(min_rows, target_share * sample_size)",
}
