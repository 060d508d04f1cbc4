"""Problem 1: one verdict and one domain per audited paper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import key, norm, norm_or_null
from ..operators.distributed import cut, latest
from ..sources.tables import load
from .consensus import consensus, named_spans, spectral_reliability, weighted_votes

VERDICTS = ["correct", "borderline", "incorrect"]
NOWHERE = "unclassifiable"
_NO_FIX = ["", "null", "none", "n/a", "na", "-"]


def _domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "domains").select("name", norm("name").alias("_norm")).groupBy("_norm").agg(F.min("name").alias("name"))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id`` and the audited ``domain`` as named in the taxonomy, one row per paper; of several the one on most rows."""
    named = load(spark, sf_dir, "audit100_v22_batch2_results").select(key("id").alias("id"), norm("domain").alias("_norm")).groupBy("id", "_norm").agg(F.count(F.lit(1)).alias("n"))
    first = named.groupBy("id").agg(F.max_by("_norm", F.struct("n", "_norm")).alias("_norm"))
    return first.join(_domains(spark, sf_dir), "_norm", "left").select("id", F.coalesce("name", "_norm").alias("domain"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per paper and annotator: ``item``, ``annotator``, ``label``, ``fix`` (a domain, ``unclassifiable`` or null).

    Auditors vote with their latest verdict that is not null. The model of audit50_v21_sample votes
    by its latest label: ``correct`` where that is the audited domain, else ``incorrect`` with its domain.
    """
    verdict = F.regexp_replace(F.lower("verdict"), r"[^a-z]", "")
    rows = load(spark, sf_dir, "audit100_v22_batch2_results").select(key("id").alias("item"), key("auditor").alias("annotator"), verdict.alias("label"), norm("suggested_fix").alias("raw"), "audited_at")
    rows = rows.where(F.col("label").isin(*VERDICTS) & F.col("annotator").isNotNull() & F.col("item").isNotNull())
    own = latest(rows, ["item", "annotator"], ["audited_at"]).drop("audited_at")
    raw = F.when(F.col("raw").isin(*_NO_FIX), F.lit(None)).otherwise(F.col("raw"))
    is_json = F.col("raw").startswith("{")
    stated = F.when(is_json, F.coalesce(F.get_json_object("raw", "$.domain"), F.lit(NOWHERE))).otherwise(F.col("raw"))
    own = own.withColumn("raw", raw).withColumn("raw", stated)
    fixes = named_spans(own.where(F.col("raw").isNotNull()), "raw", _domains(spark, sf_dir), "name", keys=["item", "annotator"])
    audited = papers(spark, sf_dir).withColumnRenamed("id", "item")
    fix = F.coalesce("name", F.when(F.col("raw").contains(NOWHERE), NOWHERE))
    # A fix that names the audited domain is none.
    own = own.join(fixes, ["item", "annotator"], "left").join(audited, "item", "left").select("item", "annotator", "label", F.when(~fix.eqNullSafe(F.col("domain")), fix).alias("fix"))

    labels = load(spark, sf_dir, "audit50_v21_sample").select(key("id").alias("item"), norm("source_model").alias("model"), norm_or_null("domain").alias("_norm"), "unclassifiable", "labelled_at")
    labels = latest(labels, ["item"], ["labelled_at"]).join(_domains(spark, sf_dir), "_norm", "left")
    said = F.when(F.coalesce("unclassifiable", F.lit(False)), NOWHERE).otherwise(F.col("name"))
    model = labels.select("item", "model", said.alias("fix")).where("fix IS NOT NULL AND model IS NOT NULL").join(audited, "item")
    same = F.col("fix") == F.col("domain")
    model = model.select("item", F.concat(F.lit("model:"), "model").alias("annotator"), F.when(same, "correct").otherwise("incorrect").alias("label"), F.when(~same, F.col("fix")).alias("fix"))
    return own.unionByName(model)


def _weighted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cast = cut(votes(spark, sf_dir))
    reliability = spectral_reliability(cast, VERDICTS)
    stated = cast.withColumn("fix", F.when(F.col("label") == "incorrect", F.col("fix")))
    return cut(weighted_votes(stated, reliability, VERDICTS, detail="fix")), reliability


def p1_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per paper: verdict, domain, the verdict's probability, share of agreeing pairs, votes."""
    weighted, _ = _weighted(spark, sf_dir)
    verdicts = consensus(weighted, VERDICTS, detail="fix", detailed="incorrect").withColumnRenamed("item", "id")
    moved = F.when(F.col("label") == "incorrect", F.coalesce("fix", F.lit(NOWHERE))).otherwise(F.col("domain"))
    return papers(spark, sf_dir).join(verdicts, "id").select("id", F.col("label").alias("verdict"), moved.alias("domain"), "support", "agreement", "n_votes")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_consensus(spark, sf_dir).select("id", "verdict", "domain")


def p1_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per auditor and model: votes, reliability, and the share of votes equal to the consensus."""
    weighted, reliability = _weighted(spark, sf_dir)
    agreed = weighted.join(consensus(weighted, VERDICTS, detail="fix", detailed="incorrect").select("item", F.col("label").alias("_final")), "item")
    share = agreed.groupBy("annotator").agg(F.avg((F.col("label") == F.col("_final")).cast("int")).alias("with_consensus"))
    return reliability.select("annotator", "n_votes", "centred", "reliability").join(share, "annotator", "left")


QUERIES = {"p1_found": p1_found, "p1_consensus": p1_consensus, "p1_reliability": p1_reliability}
SQL: dict = {}
