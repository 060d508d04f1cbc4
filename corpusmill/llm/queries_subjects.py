"""Problem 5: thematic areas of each paper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hygiene import is_junk
from ..functions.text import key, norm, reference_key
from ..operators.distributed import latest
from ..sources.tables import load
from .subjects import OUTSIDE, chosen_subjects, propagate_subjects


#: Rows of a dimension that is broadcast.
SMALL = 10_000
_AROUND = r"(?:[^\w<]|<[^<>]*+>|<)*+"
_MISSING = rf"(?i)^{_AROUND}no abstract available{_AROUND}$"


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(load(spark, sf_dir, "thematicareas").where("deleted_at IS NULL").select(reference_key("_id").alias("area_id"), "name"))


def _local(df: DataFrame) -> DataFrame:
    """A dimension, broadcast if it is small, so that joins with it need no shuffle of the other side; beyond, it is joined by a shuffle."""
    rows = df.limit(SMALL + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= SMALL else df


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that is no editorial item: ``id``, ``title``, ``text``, ``hint`` (the stored area, by its own key or the domain's), ``updated``."""
    rows = load(spark, sf_dir, "researchmetadatascopus").select(
        F.col("_id").alias("id"), "title", "abstract", "updated_at",
        reference_key("classification.thematic_area_id").alias("area_id"), reference_key("classification.domain_id").alias("domain_id"), F.coalesce("classification.unclassifiable", F.lit(False)).alias("outside"),
    )
    areas = _areas(spark, sf_dir)
    domains = _local(load(spark, sf_dir, "domains").where("deleted_at IS NULL").select(reference_key("_id").alias("domain_id"), reference_key("thematic_area_id").alias("area_id")).join(areas, "area_id").select("domain_id", F.col("name").alias("by_domain")))
    named = rows.join(areas, "area_id", "left").join(domains, "domain_id", "left")
    # Stored keys that disagree are no hint.
    hint = F.when(F.col("outside"), OUTSIDE).when(F.col("name").isNull() | F.col("by_domain").isNull() | (F.col("name") == F.col("by_domain")), F.coalesce("name", "by_domain"))
    # A notice, whatever marks and markup stand around it; possessive, so an abstract is left at its first letter.
    missing = F.col("abstract").rlike(_MISSING)
    text = F.when(missing, F.lit(None)).otherwise(F.col("abstract"))
    # The latest row counts, one with a text before one without.
    version = F.struct(F.coalesce(text.rlike(r"\w"), F.lit(False)).alias("has_text"), "updated_at")
    return named.select("id", "title", text.alias("text"), hint.alias("hint"), version.alias("version")).where(~is_junk(F.coalesce("title", F.lit(""))))


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose stored area and separate label agree."""
    rows = load(spark, sf_dir, "researchmetadatascopus").select(F.col("_id").alias("id"), reference_key("classification.thematic_area_id").alias("area_id"), F.coalesce("classification.unclassifiable", F.lit(False)).alias("outside"), "updated_at")
    stored = latest(rows, ["id"], ["updated_at"]).where(~F.col("outside")).join(_areas(spark, sf_dir), "area_id").select("id", F.col("name").alias("subject"))
    labels = load(spark, sf_dir, "audit50_v21_sample").select(key("id").alias("id"), norm("thematic_area").alias("_norm"), "unclassifiable", "labelled_at")
    labels = latest(labels, ["id"], ["labelled_at"]).where(~F.coalesce("unclassifiable", F.lit(False)))
    return stored.withColumn("_norm", norm("subject")).join(labels.select("id", "_norm"), ["id", "_norm"], "left_semi").select("id", "subject")


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of audit50_v21_sample, a hint for papers without a stored one: ``id``, ``subject``."""
    labels = load(spark, sf_dir, "audit50_v21_sample").select(key("id").alias("id"), norm("thematic_area").alias("_norm"), F.coalesce("unclassifiable", F.lit(False)).alias("outside"), "labelled_at")
    areas = _areas(spark, sf_dir)
    joined = latest(labels, ["id"], ["labelled_at"]).join(_local(areas.select(norm("name").alias("_norm"), "name")), "_norm", "left")
    return joined.select("id", F.when(F.col("outside"), OUTSIDE).otherwise(F.col("name")).alias("subject")).where("id IS NOT NULL AND subject IS NOT NULL")


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The taxonomy's own words as documents, one per domain in use, like ``papers``."""
    areas = _areas(spark, sf_dir)
    rows = load(spark, sf_dir, "domains").where("deleted_at IS NULL").select(reference_key("_id").alias("domain_id"), "name", "definition", "example_titles", reference_key("thematic_area_id").alias("area_id"))
    text = F.array_join(F.concat(F.array(F.coalesce("definition", F.lit(""))), F.coalesce("example_titles", F.array().cast("array<string>"))), ". ")
    joined = rows.join(areas.withColumnRenamed("name", "hint"), "area_id")
    version = F.struct(F.lit(True).alias("has_text"), F.lit(None).cast("timestamp").alias("updated_at"))
    return joined.select(F.concat(F.lit(_TAXONOMY), "domain_id").alias("id"), F.col("name").alias("title"), text.alias("text"), "hint", version.alias("version"))


_TAXONOMY = "taxonomy:"


def p5_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of each paper with their sentences and share of the abstract."""
    own = taxonomy(spark, sf_dir)
    seeds = trusted(spark, sf_dir).unionByName(own.select("id", F.col("hint").alias("subject")))
    found = propagate_subjects(papers(spark, sf_dir).unionByName(own), seeds, audited(spark, sf_dir), order="version")
    return chosen_subjects(found.where(~F.col("id").startswith(_TAXONOMY))).select(F.col("id").alias("paper_id"), F.col("subject").alias("thematic_area"), "n_sentences", "share")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_areas(spark, sf_dir).select("paper_id", "thematic_area")


def p5_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers per area, a paper with several areas counted by parts."""
    areas = p5_areas(spark, sf_dir)
    parts = areas.join(areas.groupBy("paper_id").agg(F.count(F.lit(1)).alias("k")), "paper_id")
    sums = parts.groupBy("thematic_area").agg(F.count(F.lit(1)).alias("n_papers"), F.sum(1 / F.col("k")).alias("parts"))
    return sums.join(sums.agg(F.sum("parts").alias("_all")), how="cross").select("thematic_area", "n_papers", F.round(F.col("parts") / F.col("_all"), 6).alias("share"))  # one row


QUERIES = {"p5_found": p5_found, "p5_areas": p5_areas, "p5_composition": p5_composition}
SQL: dict = {}
