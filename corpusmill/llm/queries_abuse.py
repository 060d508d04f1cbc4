"""Problem 8: abusive, hateful or sexual content of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import key
from ..operators.distributed import cut
from ..sources.tables import load
from .abuse import FOLDS, abuse_features, abuse_rates, abuse_scores, labelled_documents, learned_terms

#: Probability from which a document counts as found.
THRESHOLD = 0.5


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labelled = cut(labelled_documents(load(spark, sf_dir, "labels")))  # at most MAX_LABELLED rows
    terms = learned_terms(documents, labelled)
    joined = documents.join(F.broadcast(labelled), "doc_id", "left")
    return abuse_scores(cut(joined.select("doc_id", key("source").alias("source"), "y", "fold", abuse_features("text", terms, F.coalesce("fold", F.lit(FOLDS))).alias("features"))))


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("doc_id", "source", "score")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).where(F.col("score") >= THRESHOLD).select("doc_id")


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of found documents per source."""
    return abuse_rates(_scored(spark, sf_dir), "source", THRESHOLD)


QUERIES = {"p8_found": p8_found, "p8_scores": p8_scores, "p8_rates": p8_rates}
SQL: dict = {}
