"""Problems 6 and 7: packing and mixing documents by their size in tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distributed import cut, require_at_most
from ..sources.tables import load
from .mixing import mix_order, mix_shares, mix_uses
from .packing import fill_report, pack, split_documents
from .tokens import sized


def _capacity(spark: SparkSession, sf_dir: str) -> int:
    lines = require_at_most(load(spark, sf_dir, "containers").select("capacity_tokens"), 1, "containers")
    return lines[0][0]


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document or piece."""
    return pack(cut(sized(load(spark, sf_dir, "documents"), keep=["doc_id"])), _capacity(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(p6_pack(spark, sf_dir)).select("doc_id")


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p6_pack(spark, sf_dir), _capacity(spark, sf_dir))


def _uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_uses(cut(sized(load(spark, sf_dir, "documents"), keep=["doc_id", "source"])), load(spark, sf_dir, "mix_plan"))


def p7_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is used."""
    return _uses(spark, sf_dir).select("doc_id", "source", "n_tokens", "n_uses")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    uses, plan = cut(_uses(spark, sf_dir)), load(spark, sf_dir, "mix_plan")
    return mix_shares(mix_order(uses, plan), uses, plan)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_shares(spark, sf_dir).where("falls_short").select("source")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix as a stream, earliest deadline first."""
    return mix_order(cut(_uses(spark, sf_dir)), load(spark, sf_dir, "mix_plan"))


QUERIES = {"p6_found": p6_found, "p6_pack": p6_pack, "p6_fill": p6_fill, "p7_found": p7_found, "p7_shares": p7_shares, "p7_uses": p7_uses, "p7_mix": p7_mix}

#: Words and marks: a tokenizer that SQL can express; no document or source is close to a limit.
_WORDS = r"len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'))"
SQL = {
    "p6_found": f"SELECT doc_id FROM documents WHERE {_WORDS} > (SELECT max(capacity_tokens) FROM containers)",
    "p7_found": f"""
WITH s AS (SELECT lower(trim(source)) AS k, sum({_WORDS}) AS n FROM documents GROUP BY 1)
SELECT p.source FROM mix_plan p LEFT JOIN s ON s.k = lower(trim(p.source)) WHERE coalesce(s.n, 0) * p.max_repeats < p.target_share * p.total_tokens""",
}
