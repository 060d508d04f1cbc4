"""Round trips through the file sources and sinks: what is written is read again and must equal the table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.distributed import shared_folder
from ..sources import files
from ..sources.tables import load

_NATION = "n_nationkey int, n_name string, n_regionkey int, n_comment string"


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex[:12]}"


def _nation(spark, sf_dir):
    rows = load(spark, sf_dir, "nation").withColumn("n_comment", F.lower("n_name"))
    return rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in _NATION.split(", ")])


def jsonl(spark, sf_dir):
    """Overwritten with a fixed list of fields, nulls written out, then read under a schema (S6, S11, S17)."""
    path = _folder(spark)
    table = _nation(spark, sf_dir).withColumn("n_comment", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_comment")))
    files.write_jsonl(table.limit(3), path, table.columns)
    files.write_jsonl(table, path, table.columns)
    return files.read_jsonl(spark, path, _NATION, strict=True)


def jsonl_log(spark, sf_dir):
    """Appended later with other values for some keys; the last line of a key counts (S7, S10)."""
    path = _folder(spark)
    table = _nation(spark, sf_dir)
    files.append_jsonl(table, path)
    files.append_jsonl(table.where("n_regionkey = 1").withColumn("n_comment", F.lit("changed")), path)
    return files.read_jsonl_latest(spark, path, table.schema, "n_nationkey")


def csv(spark, sf_dir):
    """Quoted CSV with header and byte order mark (S13)."""
    path = _folder(spark)
    table = _nation(spark, sf_dir).select("n_nationkey", "n_name", "n_regionkey")
    files.write_csv(table, path, ["n_regionkey", "n_name"])
    return files.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


def published(spark, sf_dir):
    """Two versions published; the last one is read (S18)."""
    root = _folder(spark)
    table = _nation(spark, sf_dir)
    files.publish(table.limit(5), root)
    files.publish(table.where("n_regionkey < 3"), root)
    return files.read_published(spark, root)


def manifested(spark, sf_dir):
    """A manifest of files: each listed once with a digest that its own bytes have (S19)."""
    path = _folder(spark)
    _nation(spark, sf_dir).repartition(4).write.parquet(path)
    listed = files.manifest(spark, path).where(F.col("path").endswith(".parquet"))
    return listed.agg((F.count(F.lit(1)) == F.countDistinct("path")).alias("paths_differ"), F.min(F.length("sha256")).alias("digest_length"), (F.min("length") > 0).alias("all_have_bytes"))


QUERIES = {"source_s6_jsonl": jsonl, "source_s7_jsonl_log": jsonl_log, "sink_s13_csv": csv, "sink_s18_published": published, "sink_s19_manifest": manifested}

_N = "n_nationkey::INT AS n_nationkey, n_name, n_regionkey::INT AS n_regionkey"
SQL = {
    "source_s6_jsonl": f"SELECT {_N}, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) END AS n_comment FROM nation",
    "source_s7_jsonl_log": f"SELECT {_N}, CASE WHEN n_regionkey = 1 THEN 'changed' ELSE lower(n_name) END AS n_comment FROM nation",
    "sink_s13_csv": f"SELECT {_N} FROM nation",
    "sink_s18_published": f"SELECT {_N}, lower(n_name) AS n_comment FROM nation WHERE n_regionkey < 3",
    "sink_s19_manifest": "SELECT true AS paths_differ, 64 AS digest_length, true AS all_have_bytes",
}
