"""Readers and writers of line-delimited JSON, CSV, versioned tables and manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, *, strict: bool = False) -> DataFrame:
    """Rows of line-delimited JSON under an explicit schema; blank and malformed lines are left out, or an error if ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_jsonl_latest(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """One row per key, the last line of the last file: appended files are logs in which later lines replace earlier ones."""
    rows = read_jsonl(spark, path, schema).select("*", F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    order = W.partitionBy(key).orderBy(F.desc("_at"), F.desc("_file"), F.desc("_line"))
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn", "_at", "_file", "_line")


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_jsonl(df: DataFrame, path: str, fields: list[str]) -> None:
    """Overwrites with a fixed list of fields, nulls written out."""
    df.select(*fields).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


#: Marks a file as UTF-8 for spreadsheet programs.
BYTE_ORDER_MARK = "\ufeff"


def write_csv(df: DataFrame, path: str, order: list) -> None:
    """Quoted CSV with a header and a byte order mark, sorted by ``order`` over all files.

    The mark stands at the start of each file, as part of the first column's name in the header.
    """
    first, *rest = df.columns
    marked = df.orderBy(*order).select(F.col(f"`{first}`").alias(BYTE_ORDER_MARK + first), *[F.col(f"`{c}`") for c in rest])
    marked.write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of ``write_csv`` under an explicit schema; the header, with or without the mark, is no row."""
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").csv(path)


def publish(df: DataFrame, root: str) -> str:
    """Writes a new version under ``root`` and then points to it; earlier versions stay. Returns the version."""
    version = uuid.uuid4().hex[:12]
    df.write.parquet(f"{root}/version={version}")
    pointer = df.sparkSession.createDataFrame([(version,)], "version string").withColumn("published_at", F.current_timestamp())
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/_pointer")
    return version


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The version that was published last."""
    last = spark.read.parquet(f"{root}/_pointer").agg(F.max_by("version", "published_at")).first()[0]
    return spark.read.parquet(f"{root}/version={last}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and SHA-256 of each file below ``path``. A file is read whole into one row, so parts must be below 2 GB."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
