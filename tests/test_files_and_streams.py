import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources import files
from corpusmill.streaming.queue import label_stream, rolling_usage

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_jsonl_last_line_wins(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"a","n":1}\n\n{"id":"b","n":2}\nnot json\n{"id":"a","n":3}\n')
    assert files.read_jsonl(spark, str(tmp_path), SCHEMA).count() >= 3
    got = files.read_jsonl_latest(spark, str(tmp_path), SCHEMA, "id").where("id is not null").collect()
    assert sorted((r.id, r.n) for r in got) == [("a", 3), ("b", 2)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", None)], SCHEMA)
    files.write_jsonl(df, str(tmp_path / "j"), ["n", "id"])
    files.append_jsonl(df, str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), SCHEMA).count() == 4
    files.write_csv(df, str(tmp_path / "c"), [F.col("id")])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert files.manifest(spark, str(tmp_path / "c")).where("length > 0").count() >= 1
    files.publish(df, str(tmp_path / "p"))
    files.publish(df.limit(1), str(tmp_path / "p"))
    assert files.read_published(spark, str(tmp_path / "p")).count() == 1


def test_label_stream_resumes(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    label = lambda pdf: pd.DataFrame({"id": pdf["id"], "label": pdf["n"] * 2})
    for k in range(2):
        spark.createDataFrame([("a", 1), ("a", 1), (f"x{k}", 5)], SCHEMA).write.mode("append").parquet(source)
        label_stream(spark.readStream.schema(SCHEMA).parquet(source), label, "id string, label long", sink, str(tmp_path / "ck")).awaitTermination(120)
    assert sorted((r.id, r.label) for r in spark.read.parquet(sink).collect()) == [("a", 2), ("x0", 10), ("x1", 10)]


def test_rolling_usage(spark, tmp_path):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:05' as ts, 3L as v union all select timestamp_ntz'2024-01-01 00:00:50', 4L")
    df.write.parquet(str(tmp_path / "e"))
    q = rolling_usage(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")), "ts", "v").writeStream.format("memory").queryName("usage").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select max(total) from usage").first()[0] == 7
