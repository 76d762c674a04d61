"""The only module that writes results: reports, tables and snapshots."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.records import benchmark_lines


def json_document(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)  # a report of a few rows


def csv_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("append")
    (w.partitionBy(by) if by else w).parquet(path)


def feedback(df: DataFrame, path: str) -> None:
    if "reviews" not in df.columns:
        raise ValueError("feedback needs reviews")
    json_document(df, path)


def text_file(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one file of that name, in any store that Spark writes to; an older one goes."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def benchmark_files(spark: SparkSession, record: dict, folder: str) -> None:
    """benchmark.json and benchmark.md of a record made by operators.records.benchmark()."""
    text_file(spark, json.dumps(record, indent=2), f"{folder}/benchmark.json")
    text_file(spark, "\n".join(benchmark_lines(record)), f"{folder}/benchmark.md")


def eval_set(df: DataFrame, path: str) -> None:
    q = F.regexp_replace("query", r"^\s+|\s+$", "")
    json_document(df.select(q.alias("query"), "should_trigger").filter("query <> ''"), path)
