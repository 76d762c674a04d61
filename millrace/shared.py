"""Folders that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[tuple, str] = {}


def new_path(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a folder of our own, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/millrace/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df, written once and read again: it cuts the lineage, so that what is read often isn't computed often."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(table: DataFrame, tag: str, write) -> str:
    """The path of what write(path) wrote for this state of a table of files: made again only if a file came, went or changed.

    Only names, sizes and times of the files are read for that.
    """
    spark, m = table.sparkSession, F.col("_metadata")
    file = table.select(m["file_path"].alias("f"), m["file_size"].alias("s"), m["file_modification_time"].alias("t")).distinct()
    state = file.agg(F.count(F.lit(1)), F.sum(F.xxhash64("f", "s", "t").cast("decimal(38,0)"))).first()
    key = spark.sparkContext.applicationId, tag, tuple(state)
    if key not in _written:
        path = new_path(spark, tag)
        write(path)
        _written[key] = path
    return _written[key]


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in store.listStatus(p)) if store.exists(p) else []
