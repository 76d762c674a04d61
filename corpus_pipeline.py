"""A training-corpus pipeline: each stage reads all that the one before it kept.

Null, empty and very long texts, ties, repeated rows and an empty table have at each stage the result that its operator's
docstring states: a null or empty text isn't toxic, is an exact copy of other such texts, near to nothing, not contaminated, and
has no ids. Columns other than doc_id and text are handed on as they are; a column that the last stage adds replaces one of its name.
One stage's table is in the shared folder at a time, and the one that the next writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, exact_dedup, near_dup, piece_fst, toxicity
from millrace.llm.common import documents, dropped, saved, scratch


#: What a worker of the last stage may remember, in bytes: by then the executor's own memory has grown to its most.
PIECE_BYTES = 32 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_fst.encode(docs, memory=PIECE_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # what a stage has saved goes when its result is written, and then the table it read
            kept = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"), keep=True)
        dropped(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages on language models and signatures have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
