"""Token-id output: documents keyed by identifier in sorted-string-table shards, and lookup in them.

Documents are dealt by ranges of the identifier, sorted, encoded, and each range written as one
table (sstable.py) below the shared folder. A manifest, one row a shard, lists path, key range and
totals; a shard that no manifest row names (of a task that was run again) is never read. Files are
opened with pyarrow.fs, so the folder may be on any store that it knows.

Null text is encoded as empty; each document has the end id last, so an empty one has that alone.
Null identifiers come first; rows with one identifier follow one another in the order of a hash of their texts, in
one shard or several, and get() returns them all. An empty table gives an empty manifest. Other columns aren't read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import sstable
from millrace.llm.byte_bpe import VOCAB, encoder
from millrace.llm.common import bounded_batches, documents, saved, shared_path

MANIFEST = "path string, first_key binary, last_key binary, n_docs long, n_ids long, n_bytes long, shard int"
#: A shard has about so many bytes of text at most, so that its writer's keys and its task stay small.
SHARD_BYTES, SHARD_DOCS = 128 << 20, 1_000_000


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB, end_id: int = 0) -> DataFrame:
    """Write docs as shards below folder; the manifest, in key order. Texts are dealt and sorted, and encoded where they are written, so that ids lie in the shards only."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out = path = table = None
        for b in batches:
            ids, dtype = encoder(vocab).ids, encoder(vocab).dtype
            end = np.array([end_id], dtype).tobytes()
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if table is None:
                    store.create_dir(root, recursive=True)
                    path = f"{root}/{uuid.uuid4().hex}.sst"
                    out = store.open_output_stream(path)
                    table = sstable.Writer(out, dtype.itemsize)
                table.add(sstable.key_of(doc), ids(text.as_py() or "") + end)
        if table is not None:
            table.close()
            out.close()
            row = [[path], [table.first], [table.last], [table.n], [table.n_ids], [table.at], [TaskContext.get().partitionId()]]
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["path", "first_key", "last_key", "n_docs", "n_ids", "n_bytes", "shard"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-n // SHARD_DOCS), -(-size // SHARD_BYTES))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc()]  # rows of one identifier may go to several shards
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n_shards, *order).sortWithinPartitions(*order)
    return saved(dealt.select("id", "text").mapInArrow(write, MANIFEST), "manifest").orderBy("shard")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32 (of uint32 ids)."""
    spark = manifest.sparkSession
    shards, start = [], 0
    for r in manifest.orderBy("shard").select("path", "n_ids").collect():  # one row a shard
        shards.append((r["path"], start))
        start += r["n_ids"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as f:
                    table, rows = sstable.Reader(f), []
                    for key, value in table:
                        ids = np.frombuffer(value, f"<u{table.id_bytes}")
                        rows.append((sstable.id_of(key), at, len(ids), zlib.crc32(ids.astype("<u4"))))
                        at += len(ids)
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    return spark.createDataFrame(shards, "path string, start long").repartition(len(shards)).mapInArrow(read, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])


class Lookup:
    """Ids of single documents, by binary search in manifest and index, past the Bloom filters."""

    def __init__(self, manifest: DataFrame, folder: str):
        rows = manifest.orderBy("shard").collect()
        self.store, _ = fs.FileSystem.from_uri(folder)
        self.paths = [r["path"] for r in rows]
        self.firsts, self.lasts = [bytes(r["first_key"]) for r in rows], [bytes(r["last_key"]) for r in rows]

    def get(self, doc_id: int | None) -> list[list[int]]:
        key, found = sstable.key_of(doc_id), []
        for k in sstable.shard_of(self.firsts, self.lasts, key):
            with self.store.open_input_file(self.paths[k]) as f:
                table = sstable.Reader(f)
                found += [np.frombuffer(v, f"<u{table.id_bytes}").tolist() for v in table.get(key)]
        return found


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "shards")
    return read_shards(write_shards(documents(spark, sf_dir), folder), folder)
