"""Byte-level BPE by ranks, with overlapping chunks: encoding and decoding.

A long text is cut into chunks, each with the first characters of the next one as its overlap. Chunks are pre-tokenised
in parallel, each from its own start, which may lie within a pre-token. Where both a chunk's reading of its overlap and
the next chunk's reading of the same characters have a border, the two have resynchronised: what a match of the pattern
is depends only on what follows its start, so from there on they agree. The borders are compared by a join of
neighbours; then each chunk's pre-tokens from its own point of agreement to the next one's are encoded. Chunks that
don't agree anywhere in their overlap (one pre-token is longer than that) are made one chunk and read again, until all
agree; so the result is exact for any text, and a text that is one pre-token is one chunk. Texts up to a chunk's
size are encoded where they are read, without a shuffle.

A border near the end of a chunk's reading isn't trusted: a match looks LOOK characters past its end at most.

Null text counts as empty, and an empty text has no ids. Special tokens' strings are ordinary text. Bytes that are no
UTF-8 are read as U+FFFD. Rows are told apart by their place in the input, so identifiers may be null or repeated; ties and repeated
rows give equal rows. Other columns aren't read. An empty table gives an empty result. Decoding joins the ids' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import ROW_KEY, Budget, Memory, bounded_batches, documents, dropped, owned, saved, with_row_key

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a chunk and of its overlap with the next one.
CHUNK, OVERLAP = 32_768, 256
#: Characters behind a match's end that the pattern may look at: a contraction has three.
LOOK = 4


class Bpe:
    """Ids of pre-tokens by ranks, and bytes of ids."""

    def __init__(self, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        import tiktoken

        with open(public_tokenizers.path(ranks) if os.sep not in ranks else ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.dtype = np.dtype("<u2") if max(table.values()) < 1 << 16 else np.dtype("<u4")
        self.surface = [b""] * (max(table.values()) + 1)
        for raw, i in table.items():
            self.surface[i] = raw
        self.said = [str(i) for i in range(len(self.surface))]
        self.pattern = regex.compile(pattern)
        merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.ids = Memory(lambda part: (np.array(merge(part), self.dtype).tobytes(), True), Budget())

    def encode_parts(self, parts: list[str]) -> bytes:
        return b"".join(map(self.ids.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        return self.encode_parts(self.pattern.findall(text))

    def borders(self, window: str, complete: bool) -> np.ndarray:
        """Where a reading from the start of window has borders that hold whatever follows it; complete: the text ends there."""
        ends = np.cumsum([0, *map(len, self.pattern.findall(window))])
        return ends if complete else ends[ends <= len(window) - LOOK]

    def parts_between(self, window: str, start: int, end: int) -> list[str]:
        """The pre-tokens from one border to another, read with all that follows them."""
        parts, left = self.pattern.findall(window, start), len(window) - end
        while left > 0:
            left -= len(parts.pop())
        if left:
            raise ValueError("a chunk was cut within a pre-token")
        return parts

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.surface.__getitem__, ids))


def bpe(ranks: str = RANKS) -> Bpe:
    """The encoder of a vocabulary in this Python process."""
    return owned(f"ranks-{ranks}", lambda: Bpe(ranks))


def _text(x) -> str:
    return (x.as_py() or b"").decode("utf-8", "replace")


def _id_lists(said: list[bytes], dtype: np.dtype) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in said])]) // dtype.itemsize
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(said), dtype).astype(np.int32)))


def chunks(texts: DataFrame, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Row key, id, k, body, after (the first characters of the next chunk), complete (the text ends with after). texts: row key, id, text (bytes)."""
    names = [*ROW_KEY, "id", "k", "body", "after", "complete"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, row, i, raw in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3), strict=True):
                text = _text(raw)
                for group in range(0, len(text), size * 32):
                    at = range(group, min(len(text), group + size * 32), size)
                    rows = [(file, row, i, x // size, text[x : x + size], text[x + size : x + size + overlap], x + size + overlap >= len(text)) for x in at]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return texts.mapInArrow(cut, f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id long, k long, body string, after string, complete boolean")


def neighbours(cut: DataFrame, ranks: str = RANKS, overlap: int = OVERLAP) -> DataFrame:
    """Row key, k, start: the first border after a chunk's start that both it and the chunk before it have; null if there is none, 0 for a first chunk."""
    schema = f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, k long, following long, head array<int>, tail array<int>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, head, tail = bpe(ranks), [], []
            for body, after, complete in zip(*(b.column(c).to_pylist() for c in ("body", "after", "complete")), strict=True):
                x = of.borders(body + after, complete)
                head.append(x[x <= overlap].tolist())
                tail.append((x[x >= len(body)] - len(body)).tolist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*ROW_KEY, "k", "following")), pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], [*ROW_KEY, "k", "following", "head", "tail"])

    if "following" not in cut.columns:
        cut = cut.withColumn("following", F.col("k") + 1)
    x = saved(cut.select(*ROW_KEY, "k", "following", "body", "after", "complete").mapInArrow(read, schema), "borders")
    before = x.select(*ROW_KEY, F.col("following").alias("k"), F.col("tail").alias("other"))
    met = x.join(before, [*ROW_KEY, "k"], "left")
    return met.select(*ROW_KEY, "k", F.when(F.col("k") == 0, 0).otherwise(F.array_min(F.array_intersect("head", "other"))).alias("start"))


def joined(cut: DataFrame, starts: DataFrame) -> DataFrame:
    """Chunks that don't agree with the one before them are made one with it."""
    runs = W.partitionBy(*ROW_KEY).orderBy("k")  # narrow rows, one a chunk of a text
    group = starts.withColumn("g", F.max(F.when(F.col("start").isNotNull(), F.col("k"))).over(runs)).select(*ROW_KEY, "k", "g")
    one = cut.join(group, [*ROW_KEY, "k"]).groupBy(*ROW_KEY, "g")
    parts = F.array_sort(F.collect_list(F.struct("k", "body")))
    last = lambda c: F.max_by(c, "k").alias(c)
    out = one.agg(F.first("id").alias("id"), F.array_join(F.transform(parts, lambda p: p["body"]), "").alias("body"), last("after"), last("complete"), last("following"))
    return out.withColumnRenamed("g", "k")


def stitched(cut: DataFrame, ranks: str = RANKS, overlap: int = OVERLAP) -> DataFrame:
    """Chunks that agree with their neighbours, and the borders between which each is to be encoded: start, end."""
    cut, done = cut.withColumn("following", F.col("k") + 1), None
    while True:
        starts = saved(neighbours(cut, ranks, overlap), "starts")
        apart = starts.filter("start is null").select(*ROW_KEY).distinct()
        more = bool(apart.head(1))
        ends = starts.select(*ROW_KEY, F.col("k").alias("following"), F.col("start").alias("reach"))
        met = cut.join(starts, [*ROW_KEY, "k"]).join(ends, [*ROW_KEY, "following"], "left")
        if more:
            met = met.join(apart, ROW_KEY, "left_anti")
        met = met.withColumn("end", F.char_length("body") + F.coalesce("reach", F.lit(0))).select(*cut.columns, "start", "end")
        done = met if done is None else done.unionByName(met)
        if not more:
            return done
        cut = saved(joined(cut.join(apart, ROW_KEY, "left_semi"), starts).select(*cut.columns), "joined")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """id, ids: one row per row of docs."""
    if not LOOK < overlap <= size:
        raise ValueError("an overlap is longer than what a match looks at, and no longer than a chunk")
    bounded_batches(docs.sparkSession)
    rows = with_row_key(docs).select(*ROW_KEY, F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    length = F.char_length("text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = bpe(ranks)
            for at in range(0, b.num_rows, 1000):
                said = [of.encode(_text(x)) for x in b.column(1)[at : at + 1000]]
                yield pa.RecordBatch.from_arrays([b.column(0)[at : at + 1000], _id_lists(said, of.dtype)], ["id", "ids"])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = bpe(ranks)
            said = [of.encode_parts(of.parts_between(body + after, start, end)) for body, after, start, end in zip(*(b.column(c).to_pylist() for c in ("body", "after", "start", "end")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*ROW_KEY, "id", "k")), _id_lists(said, of.dtype)], [*ROW_KEY, "id", "k", "ids"])

    raw = F.col("text").cast("binary").alias("text")
    short = rows.filter(length <= size).select("id", raw).mapInArrow(whole, "id long, ids array<int>")
    long = chunks(rows.filter(length > size).select(*ROW_KEY, "id", raw), size, overlap)
    cut = saved(long.repartition(*ROW_KEY, "k"), "chunks")  # the chunks of a text go to all tasks
    if not cut.head(1):
        dropped(cut)
        return short
    parts = stitched(cut, ranks, overlap).select(*ROW_KEY, "id", "k", "body", "after", "start", "end")
    parts = parts.mapInArrow(between, f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id long, k long, ids array<int>")
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda p: p["ids"]))
    return short.unionByName(parts.groupBy(*ROW_KEY).agg(F.first("id").alias("id"), ids.alias("ids")).select("id", "ids"))


def decode(rows: DataFrame, ids_col: str = "ids", out_col: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """id and a column of bytes; null ids give null."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = bpe(ranks)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else of.decode(x) for x in b.column(1).to_pylist()], pa.binary())], ["id", out_col])

    return rows.select("id", F.col(f"`{ids_col}`")).mapInArrow(join, f"id long, {out_col} binary")


def digest(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: of the ids, decimal and joined by spaces, and of the bytes they decode to."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, rows = bpe(ranks), []
            for x in b.column(1):
                ids = x.values.to_numpy().tolist()
                rows.append((len(ids), hashlib.sha256(" ".join(map(of.said.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(of.decode(ids)).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string()), strict=True)]], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("id", "ids").mapInArrow(measure, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(encode(documents(spark, sf_dir))).withColumnRenamed("id", "doc_id")
