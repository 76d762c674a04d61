"""Full-text search over a stored inverted index.

Items are taken in blocks of PER_BLOCK as they are read, and a block's postings are made where its texts are: no posting is
shuffled by item. The postings of one term in one block are one row: the items' places in the block as gaps, term frequencies,
how many there are and the greatest frequency among them. So a term that every item has is spread over as many rows as there
are blocks, no group grows beyond a block, and a conjunction is a matter of equal blocks: a block that lacks a term is skipped
without reading its postings. A block's ids are a row too, which only blocks that have hits are asked for.

Rows lie in folders by a hash of the term, sorted by term and block: a query opens only its terms' folders, and Parquet's
own statistics leave out what lies between. The first pass over them reads no postings but each block's bound, the sum
of its terms' greatest frequencies. The blocks with the greatest bounds are scored first; of the others, only those whose
bound reaches the k-th score found so far.

An item's score is the summed frequency of the terms; ties go to the smaller id. Each row is an item, also where rows share an
id; items without an id can't be found. Null and empty texts have no terms. An empty table gives an index without rows. Further
items may be appended to an index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T

#: Items and words of a block at most (a text's own words may go beyond the latter), and the least number of folders.
PER_BLOCK, BLOCK_POSTINGS, BUCKETS = 4096, 4_000_000, 64
#: Blocks that are scored before a bound is known.
FIRST = 16
BUCKET = "pmod(xxhash64(term), {n})"
#: The folder of the blocks' ids.
ITEMS = -1
KINDS = {"term": pa.string(), "block": pa.int64(), "n": pa.int32(), "occurrences": pa.int64(), "greatest": pa.int32(), "gaps": pa.binary(), "tfs": pa.binary()}
SCHEMA = "term string, block long, n int, occurrences long, greatest int, gaps binary, tfs binary"


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def _packed(values: np.ndarray, starts: np.ndarray, n: np.ndarray, width: int) -> pa.Array:
    """Of each run of values its bytes, width of them a value; the number of values tells the width again."""
    sizes = np.repeat(n, n)
    own = values[np.repeat(starts, n) + np.arange(len(sizes)) - np.repeat(np.cumsum(n) - n, n)].astype(f"<u{width}")
    offsets = np.concatenate([[0], np.cumsum(n * width)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(own.tobytes())])


def _width(most: np.ndarray) -> np.ndarray:
    """The least number of bytes that holds each number."""
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _posted(ids: list[pa.Array], words: list[pa.Array], name: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block: its ids, and of each term its postings. words: of each item its terms, empty ones among them."""
    own = pa.concat_arrays(ids)
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([[None], [name], [len(own)], [0], [0], [own.to_numpy().astype("<i8").tobytes()], [b""]], KINDS.values(), strict=True)], list(KINDS))
    flat = pa.concat_arrays([w.flatten() for w in words])
    place = np.repeat(np.arange(len(own)), np.concatenate([pc.list_value_length(w).to_numpy() for w in words]))
    said = np.asarray(pc.not_equal(flat, ""))
    coded = flat.filter(pa.array(said)).dictionary_encode()
    if not len(coded):
        return
    key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(own) + place[said], return_counts=True)
    code, place = key // len(own), key % len(own)
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    n, gaps = np.diff(np.append(starts, len(key))), np.diff(place, prepend=0)
    gaps[starts] = place[starts]
    greatest, occurrences = np.maximum.reduceat(tf, starts), np.add.reduceat(tf, starts)
    kind = _width(np.maximum.reduceat(gaps, starts)) * 8 + _width(greatest)
    for k in np.unique(kind):
        for some in np.array_split(np.flatnonzero(kind == k), max(1, np.count_nonzero(kind == k) // 50_000)):
            packed = [_packed(x, starts[some], n[some], int(w)) for x, w in ((gaps, k // 8), (tf, k % 8))]
            cols = [coded.dictionary.take(pa.array(code[starts[some]])), *[pa.array(x, t) for x, t in ((np.full(len(some), name), pa.int64()), (n[some], pa.int32()), (occurrences[some], pa.int64()), (greatest[some], pa.int32()))], *packed]
            yield pa.RecordBatch.from_arrays(cols, list(KINDS))


def write_index(items: DataFrame, path: str, id_col: str, text_col: str, per_block: int = PER_BLOCK, n_buckets: int | None = None, append: bool = False) -> None:
    """Write an index below path, or add to the one that is there."""
    spark, run = items.sparkSession, 0
    if append:
        old = spark.read.parquet(f"{path}/settings").agg(F.max("run").alias("run"), F.max("n_buckets").alias("n_buckets")).first()
        run, n_buckets = old["run"] + 1, old["n_buckets"]
    n_buckets = n_buckets or max(BUCKETS, items.count() // 1_000_000)
    spark.createDataFrame([(run, n_buckets)], "run int, n_buckets int").coalesce(1).write.mode("append").parquet(f"{path}/settings")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, words, n, n_words = run << 48 | TaskContext.get().partitionId() << 24, [], [], 0, 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                some = pc.split_pattern(pc.fill_null(b.column(1)[at : at + min(512, per_block - n)], ""), " ")
                upto = n_words + np.cumsum(pc.list_value_length(some).to_numpy())
                fit = min(len(some), int(np.searchsorted(upto, BLOCK_POSTINGS)) + 1)
                ids.append(b.column(0)[at : at + fit])
                words.append(some[:fit])
                at, n, n_words = at + fit, n + fit, int(upto[fit - 1])
                if n >= per_block or n_words >= BLOCK_POSTINGS:
                    yield from _posted(ids, words, name)
                    name, ids, words, n, n_words = name + 1, [], [], 0, 0
        if n:
            yield from _posted(ids, words, name)

    texts = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), T.normalized(F.col(text_col)).alias("text"))
    rows = texts.mapInArrow(post, SCHEMA)
    bucket = F.when(F.col("term").isNull(), F.lit(ITEMS)).otherwise(F.expr(BUCKET.format(n=n_buckets)).cast("int"))
    spread = F.when(F.col("term").isNull(), F.col("block"))  # ids are dealt by block
    filed = rows.withColumns({"bucket": bucket, "spread": spread}).repartition("bucket", "spread").drop("spread")
    filed.sortWithinPartitions("bucket", "term", "block").write.mode("append").partitionBy("bucket").parquet(f"{path}/rows")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SCHEMA}, bucket int").parquet(f"{path}/rows")


def postings(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """The index's rows of some terms; only their folders are opened."""
    n_buckets = spark.read.parquet(f"{path}/settings").first()["n_buckets"]
    of = spark.createDataFrame([(t,) for t in terms], "term string").select(F.expr(BUCKET.format(n=n_buckets))).distinct()
    return _rows(spark, path).filter(F.col("bucket").isin([r[0] for r in of.collect()]) & F.col("term").isin(terms))


def term_statistics(spark: SparkSession, path: str) -> DataFrame:
    """term, n_items, n_occurrences: from the rows' sums, without postings."""
    rows = _rows(spark, path).filter(F.col("bucket") != ITEMS)
    return rows.groupBy("term").agg(F.sum("n").alias("n_items"), F.sum("occurrences").alias("n_occurrences"))


def term_counts(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """What term_statistics() reads from an index of items, counted from the texts, so that no postings are made for numbers alone.

    An item gives each of its words once for the occurrences and each different one once more for the items; both are summed by
    term before anything is shuffled.
    """
    words = items.filter(F.col(id_col).isNotNull()).select(F.split(T.normalized(F.col(text_col)), " ").alias("words"))
    both = words.select(F.posexplode(F.array("words", F.array_distinct("words"))).alias("item", "words"))  # 0: all words; 1: the different ones
    each = both.select("item", F.explode("words").alias("term")).filter("term <> ''")
    return each.groupBy("term").agg(F.sum("item").alias("n_items"), F.sum(1 - F.col("item")).alias("n_occurrences"))


def scored(rows: DataFrame, ids: DataFrame, n_terms: int, k: int) -> DataFrame:
    """id, score: of each block the k best items that hold all terms. rows: of postings(); ids: the blocks' own rows."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for held, raw in zip(b.column("held").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if len(held) < n_terms:
                    continue
                sides = [(np.cumsum(_unpacked(x["gaps"], x["n"])), _unpacked(x["tfs"], x["n"])) for x in sorted(held, key=lambda x: x["n"])]
                both = sides[0][0]
                for places, _ in sides[1:]:
                    both = np.intersect1d(both, places, assume_unique=True)
                score = sum((tf[np.searchsorted(places, both)] for places, tf in sides), np.zeros(len(both), np.int64))
                own = np.frombuffer(raw, "<i8")[both]
                best = np.lexsort((own, -score))[:k]
                yield pa.RecordBatch.from_arrays([pa.array(own[best]), pa.array(score[best])], ["id", "score"])

    held = rows.groupBy("block").agg(F.collect_list(F.struct("n", "gaps", "tfs")).alias("held"))
    return held.join(ids.select("block", F.col("gaps").alias("ids")), "block").select("held", "ids").mapInArrow(meet, "id long, score long")


def search(spark: SparkSession, path: str, terms: list[str], k: int, id_col: str = "id") -> DataFrame:
    """The k items that hold all terms, by summed term frequency, then id."""
    want = sorted(set(terms))
    if not want:
        raise ValueError("a search has a term at least")
    rows, ids = postings(spark, path, want), _rows(spark, path).filter(F.col("bucket") == ITEMS)
    bound = rows.groupBy("block").agg(F.count(F.lit(1)).alias("held"), F.sum("greatest").alias("bound")).filter(F.col("held") == len(want))
    order = [F.desc("score"), "id"]
    first = [r["block"] for r in bound.orderBy(F.desc("bound"), "block").limit(FIRST).collect()]
    some = F.col("block").isin(first)
    found = scored(rows.filter(some), ids.filter(some), len(want), k).orderBy(*order).limit(k).collect()
    hits = spark.createDataFrame(found, "id long, score long")
    if len(first) == FIRST:  # there may be more
        least = found[-1]["score"] if len(found) == k else 0
        others = bound.filter((F.col("bound") >= least) & ~some).select("block")
        hits = hits.unionByName(scored(rows.join(others, "block"), ids, len(want), k))
    return hits.orderBy(*order).limit(k).withColumnRenamed("id", id_col)
