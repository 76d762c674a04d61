"""Benchmark decontamination: containment search for short test items inside long documents.

An item of n distinct shingles is contained in a document that has at least ceil(0.8 n) of them, so
at most n - ceil(0.8 n) are missing, and among any n - ceil(0.8 n) + 1 of the item's shingles one is
in the document. The item's sketch is therefore its least n - ceil(0.8 n) + 1 hashes (its bottom
minimum hashes under one random order): a document that holds none of them can't contain the item.
Items are partitioned by size (powers of two). Each partition has a cut, the largest sketch hash in
it, and the fewest shingles that a document must have to contain any of its items; a document shingle
that no partition can use is dropped before it meets any item. Candidates lose nothing; each is then
verified by counting the item's shingles in the whole document, as texts.

Banding by Jaccard similarity per size partition is not used: 30 shingles in a document of 10,000
have a Jaccard similarity of 0.003, which no usable number of bands finds each time.

Only DataFrame functions are used: words by split, shingles by zipping the words with themselves
moved by one to four places and inlining the rows.

Words are maximal runs of letters and digits, lower-cased. Items or documents of one to four words
have one shingle, the whole sequence; null or wordless ones have none and match nothing. Repeated
item ids are each kept apart by item key, whatever their texts. Repeated documents each get rows. A
null id stays null. Other columns aren't read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import ROW_KEY, documents, join_small, row_columns, saved, scratch, with_row_key

N_WORDS = 5
NUM, DEN = 4, 5  # contained: DEN * found >= NUM * size


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null and wordless texts give no words."""
    clean = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    return F.split(F.trim(clean), " ")


def shingle_rows(rows: DataFrame, keys: list[str], text: str = "text", n: int = N_WORDS) -> DataFrame:
    """keys and w1..wn for each place of each text (not distinct); a shorter text has one row, padded by nulls."""
    cut = rows.filter(F.col(text).isNotNull()).select(*keys, words(F.col(text)).alias("_w")).filter("_w[0] <> ''")
    size = F.size("_w")
    moved = [F.slice("_w", k + 1, F.greatest(size - k, F.lit(0))).alias(f"w{k + 1}") if k else F.col("_w").alias("w1") for k in range(n)]
    out = cut.select(*keys, size.alias("_n"), F.inline(F.arrays_zip(*moved)).alias(*[f"w{k + 1}" for k in range(n)]))
    return out


def whole(n: int = N_WORDS) -> Column:
    """Of shingle_rows: n words, or the first row of a shorter text."""
    return F.col(f"w{n}").isNotNull() | ((F.col("_n") < n) & _last_is_null(n))


def _last_is_null(n: int) -> Column:
    # the row at the first place of a text of _n < n words has exactly _n words
    have = sum((F.col(f"w{k + 1}").isNotNull().cast("int") for k in range(n)), F.lit(0))
    return have == F.col("_n")


def shingle_text(n: int = N_WORDS) -> Column:
    return F.concat_ws(" ", *[F.col(f"w{k + 1}") for k in range(n)])


def shingle_hash(n: int = N_WORDS) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(f"w{k + 1}"), F.lit("")) for k in range(n)])


def sketches(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """item_key, shingle, size for every shingle; and hash, item_key for those of the sketch, with the cut of its size partition."""
    all_ = shingle_rows(items, ["item_key"]).filter(whole()).select("item_key", shingle_text().alias("shingle"), shingle_hash().alias("h")).distinct()
    by_item = W.partitionBy("item_key")
    sized = saved(all_.withColumn("size", F.count(F.lit(1)).over(by_item)), "items")
    needed = F.ceil(F.col("size") * NUM / F.lit(DEN))
    sketch = (
        sized.withColumn("k", F.row_number().over(by_item.orderBy("h", "shingle")))
        .filter(F.col("k") <= F.col("size") - needed + 1)
        .select("h", "item_key", needed.alias("needed"), F.floor(F.log2("size")).cast("int").alias("part"))
    )
    return sized, saved(sketch, "sketch")


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row and item it contains: row key, id, item_id, found, size."""
    item_rows = with_row_key(items).select(F.struct(*ROW_KEY).alias("item_key"), F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    sized, sketch = sketches(item_rows)
    n_sketch, n_sized = sketch.count(), sized.count()

    rows = with_row_key(docs).select(*ROW_KEY, F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = sketch.groupBy("part").agg(F.max("h").alias("cut"), F.min("needed").alias("needed")).collect()  # one per power of two
    places = F.greatest(F.col("_n") - N_WORDS + 1, F.lit(1))
    grams = shingle_rows(rows, ROW_KEY).filter(whole()).select(*ROW_KEY, places.alias("places"), shingle_hash().alias("h"))
    usable = reduce(or_, [(F.col("h") <= p["cut"]) & (F.col("places") >= p["needed"]) for p in parts], F.lit(False))
    grams = grams.filter(usable).select(*ROW_KEY, "h")
    met = join_small(grams, sketch.select("h", "item_key"), "h", "inner", n_sketch, 64)
    candidates = saved(met.select(*ROW_KEY, "item_key").distinct(), "candidates")
    docs_met = saved(candidates.select(*ROW_KEY).distinct(), "candidate-docs")

    n_docs = docs_met.count()
    texts = join_small(rows, docs_met, ROW_KEY, "left_semi", n_docs, 64)
    have = shingle_rows(texts, [*ROW_KEY, "id"]).filter(whole()).select(*ROW_KEY, "id", shingle_text().alias("shingle"))
    counted = join_small(have, sized, "shingle", "inner", n_sized, 160).distinct()
    found = counted.groupBy(*ROW_KEY, "id", "item_key", "size").agg(F.count(F.lit(1)).alias("found")).filter(F.col("found") * DEN >= F.col("size") * NUM)
    out = join_small(found, item_rows.select("item_key", "item_id"), "item_key", "inner", n_sized, 64)
    return out.select(*ROW_KEY, "id", "item_id", "found", "size")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that contain an item; its columns as they are."""
    keyed = with_row_key(docs)
    with scratch(docs.sparkSession):
        bad = saved(contained_items(keyed, items, id_col, text_col).select(*ROW_KEY).distinct(), "contaminated", keep=True)
    return join_small(keyed, bad, ROW_KEY, "left_anti", bad.count(), 64).select(*row_columns(keyed, docs))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.col("found").alias("n_found"), F.col("size").alias("n_shingles"))


def oracle(n: int = N_WORDS) -> str:
    def grams(table: str, key: str) -> str:
        return rf"""
SELECT DISTINCT {key}, unnest(CASE WHEN len(w) < {n} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i+{n - 1}], ' ')) END) AS s
FROM (SELECT {key}, string_split(trim(lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), ' ') AS w FROM {table} WHERE text IS NOT NULL) WHERE w[1] <> ''"""

    return f"""
WITH d AS ({grams("documents", "doc_id")}), i AS ({grams("benchmark", "item_id")}), z AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_found, n_shingles FROM d JOIN i USING (s) JOIN z USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING {DEN} * count(*) >= {NUM} * n_shingles"""


ORACLE = oracle()
