"""Exact deduplication with keyed streaming state that is kept on disk and never expires.

Arrivals (row key, identifier, length, digest of the normalised text) pass through a Structured
Streaming aggregation whose RocksDB state holds, for each digest ever seen, how many rows carried it
and the row that stays: its length, stable identifier and content locator. The locator is the hash of a file's
path and the row's place in it; the table `files` beside the state has the paths. A state is one folder:

    state/arrivals/run=N   what came in run N; the stream reads this folder
    state/seen             the stream's checkpoint, with the state
    state/files            file hash, path, text column
    state/before/run=N     the state before run N
    state/collided         digests that more than one text has

It goes on from run to run: duplicate_groups(more, state_dir=...) judges new rows against all earlier ones.

On every hit the full bytes are compared: the rows of each digest that was hit are read again by their locators, and
so is the row that stayed after the runs before. If least and greatest normalised text of a digest aren't the same
bytes, it has collided: its rows, those of earlier runs too, are read by their locators and grouped by full texts. Files
of earlier runs must therefore stay readable; rows of other than plain file scans are written to the shared folder.

Of equal texts (after deleting the characters of [\\x20\\x09-\\x0D]) the row with most code points
stays, then the least identifier (null last), then the least locator. Null text counts as empty;
empty texts are equal to one another. Repeated rows are copies of each other. A run's result has its own rows, with
the row that stays and the group's size over all runs so far; results of earlier runs aren't changed by a better copy
that comes later. An empty table gives an empty result. Columns other than text and identifier aren't read.

A hot group is summed before it is shuffled, here and in the check of bytes, so that each task
sends one row per digest. Only digests that were hit are joined; they are broadcast while they are few, and beyond that
the rows of a hot one can be split, as nothing is gathered after the join.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import ROW_FILE, ROW_INDEX, ROW_KEY, documents, join_small, listed, row_columns, saved, scoped, scratch, shared_path, with_row_key

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",  # an executor may hold a hundred of them
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",  # stores of a query that has ended are closed then
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # there are many small stores: no space set aside in each
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.metricsEnabled": "false",
}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def without_space(text: Column) -> Column:
    """text without the characters of [\\x20\\x09-\\x0D]; null is empty. Byte searches, no regular expression."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in " \t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _best() -> Column:
    return F.struct("n_chars", F.expr("-id").alias("neg_id"), F.expr(f"-{ROW_FILE}").alias("neg_file"), F.expr(f"-{ROW_INDEX}").alias("neg_row"))


def seen_state(arrivals_path: str, arrivals: DataFrame, state_dir: str) -> DataFrame:
    """Feed all new files below arrivals_path to the state in state_dir, then read the state: digest, n, best."""
    spark = arrivals.sparkSession
    with settings(spark, STATE_CONF):
        feed = spark.readStream.schema(arrivals.schema).parquet(arrivals_path)
        state = feed.groupBy("digest").agg(F.max(_best()).alias("best"), F.count(F.lit(1)).alias("n"))
        query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", state_dir).trigger(availableNow=True).start()
        query.awaitTermination()
    return _read_state(spark, state_dir)


def _read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    read = spark.read.format("statestore").load(state_dir)
    value = [f.name for f in read.schema["value"].dataType.fields]
    return read.select(F.col("key.digest").alias("digest"), F.col(f"value.{value[0]}").alias("best"), F.col(f"value.{value[1]}").alias("n"))


def _once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at a path; made only if it isn't there whole, so that a run that was stopped can be run again."""
    if "_SUCCESS" not in listed(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _added(df: DataFrame, path: str) -> DataFrame:
    """df appended to a table; the whole table, each row once."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).distinct()


def _earlier_texts(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (row key, digest and more) and the text of each row, read from its file by locator."""
    spark = files.sparkSession
    found, out = files.join(wanted.select(ROW_FILE).distinct(), ROW_FILE, "left_semi").collect(), None  # one row a file
    for column in sorted({r["text_col"] for r in found}):
        rows = spark.read.parquet(*[unquote(r["path"]) for r in found if r["text_col"] == column])
        rows = rows.select(F.xxhash64(F.col("_metadata.file_path")).alias(ROW_FILE), F.col("_metadata.row_index").alias(ROW_INDEX), F.col(f"`{column}`").cast("string").alias("text"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return wanted.withColumn("text", F.lit(None).cast("string"))
    return join_small(out, wanted, ROW_KEY, "inner", wanted.count(), 150)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, state_dir: str | None = None, run: str | None = None) -> DataFrame:
    """One row per row of docs: row key, id, keep_id, group_size, kept, digest.

    digest is what the state is keyed by; any function of the normalised text gives the same groups, but all runs on
    one state must use the same. run names what comes in, in the state's folder (by default by number); a run that was
    stopped is done again under its name.
    """
    spark = docs.sparkSession
    top = state_dir or scoped(shared_path(spark, "seen"))
    keyed = with_row_key(docs)
    rows = keyed.select(*ROW_KEY, F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    norm = without_space(F.col("text"))
    facts = rows.select(*ROW_KEY, "id", F.coalesce(F.char_length("text"), F.lit(0)).cast("int").alias("n_chars"), digest(norm).alias("digest"))
    runs = [x for x in listed(spark, f"{top}/arrivals") if x.startswith("run=")]
    run = f"run={len(runs) if run is None else run}"
    past = [f"{top}/arrivals/{x}" for x in runs if x != run]
    before = _once(spark, f"{top}/before/{run}", lambda: _read_state(spark, f"{top}/seen")) if past else None
    arrivals = _once(spark, f"{top}/arrivals/{run}", lambda: facts)
    state = seen_state(f"{top}/arrivals", arrivals, f"{top}/seen")
    files = None
    if state_dir:  # else no run follows that would open them
        files = _added(keyed.select(F.col(ROW_FILE), F.col("_metadata.file_path").alias("path"), F.lit(text_col).alias("text_col")).distinct(), f"{top}/files")
        state = state.join(arrivals.select("digest").distinct(), "digest", "left_semi")
    hit = saved(state.filter("n > 1"), "hit")
    n_hit = hit.count()

    # the check of full bytes, over the rows of digests that were hit
    members = saved(join_small(arrivals, hit.select("digest"), "digest", "left_semi", n_hit, 80).select(*ROW_KEY, "digest"), "members")
    texts = join_small(rows, members, ROW_KEY, "inner", members.count(), 100).select(*ROW_KEY, "id", "text", "digest", norm.alias("norm"))
    said = texts.select("digest", "norm")
    if before is not None:
        stayed = before.join(hit.select("digest"), "digest", "left_semi").select((-F.col("best.neg_file")).alias(ROW_FILE), (-F.col("best.neg_row")).alias(ROW_INDEX), "digest")
        said = said.unionByName(_earlier_texts(files, saved(stayed, "stayed")).select("digest", norm.alias("norm")))
    collided = said.groupBy("digest").agg(F.min("norm").alias("least"), F.max("norm").alias("most")).filter("least <> most").select("digest")
    collided = saved(collided, "collided")
    if state_dir:
        collided = saved(_added(collided, f"{top}/collided"), "collided")

    keep = [(-F.col("best.neg_id")).alias("keep_id"), (-F.col("best.neg_file")).alias("keep_file"), (-F.col("best.neg_row")).alias("keep_row"), F.col("n").alias("group_size")]
    names = ["keep_id", "keep_file", "keep_row", "group_size"]
    alone = dict(zip(names, [F.col("id"), F.col(ROW_FILE), F.col(ROW_INDEX), F.lit(1).cast("long")], strict=True))
    out = join_small(arrivals, hit.select("digest", F.struct(*keep).alias("k")), "digest", "left", n_hit, 160)
    out = out.withColumns({c: F.when(F.col("k").isNotNull(), F.col(f"k.{c}")).otherwise(alone[c]) for c in names}).drop("k")
    n_collided = collided.count()
    if n_collided:
        ours = join_small(texts, collided, "digest", "left_semi", n_collided, 80).select(*ROW_KEY, "id", "text", "digest", F.lit(True).alias("now"))
        if past:
            earlier = spark.read.schema(facts.schema).parquet(*past)
            wanted = saved(join_small(earlier, collided, "digest", "left_semi", n_collided, 80).select(*ROW_KEY, "id", "digest"), "wanted")
            ours = ours.unionByName(_earlier_texts(files, wanted).select(*ROW_KEY, "id", "text", "digest", F.lit(False).alias("now")))
        ours = saved(ours.withColumns({"n_chars": F.coalesce(F.char_length("text"), F.lit(0)).cast("int"), "norm": norm}).drop("text"), "ours")
        groups = ours.groupBy("digest", "norm").agg(F.max(_best()).alias("best"), F.count(F.lit(1)).alias("n")).select("digest", "norm", F.struct(*keep).alias("k"))
        exact = saved(ours.filter("now").select(*ROW_KEY, "digest", "norm").join(saved(groups, "groups"), ["digest", "norm"]).select(*ROW_KEY, "k"), "exact")
        out = join_small(out, exact, ROW_KEY, "left", exact.count(), 160)
        out = out.withColumns({c: F.when(F.col("k").isNotNull(), F.col(f"k.{c}")).otherwise(F.col(c)) for c in names})
    kept = (F.col("keep_file") == F.col(ROW_FILE)) & (F.col("keep_row") == F.col(ROW_INDEX))
    return out.select(*ROW_KEY, "id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that have a better copy; its columns as they are."""
    keyed = with_row_key(docs)
    with scratch(docs.sparkSession):
        gone = saved(duplicate_groups(keyed, id_col, text_col).filter("not kept").select(*ROW_KEY), "gone", keep=True)
    return join_small(keyed, gone, ROW_KEY, "left_anti", gone.count(), 80).select(*row_columns(keyed, docs))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = duplicate_groups(documents(spark, sf_dir))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(length(text), 0) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
"""
