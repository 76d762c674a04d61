"""Helpers shared by the operators: shared-folder tables, row keys, size-checked joins."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its rows, as counted, need no more bytes than this.
BROADCAST_BYTES = 16 << 20

ROW_FILE, ROW_INDEX = "_mr_file", "_mr_row"
ROW_KEY = [ROW_FILE, ROW_INDEX]


#: What one Python worker may remember of tokens and pieces, in bytes, whatever the operator.
WORKER_BYTES = 64 << 20
#: An Arrow batch of whole texts is closed at this many bytes.
BATCH_BYTES = 4 << 20
#: Seconds without a batch after which a worker forgets what it keeps.
IDLE_S = 8
#: With this setting the shuffle files of a query go when it ends, not when the driver's collector comes to them.
EARLY_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_owned: dict[str, object] = {}
_used = [0.0]


def owned(name: str, make: Callable[[], object]):
    """The one thing that this Python worker keeps between tasks; it goes when another operator or model comes, or after IDLE_S.

    Ask for it again with each batch: that is what counts as use.
    """
    _used[0] = time.monotonic()
    if name not in _owned:
        _forget()
        _owned[name] = make()
        if not any(t.name == "millrace-idle" for t in threading.enumerate()):
            threading.Thread(target=_watch, name="millrace-idle", daemon=True).start()
    return _owned[name]


def _forget() -> None:
    _owned.clear()
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)  # else freed memory stays with the process
    except OSError:
        pass


def _watch() -> None:
    while _owned:
        time.sleep(1)
        if time.monotonic() - _used[0] > IDLE_S:
            _forget()


class Budget:
    """Bytes that the memories of one operator may still take."""

    def __init__(self, left: int = WORKER_BYTES):
        self.left = left


class Memory(dict):
    """make(key) -> (value, whether to keep it), remembered while the budget lasts; a full memory costs time, not results."""

    def __init__(self, make: Callable, budget: Budget, longest: int = 64):
        super().__init__()
        self.make, self.budget, self.longest = make, budget, longest

    def __missing__(self, key):
        value, keep = self.make(key)
        if keep and self.budget.left > 0 and len(key) <= self.longest:
            self[key] = value
            self.budget.left -= sys.getsizeof(key) + sys.getsizeof(value) + 120  # its part of the table
        return value


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are closed by bytes, not by rows alone: some texts are very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (spark.checkpoint.dir); one of our own only where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/millrace/{tag}-{uuid.uuid4().hex}"


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that saved() makes inside are deleted at the end; those made with keep=True at the end of the scope around it, if any."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def scoped(path: str, keep: bool = False) -> str:
    """A path that goes with the scope it was made in."""
    if len(_scopes) > keep:
        _scopes[-1 - keep].append(path)
    return path


def saved(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage, and a lost executor takes nothing with it.

    The shuffle files of the write go as soon as it ends; nothing reads them any more.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = scoped(shared_path(spark, tag), keep)
    before = spark.conf.get(EARLY_CLEANUP, None)
    spark.conf.set(EARLY_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(EARLY_CLEANUP) if before is None else spark.conf.set(EARLY_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table made by saved() that nothing reads any more."""
    path = getattr(df, "_millrace_path", None)
    if path:
        remove(df.sparkSession, path)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in store.listStatus(p)) if store.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def with_row_key(docs: DataFrame) -> DataFrame:
    """docs with two long columns that name each row: hash of its file and its place in the file.

    Only a plain file scan has these; any other DataFrame is written to the shared folder first,
    so that a row has the same key each time it is read, repeated rows have different keys, and
    no column of the caller's is trusted to be unique. Columns of the caller's that have these names are renamed.
    """
    if getattr(docs, "_millrace_keyed", False):
        return docs
    taken = {c: fresh_name(docs, c) for c in docs.columns if c.lower() in ROW_KEY}
    if not is_plain_scan(docs):
        docs = saved(docs, "rows", keep=True)
    out = docs.withColumnsRenamed(taken).withColumns({ROW_FILE: F.xxhash64(F.col("_metadata.file_path")), ROW_INDEX: F.col("_metadata.row_index")})
    out._millrace_keyed, out._millrace_renamed = True, taken
    return out


def row_columns(keyed: DataFrame, docs: DataFrame) -> list[Column]:
    """Of a frame made by with_row_key(docs): the columns of docs, under their names."""
    renamed = getattr(keyed, "_millrace_renamed", {})
    return [F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns]


def is_plain_scan(df: DataFrame) -> bool:
    """Whether df is one Parquet scan with at most projections and filters above it, and no column that hides its metadata."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    is_scan = node.children().isEmpty() and "parquet" in node.toString().lower() and "_metadata" in node.metadataOutput().mkString(",")
    return is_scan and "_metadata" not in df.columns


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have."""
    name = f"_mr_{base}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def join_small(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str, right_rows: int, row_bytes: int) -> DataFrame:
    """left joined to right; right is broadcast only if right_rows * row_bytes is small, else the keys are shuffled."""
    if right_rows * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("shuffle_hash") if how != "full" else right, on, how)


def ascii_lower(c):
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
