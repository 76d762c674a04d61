"""The store of sources, items, media, fields and notes: the only module that writes them.

Rows of all five tables are committed together or not at all, and never changed after. Media files stay where they are; the store
has their paths and sizes.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.shared import listed

SCHEMAS = {"source": schemas.SOURCE, "research_item": schemas.RESEARCH_ITEM, "media_asset": schemas.MEDIA_ASSET, "structured_field": schemas.STRUCTURED_FIELD, "note": schemas.NOTE}
PARENT = {"research_item": ("source_id", "source"), "media_asset": ("research_item_id", "research_item"), "structured_field": ("research_item_id", "research_item"), "note": ("research_item_id", "research_item")}
#: What each row must fulfil; a null result is a fault too.
CHECKS = {
    "source": {"type is given": "type <> ''", "handle is given": "handle <> ''"},
    "research_item": {"url is given": "original_url <> ''", "time is given": "ingested_at is not null", "raw text is given": "raw_text is not null"},
    "media_asset": {"kind is given": "kind <> ''", "path is given": "storage_path <> ''", "size is positive": "coalesce(size_bytes, 0) >= 0 and coalesce(duration, 0) >= 0"},
    "structured_field": {"name is given": "name <> ''", "origin is system or human": "origin in ('system', 'human')", "confidence is from 0 to 1": "coalesce(confidence, 1) between 0 and 1"},
    "note": {"author is human": "author = 'human'", "body is given": "body <> ''"},
}


class Refused(ValueError):
    """Rows that break a rule; nothing of their batch was stored."""


class Store:
    """Tables below a folder that all executors share.

    A batch's rows are first written to folders of its own, `<table>/part=<batch>`, and checked there; a batch counts from the moment its
    mark is in `_commits`, which is made by one rename. Readers look at marked folders only, so what a lost writer left is not seen.
    """

    def __init__(self, spark: SparkSession, root: str, lock_seconds: float = 3600):
        self.spark, self.root, self.lock_seconds = spark, root.rstrip("/"), lock_seconds

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        return listed(self.spark, f"{self.root}/_commits")

    def _read(self, name: str, parts: list[str]) -> DataFrame:
        known = set(parts) & {p[5:] for p in listed(self.spark, f"{self.root}/{name}") if p.startswith("part=")}
        if not known:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.root}/{name}").parquet(*[f"{self.root}/{name}/part={p}" for p in sorted(known)]).select(*self.columns(name))

    def columns(self, name: str) -> list[str]:
        return [c.split()[0] for c in SCHEMAS[name].replace("map<string,string>", "map").split(", ")]

    def read(self, name: str) -> DataFrame:
        """The committed rows of a table."""
        return self._read(name, self.batches())

    def commit(self, batch: str, tables: dict[str, DataFrame]) -> bool:
        """Store the rows of these tables together. False if a batch of that name is stored already, so that it can be given again.

        Refused with the rules and the numbers of rows that break them, before anything can be seen: a key that is null, repeated or
        stored already (so no raw text is ever changed), a parent that is neither stored nor in the batch, and CHECKS. Missing columns
        and extra ones are refused too; types are cast.
        """
        if not batch or "/" in batch or batch.startswith(("_", ".")):
            raise ValueError(f"no name for a batch: {batch!r}")
        for name, rows in tables.items():
            if sorted(rows.columns) != sorted(self.columns(name)):
                raise Refused(f"{name} has the columns {sorted(rows.columns)}, not {sorted(self.columns(name))}")
        lock = self._path("_lock")
        self._take(lock)
        try:
            if batch in self.batches():
                return False
            for name, rows in tables.items():
                typed = self.spark.createDataFrame([], SCHEMAS[name]).schema
                rows.select(*[F.col(f.name).cast(f.dataType) for f in typed]).write.mode("overwrite").parquet(f"{self.root}/{name}/part={batch}")
            if faults := self._faults(batch, list(tables)):
                raise Refused("; ".join(f"{t}: {rule}: {n} rows" for t, rule, n in faults))
            files, mark = self._files(), self._path("_marks", batch)
            files.create(mark, True).close()
            files.mkdirs(self._path("_commits"))
            if not files.rename(mark, self._path("_commits", batch)):
                raise OSError(f"the mark of batch {batch} can't be made")
            return True
        finally:
            self._files().delete(lock, False)

    def _take(self, lock) -> None:
        """One writer at a time. The lock of a writer that was lost is taken over when it is older than lock_seconds."""
        files = self._files()
        files.mkdirs(self._path())
        if files.exists(lock) and time.time() - files.getFileStatus(lock).getModificationTime() / 1000 > self.lock_seconds:
            files.delete(lock, False)
        if not files.createNewFile(lock):
            raise RuntimeError("another writer holds the store")

    def _faults(self, batch: str, names: list[str]) -> list[tuple[str, str, int]]:
        """table, rule, rows that break it: one row a rule, counted by Spark."""
        held, found = self.batches(), []
        for name in names:
            new, old = self._read(name, [batch]), self._read(name, held)
            rules = {"id is given": "id is not null", **CHECKS[name]}
            broken = new.agg(*[F.count_if(~F.coalesce(F.expr(r), F.lit(False))).alias(k) for k, r in rules.items()])
            found += [broken.select(F.lit(name).alias("t"), F.lit(k).alias("rule"), F.col(f"`{k}`").alias("n")) for k in rules]
            again = new.groupBy("id").agg((F.count(F.lit(1)) - 1).alias("n")).filter("id is not null and n > 0")
            found.append(again.agg(F.lit(name), F.lit("id is used once"), F.coalesce(F.sum("n"), F.lit(0))))
            found.append(new.join(old.select("id"), "id", "left_semi").agg(F.lit(name), F.lit("id is new"), F.count(F.lit(1))))
            if name in PARENT:
                key, parent = PARENT[name]
                there = self._read(parent, [*held, batch]).select(F.col("id").alias(key))
                children = new.groupBy(key).agg(F.count(F.lit(1)).alias("n"))  # a hot parent is one row before the join
                found.append(children.join(there, key, "left_anti").agg(F.lit(name), F.lit(f"{key} is in {parent}"), F.coalesce(F.sum("n"), F.lit(0))))
        return [tuple(r) for r in reduce(DataFrame.union, found).filter("n > 0").collect()] if found else []

    def vacuum(self) -> int:
        """Delete what batches left that were never committed; the number of folders. No batch may be on its way."""
        self._take(lock := self._path("_lock"))
        try:
            kept, files, gone = set(self.batches()), self._files(), 0
            for name in SCHEMAS:
                for part in listed(self.spark, f"{self.root}/{name}"):
                    if part.startswith("part=") and part[5:] not in kept:
                        gone += files.delete(self._path(name, part), True)
            return gone
        finally:
            self._files().delete(lock, False)


def item_view(items: DataFrame, sources: DataFrame, media: DataFrame, fields: DataFrame, notes: DataFrame) -> DataFrame:
    """An item with its source's type and handle, and its media, fields and notes as lists in order of id; an item without has empty ones.

    Children are gathered before they are joined, so that they don't multiply each other.
    """

    def gathered(child: DataFrame, name: str, *columns: str) -> DataFrame:
        one = F.struct("id", *columns)
        return child.groupBy(F.col("research_item_id").alias("id")).agg(F.sort_array(F.collect_list(one)).alias(name))

    out = items.join(sources.select(F.col("id").alias("source_id"), F.col("type").alias("source_type"), F.col("handle").alias("source_handle")), "source_id", "left")
    for child in (gathered(media, "media", "kind", "storage_path", "size_bytes"), gathered(fields, "fields", "name", "value", "origin", "confidence"), gathered(notes, "notes", "body", "created_at")):
        out = out.join(child, "id", "left").withColumn(child.columns[1], F.coalesce(child.columns[1], F.array().cast(child.schema[1].dataType)))
    return out
