"""New posts of tracked sources, in a batch or a stream, whatever kind of source they come from.

A kind of source is one class with the two methods of Adapter; ADAPTERS names it. Nothing else knows kinds. Spark gives each range
of positions to a task of its own, and a stream's checkpoint holds how far each source has been read.
"""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import import_module
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.functions import text as T
from millrace.sources.store import Store

POST = "source_id bigint, position bigint, post string"
KNOWN = "url string, text string"
#: Most bytes that the list of tracked sources may have; a longer one goes into several feeds.
SOURCE_BYTES = 8 << 20
#: Positions of one source are below this, so that source and position make one id.
POSITIONS = 1 << 40


class Adapter(Protocol):
    """A source whose posts have positions that grow; a post keeps its position for ever."""

    def latest(self) -> int:
        """A position after all whole posts that there are now, and none that is still being written."""

    def fetch_new(self, start: int, end: int) -> Iterator[tuple[int, str]]:
        """Position and JSON document of each post at start or later, and before end."""


class JsonLines:
    """A growing file of JSON lines. A post's position is the byte its line starts at, so that a range is read without what lies before."""

    def __init__(self, handle: str):
        self.path = handle

    def latest(self) -> int:
        with open(self.path, "rb") as f:
            end = f.seek(0, os.SEEK_END)
            while end:  # back to the last line end; a line without one may still be being written
                start = max(0, end - (1 << 16))
                f.seek(start)
                if (at := f.read(end - start).rfind(b"\n")) >= 0:
                    return start + at + 1
                end = start
        return 0

    def fetch_new(self, start: int, end: int) -> Iterator[tuple[int, str]]:
        with open(self.path, "rb") as f:
            if start:
                f.seek(start - 1)
                f.readline()  # the line that began before
            while (at := f.tell()) < end and (line := f.readline()):
                if line.strip():
                    yield at, line.decode("utf-8", "replace")


class Sqlite:
    """A table of an SQLite file, named `path#table`; a row's position is its rowid, its columns are the post's fields."""

    def __init__(self, handle: str):
        self.path, self.table = handle.rsplit("#", 1)
        if not self.table.isidentifier():
            raise ValueError(f"no table name: {self.table}")

    def _rows(self, sql: str, *given):
        held = sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)
        try:
            found = held.execute(sql.format(t=self.table), given)
            names = [c[0] for c in found.description]
            for row in found:
                yield dict(zip(names, row))
        finally:
            held.close()

    def latest(self) -> int:
        return next(self._rows('SELECT coalesce(max(rowid), -1) + 1 AS n FROM "{t}"'))["n"]

    def fetch_new(self, start: int, end: int) -> Iterator[tuple[int, str]]:
        for row in self._rows('SELECT rowid AS _position, * FROM "{t}" WHERE rowid >= ? AND rowid < ? ORDER BY rowid', start, end):
            yield row.pop("_position"), json.dumps(row, default=lambda b: b.hex())


#: Kinds of sources; `module:Class` in a source's type names one that isn't listed here.
ADAPTERS: dict[str, type] = {"jsonl": JsonLines, "sqlite": Sqlite}


def adapter(kind: str, handle: str) -> Adapter:
    if kind in ADAPTERS:
        return ADAPTERS[kind](handle)
    if ":" not in kind:
        raise ValueError(f"no adapter for sources of type {kind}")
    module, name = kind.split(":")
    return getattr(import_module(module), name)(handle)


@dataclass
class Range(InputPartition):
    source_id: int
    kind: str
    handle: str
    start: int
    end: int


class _Feed:
    def __init__(self, options):
        self.sources, self.span = json.loads(options["sources"]), int(options.get("span", 1 << 24))

    def ends(self) -> dict[str, int]:
        return {str(s["id"]): adapter(s["type"], s["handle"]).latest() for s in self.sources}

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        """Every source's new positions in ranges of the span, so that a source of a third of all posts has many tasks."""
        bounds = [(s, start.get(str(s["id"]), 0), end.get(str(s["id"]), 0)) for s in self.sources]
        return [Range(s["id"], s["type"], s["handle"], at, min(at + self.span, z)) for s, a, z in bounds for at in range(a, z, self.span)]

    def read(self, part: Range):
        for position, post in adapter(part.kind, part.handle).fetch_new(part.start, part.end):
            yield part.source_id, position, post


class _Batch(_Feed, DataSourceReader):
    def partitions(self):
        return self.ranges({}, self.ends()) or [Range(0, "jsonl", os.devnull, 0, 0)]


class _Stream(_Feed, DataSourceStreamReader):
    def initialOffset(self):
        return {}

    def latestOffset(self):
        return self.ends()

    def partitions(self, start, end):
        return self.ranges(start, end)

    def commit(self, end):
        pass  # sources keep their posts; the checkpoint holds the positions


class Posts(DataSource):
    """spark.read or readStream.format("posts"): source_id, position, post."""

    @classmethod
    def name(cls):
        return "posts"

    def schema(self):
        return POST

    def reader(self, schema):
        return _Batch(self.options)

    def streamReader(self, schema):
        return _Stream(self.options)


def posts(sources: DataFrame, stream: bool = False, span: int = 1 << 24) -> DataFrame:
    """source_id, position, post (JSON) of all tracked sources (id, type, handle), as a batch or a stream.

    The list of sources goes to the feed whole, so its size is checked before; posts never pass the driver. A stream reads each source
    from where its checkpoint stands; a source that is tracked later is read from its start. An empty list has no posts.
    """
    spark = sources.sparkSession
    listed = sources.select("id", "type", "handle").dropDuplicates(["id"])
    size = listed.agg(F.coalesce(F.sum(F.octet_length("type") + F.octet_length("handle") + 40), F.lit(0))).first()[0]
    if size > SOURCE_BYTES:
        raise ValueError(f"the list of sources has {size} bytes; make feeds of at most {SOURCE_BYTES}")
    spark.dataSource.register(Posts)
    reader = spark.readStream if stream else spark.read
    return reader.format("posts").option("sources", json.dumps([r.asDict() for r in listed.orderBy("id").collect()])).option("span", span).load()


def items(found: DataFrame) -> DataFrame:
    """Rows of the store's research_item from posts. id is made of source and position, so that it is the same whenever a post is read.

    A post that is no JSON object keeps its whole line as raw_text; fields other than url and text are extras. A null text is ''.
    """
    said = F.from_json("post", KNOWN)
    fields = F.from_json("post", "map<string,string>")
    whole = F.get_json_object("post", "$").startswith("{")
    raw = F.when(F.coalesce(whole, F.lit(False)), F.coalesce(said["text"], F.lit(""))).otherwise(F.regexp_replace("post", r"[\r\n]+$", ""))
    fits = F.col("source_id").between(0, (1 << 22) - 1) & F.col("position").between(0, POSITIONS - 1)
    return found.select(
        F.when(fits, F.col("source_id") * POSITIONS + F.col("position")).otherwise(F.raise_error(F.lit("source_id or position out of range")).cast("long")).alias("id"),
        "source_id",
        F.coalesce(said["url"], F.concat_ws("#", F.col("source_id"), F.col("position"))).alias("original_url"),
        F.current_timestamp().alias("ingested_at"),
        raw.alias("raw_text"),
        T.collapsed(T.stripped(raw)).alias("cleaned_text"),
        F.sha2(F.concat(T.normalized(raw), F.col("source_id").cast("string")), 256).alias("content_hash"),
        F.lit(None).cast("long").alias("simhash"),
        F.map_filter(F.coalesce(fields, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("url", "text")).alias("extras"),
    )


def collect(store: Store, checkpoint: str, span: int = 1 << 24) -> None:
    """All new posts of the sources in the store, to the store, once each: passive collection without a person.

    A batch that failed is read again from its positions and has the same name, which the store commits once.
    """
    feed = posts(store.read("source"), stream=True, span=span)

    def take(batch: DataFrame, number: int) -> None:
        own = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        store.commit(f"{own}-{number}", {"research_item": items(batch)})

    feed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
