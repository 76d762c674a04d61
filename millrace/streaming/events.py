"""Event decisions, in a batch or a stream, and unattended ingestion."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from millrace import schemas
from millrace.shared import listed

#: The tools that count, and the field of each one's input that must name what is wanted.
FIELD = {"Skill": "skill", "Read": "file_path"}
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def first_decisions(events: DataFrame, wanted: str) -> DataFrame:
    """key, triggered: the verdict of the first event of each key, in order of seq, that decides; False if none does.

    events: key, seq, e (see sources.events_of_lines). What decides: the start of another tool (False); an input
    delta after the start of a tool that counts, once the deltas since then hold `wanted` (True); the stop of a block
    after such a start, or of a message (False); a full message with a tool use, by its first (whether its field holds
    `wanted`); a result (False). A call's events are few, so a key is one window; what is shuffled of an event is its verdict or
    what it says, not the event.
    """
    kind, se = F.col("e.type"), F.when(F.col("e.type") == "stream_event", F.col("e.event.type"))
    tool = F.coalesce((se == "content_block_start") & (F.col("e.event.content_block.type") == "tool_use"), F.lit(False))
    delta = (se == "content_block_delta") & (F.col("e.event.delta.type") == "input_json_delta")
    used = F.filter(F.coalesce("e.message.content", F.array().cast("array<struct<type:string,name:string,input:map<string,string>>>")), lambda c: c["type"] == "tool_use")
    one = F.get(used, 0)
    named = F.lit(False)
    for name, field in FIELD.items():
        named = named | F.coalesce((one["name"] == name) & F.contains(one["input"][field], F.lit(wanted)), F.lit(False))
    plain = (
        F.when(tool & ~F.coalesce(F.col("e.event.content_block.name").isin(*FIELD), F.lit(False)), False)
        .when(se == "message_stop", False)
        .when((kind == "assistant") & (F.size(used) > 0), named)
        .when(kind == "result", False)
    )
    said = F.when(delta, F.coalesce("e.event.delta.partial_json", F.lit("")))
    x = events.select("key", F.col("seq").cast("long").alias("seq"), tool.alias("tool"), F.coalesce(se == "content_block_stop", F.lit(False)).alias("stop"), said.alias("said"), plain.alias("plain"))
    x = x.withColumn("block", F.count_if("tool").over(W.partitionBy("key").orderBy("seq")))
    verdict = F.when(F.col("stop") & (F.col("block") > 0), False).otherwise(F.col("plain"))
    blocks = x.groupBy("key", "block").agg(
        F.min(F.when(verdict.isNotNull(), F.struct("seq", verdict.alias("verdict")))).alias("plain"),
        F.array_sort(F.collect_list(F.when((F.col("block") > 0) & F.col("said").isNotNull(), F.struct("seq", "said")))).alias("said"),
    )
    place = F.locate(wanted, F.array_join(F.transform("said", lambda s: s["said"]), ""))
    # the delta that ends what is wanted: the first with so many characters up to its end
    start = F.struct(F.lit(0).alias("n"), F.lit(None).cast("long").alias("seq"))
    grown = lambda a, s: F.struct((a["n"] + F.char_length(s["said"])).alias("n"), F.when(a["seq"].isNull() & (a["n"] + F.char_length(s["said"]) >= place + len(wanted) - 1), s["seq"]).otherwise(a["seq"]).alias("seq"))
    held = blocks.withColumn("place", place)
    place = F.col("place")
    at = F.when(place > 0, F.aggregate("said", start, grown)["seq"])
    first = F.least("plain", F.when(at.isNotNull(), F.struct(at.alias("seq"), F.lit(True).alias("verdict"))))
    return held.select("key", first.alias("first")).groupBy("key").agg(F.coalesce(F.min("first")["verdict"], F.lit(False)).alias("triggered"))


class Decider(StatefulProcessor):
    """The verdict of one key from events in any order: they wait, by seq, until those before them have come or time is up."""

    def __init__(self, wanted: str, wait_ms: int, forget_ms: int, first: int | None):
        self.wanted, self.wait_ms, self.forget_ms, self.first = wanted, wait_ms, forget_ms, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "seq long", "event string")
        self.progress = handle.getValueState("progress", "due long, following long, pending boolean, said string")
        self.decided = handle.getValueState("decided", "triggered boolean", self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        given = [(int(s), e) for frame in rows for s, e in zip(frame["seq"], frame["event"], strict=True)]
        if self.decided.exists():
            return
        if self.progress.exists():
            due, following, pending, said = self.progress.get()
        else:
            due, following, pending, said = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms, self.first or 0, False, ""
            self.handle.registerTimer(due)
        for seq, event in given:
            if (self.first is None or seq >= following) and not self.waiting.containsKey((seq,)):
                self.waiting.updateValue((seq,), (event or "",))
        verdict = None
        while verdict is None and self.first is not None and self.waiting.containsKey((following,)):
            event = self.waiting.getValue((following,))[0]
            self.waiting.removeKey((following,))
            following += 1
            if event:
                pending, said, verdict = step(json.loads(event), self.wanted, pending, said)
        if verdict is None:
            self.progress.update((due, following, pending, said))
        else:
            self.handle.deleteTimer(due)
            yield self._decide(key, verdict)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.decided.exists() or not self.progress.exists():
            return
        _, _, pending, said = self.progress.get()
        verdict = None
        for _, event in sorted((k[0], v[0]) for k, v in self.waiting.iterator()):
            if event and verdict is None:
                pending, said, verdict = step(json.loads(event), self.wanted, pending, said)
        yield self._decide(key, bool(verdict))

    def _decide(self, key, verdict: bool) -> pd.DataFrame:
        self.waiting.clear()
        self.progress.clear()
        self.decided.update((verdict,))
        return pd.DataFrame({"key": [key[0]], "triggered": [verdict]})


def decisions_of_stream(events: DataFrame, wanted: str, seconds: float, forget_seconds: float = 86_400, first: int | None = None) -> DataFrame:
    """The verdicts of first_decisions() over a stream of key, seq, e, in whatever order and batches events come: one row a key.

    A key is judged `seconds` after its first event, by the events that have come, in order of seq (False if none decides). With
    `first`, the seq of each key's first line, a key is judged as soon as an unbroken run of lines from there decides it; the
    stream must then have a row for every line, e being null where it is no event. Of rows with one seq the first counts. A key that
    has been judged is remembered for forget_seconds, and later events of it are dropped; then nothing of it is kept.
    """
    use_rocksdb(events.sparkSession)
    said = events.select("key", "seq", F.to_json("e").alias("event"))
    judge = Decider(wanted, max(1, int(seconds * 1000)), max(1, int(forget_seconds * 1000)), first)
    return said.groupBy("key").transformWithStateInPandas(judge, "key string, triggered boolean", "append", "ProcessingTime")


def use_rocksdb(spark: SparkSession) -> None:
    """Streaming state on disk, as state with timers and time to live needs it."""
    for k, v in STATE.items():
        spark.conf.set(k, v)


def step(e: dict, wanted: str, pending: bool, said: str) -> tuple[bool, str, bool | None]:
    """One event: whether a tool that counts is open, its input so far, and the verdict if there is one."""
    if e.get("type") == "stream_event":
        se = e.get("event") or {}
        block, delta = se.get("content_block") or {}, se.get("delta") or {}
        if se.get("type") == "content_block_start" and block.get("type") == "tool_use":
            return (True, "", None) if block.get("name") in FIELD else (pending, said, False)
        if se.get("type") == "content_block_delta" and pending and delta.get("type") == "input_json_delta":
            said += delta.get("partial_json") or ""
            return pending, said, True if wanted in said else None
        if se.get("type") == "message_stop" or se.get("type") == "content_block_stop" and pending:
            return pending, said, False
    elif e.get("type") == "assistant":
        for c in (e.get("message") or {}).get("content") or []:
            if c.get("type") == "tool_use":
                given = c.get("input") or {}
                return pending, said, wanted in (given.get(FIELD.get(c.get("name"), ""), "") or "")
    elif e.get("type") == "result":
        return pending, said, False
    return pending, said, None


def parsed_lines(spark: SparkSession, folder: str, every: bool = False) -> DataFrame:
    """A stream of key, seq, e from Parquet files of key, seq, value; lines that are no event are left out, or with `every` have a null e."""
    lines = spark.readStream.schema("key string, seq long, value string").parquet(folder)
    e = F.from_json("value", schemas.EVENT)
    out = lines.select("key", "seq", F.when(e["type"].isNotNull(), e).alias("e"))
    return out if every else out.filter("e is not null")


def ingest(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, keys: list[str]) -> None:
    """All new Parquet files of a folder to target, once each; rows whose keys were taken in any run before are left out.

    There is no state: a batch's rows are joined with the keys of what target already has, of which only those columns are
    read. A batch's rows go to a folder of their own, named by the checkpoint and the batch's number, so that a batch that is run again after a
    failure replaces its own rows and no others. Null keys are equal to each other. Late rows are taken whenever they come.
    """
    feed = spark.readStream.schema(schema).parquet(folder)
    names = feed.columns

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        own = json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        fresh, part = batch.dropDuplicates(keys), f"{own}-{number}"
        if listed(session, target):
            held = session.read.schema(f"{schema}, part string").parquet(target).filter(F.col("part") != part).select(*[F.col(k).alias(f"held_{k}") for k in keys])
            fresh = fresh.join(held, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"held_{k}")) for k in keys]), "left_anti")
        fresh.select(*names).write.mode("overwrite").parquet(f"{target}/part={part}")

    feed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def refreshed(stream: DataFrame, checkpoint: str, report: Callable[[DataFrame], None]):
    """report(rows of the batch) after each batch, such as an overwrite of a page that is read while the loop runs."""
    return stream.writeStream.foreachBatch(lambda batch, _: report(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
