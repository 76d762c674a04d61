"""Streams in any order, late and repeated rows: held against the same rules in a batch."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources import results
from millrace.streaming import events


def s(kind, **x):
    return {"type": "stream_event", "event": {"type": kind, **x}}


def start(name):
    return s("content_block_start", content_block={"type": "tool_use", "name": name})


def delta(said):
    return s("content_block_delta", delta={"type": "input_json_delta", "partial_json": said})


POOL = [start("Skill"), start("Read"), start("Bash"), delta("my-"), delta("skill"), delta("my-skill"), delta("zz"), s("message_stop"), s("content_block_stop"), {"type": "result"}, {"type": "system"}, "no event", {"type": "assistant", "message": {"content": [{"type": "tool_use", "name": "Skill", "input": {"skill": "my-skill"}}]}}]


def calls(n, seed):
    rng = random.Random(seed)
    rows = [(f"k{k}", q, e if isinstance(e, str) else json.dumps(e)) for k in range(n) for q, e in enumerate(rng.choice([POOL[0]] * 3 + POOL) for _ in range(rng.randint(1, 7)))]
    rng.shuffle(rows)
    return rows


def run(decided, name, n, tmp_path, patience=90):
    query = decided.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / f"ck-{name}")).start()
    for _ in range(patience):
        time.sleep(0.5)
        if decided.sparkSession.table(name).count() >= n:
            break
    return query


@pytest.mark.parametrize("first", [None, 0])
def test_shuffled_events_give_the_batch_verdict(spark, tmp_path, first):
    """Lines of each call over four batches in no order; then lines of judged calls come late: one row a key, as the batch has it."""
    rows = calls(40, 8)
    lines = "key string, seq long, value string"
    want = {r["key"]: r["triggered"] for r in events.first_decisions(results.events_of_lines(spark.createDataFrame(rows, lines)), "my-skill").collect()}
    silent = {k for k, *_ in rows} - set(want)  # no line of theirs is an event
    for at in range(4):
        spark.createDataFrame(rows[at::4], lines).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(lines).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    e = F.from_json("value", events.schemas.EVENT)
    stream = stream.select("key", "seq", F.when(e["type"].isNotNull(), e).alias("e"))
    if first is None:
        stream = stream.filter("e is not null")
    n = len(want) + (len(silent) if first == 0 else 0)
    query = run(events.decisions_of_stream(stream, "my-skill", 25, first=first), f"verdicts{first}", n, tmp_path, 240)
    try:
        spark.createDataFrame([(k, 0, json.dumps(POOL[5])) for k in want] + [(k, 99, json.dumps(POOL[-1])) for k in want], lines).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(6)
        got = [(r["key"], r["triggered"]) for r in spark.table(f"verdicts{first}").collect()]
    finally:
        query.stop()
    assert len(got) == n and {k: v for k, v in got if k not in silent} == want and not any(v for k, v in got if k in silent)


def test_ingest_takes_each_key_once(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    schema = "id long, t string"
    parts = [[(1, "a"), (1, "a"), (None, "n")], [(1, "a"), (2, "b"), (None, "n")], [(k, "x") for k in range(100)] * 2, []]
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(src))
        events.ingest(spark, str(src), schema, out, str(tmp_path / "ck"), ["id"])
        got = [r["id"] for r in spark.read.parquet(out).collect()]
        assert len(got) == len(set(got))
    assert set(got) == {None, *range(100)}
    events.ingest(spark, str(src), schema, out, str(tmp_path / "ck2"), ["id"])  # from the beginning: nothing is taken again, nothing is lost
    assert sorted(r["id"] is None or r["id"] for r in spark.read.parquet(out).collect()) == sorted(x is None or x for x in got)


def test_no_state_grows_with_what_was_ingested(spark, tmp_path):
    src, schema = tmp_path / "in", "id long, t string"
    for k in range(5):
        spark.range(k * 50, k * 50 + 80).selectExpr("id", "'x' t").write.mode("append").parquet(str(src))
        events.ingest(spark, str(src), schema, str(tmp_path / "out"), str(tmp_path / "ck"), ["id"])
    assert not (tmp_path / "ck" / "state").exists()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 280
