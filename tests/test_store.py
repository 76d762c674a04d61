import json
import sqlite3
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.sources import adapters as A
from millrace.sources import store as S

NOW = datetime(2026, 1, 2)


def source(spark, *rows):
    return spark.createDataFrame([(i, t, h, None, NOW) for i, t, h in rows], S.SCHEMAS["source"])


def item(spark, *rows):
    return spark.createDataFrame([(i, s, f"u{i}", NOW, t, t, None, None, None) for i, s, t in rows], S.SCHEMAS["research_item"])


def note(spark, *rows):
    return spark.createDataFrame([(i, k, body, author, NOW) for i, k, body, author in rows], S.SCHEMAS["note"])


@pytest.fixture
def store(spark, tmp_path):
    s = S.Store(spark, f"file://{tmp_path}/store")
    s.commit("a", {"source": source(spark, (1, "jsonl", "x")), "research_item": item(spark, (10, 1, "one"), (11, 1, None or ""))})
    return s


def counts(s):
    return {t: s.read(t).count() for t in S.SCHEMAS}


def test_batches_are_whole_and_come_once(spark, store):
    assert counts(store) == {"source": 1, "research_item": 2, "media_asset": 0, "structured_field": 0, "note": 0}
    assert store.commit("a", {"source": source(spark, (9, "jsonl", "z"))}) is False
    assert store.commit("b", {"note": note(spark, (1, 10, "seen", "human"))})
    assert counts(store)["note"] == 1 and counts(store)["source"] == 1
    assert store.commit("empty", {"note": note(spark, (1, 10, "x", "human")).limit(0)}) and store.commit("none", {})
    assert counts(store)["note"] == 1


@pytest.mark.parametrize(
    "bad,rule",
    [
        (lambda s: {"research_item": item(s, (10, 1, "changed"))}, "research_item: id is new: 1"),
        (lambda s: {"research_item": item(s, (12, 1, "a"), (12, 1, "b"), (12, 1, "c"))}, "research_item: id is used once: 2"),
        (lambda s: {"research_item": item(s, (None, 1, "a"))}, "research_item: id is given: 1"),
        (lambda s: {"research_item": item(s, (13, 7, "a"), (14, None, "b"))}, "research_item: source_id is in source: 2"),
        (lambda s: {"research_item": item(s, (13, 1, None))}, "research_item: raw text is given: 1"),
        (lambda s: {"note": note(s, (2, 10, "x", "system"))}, "note: author is human: 1"),
        (lambda s: {"source": source(s, (2, "jsonl", "y")), "note": note(s, (2, 99, "x", "human"))}, "note: research_item_id is in research_item: 1"),
    ],
)
def test_a_broken_rule_leaves_all_tables_as_they_were(spark, store, bad, rule):
    before = counts(store)
    with pytest.raises(S.Refused, match=rule):
        store.commit("b", bad(spark))
    assert counts(store) == before and store.read("research_item").filter("id = 10").first()["raw_text"] == "one"
    assert store.vacuum() == len(bad(spark)) and store.vacuum() == 0
    assert store.commit("b", {"research_item": item(spark, (12, 1, "a"))})


def test_a_writer_lost_in_a_task_leaves_nothing(spark, store):
    before = counts(store)
    lost = item(spark, (20, 1, "a"), (21, 1, "b")).withColumn("raw_text", F.when(F.col("id") == 21, F.raise_error(F.lit("lost"))).otherwise(F.col("raw_text")))
    with pytest.raises(Exception, match="lost"):
        store.commit("c", {"source": source(spark, (3, "jsonl", "y")), "research_item": lost})
    assert counts(store) == before
    assert store.commit("c", {"source": source(spark, (3, "jsonl", "y")), "research_item": item(spark, (20, 1, "a"), (21, 3, "b"))})
    assert counts(store)["research_item"] == 4


def test_one_writer_at_a_time(spark, store):
    lock = store._path("_lock")
    store._take(lock)
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit("d", {})
    assert S.Store(spark, store.root, lock_seconds=-1).commit("d", {})  # an old lock is taken over
    with pytest.raises(S.Refused, match="columns"):
        store.commit("e", {"note": note(spark, (1, 10, "x", "human")).withColumn("more", F.lit(1))})
    with pytest.raises(ValueError, match="no name"):
        store.commit("_x", {})


def test_item_view_does_not_multiply_children(spark, store):
    media = spark.createDataFrame([(k, 10, "video", f"m/{k}", None, None, 5) for k in (2, 1)], S.SCHEMAS["media_asset"])
    store.commit("v", {"media_asset": media, "note": note(spark, *[(k, 10, f"n{k}", "human") for k in (3, 1, 2)])})
    rows = {r["id"]: r for r in S.item_view(*[store.read(t) for t in ("research_item", "source", "media_asset", "structured_field", "note")]).collect()}
    assert [m["storage_path"] for m in rows[10]["media"]] == ["m/1", "m/2"] and [n["body"] for n in rows[10]["notes"]] == ["n1", "n2", "n3"]
    assert rows[10]["fields"] == [] and rows[11]["media"] == [] and rows[11]["source_handle"] == "x"


def lines(path, posts, mode="a"):
    with open(path, mode, encoding="utf-8") as f:
        f.writelines(json.dumps(p) + "\n" for p in posts)


def test_ranges_of_any_span_give_each_line_once(tmp_path):
    p = str(tmp_path / "x.jsonl")
    with open(p, "wb") as f:
        f.write(b'{"text":"a"}\n\n{"text":"\xc3\xa9\xc3\xa9"}\nno json\n' + b'{"text":"' + b"z" * 200_000 + b'"}\n{"text":"half')
    a = A.JsonLines(p)
    whole = list(a.fetch_new(0, a.latest()))
    assert len(whole) == 4 and whole[-1][1].endswith('z"}\n')
    for span in (7, 13, 1000):
        assert [x for at in range(0, a.latest(), span) for x in a.fetch_new(at, min(at + span, a.latest()))] == whole
    assert A.JsonLines("/dev/null").latest() == 0
    with open(p, "wb") as f:
        f.write(b"x" * 200_000)
    assert a.latest() == 0


def test_a_batch_reads_all_kinds_of_sources(spark, tmp_path):
    lines(tmp_path / "a.jsonl", [{"text": f"t{i}", "url": f"u{i}", "likes": i} for i in range(50)])
    with sqlite3.connect(tmp_path / "b.db") as db:
        db.execute("CREATE TABLE posts (url TEXT, text TEXT, views INTEGER)")
        db.executemany("INSERT INTO posts VALUES (?, ?, ?)", [(None, "hello", 3), ("u", None, None)])
    tracked = source(spark, (1, "jsonl", str(tmp_path / "a.jsonl")), (2, "sqlite", f"{tmp_path}/b.db#posts"))
    found = A.items(A.posts(tracked, span=100))
    rows = {r["original_url"]: r for r in found.collect()}
    assert len(rows) == 52 and rows["u7"]["raw_text"] == "t7" and rows["u7"]["extras"] == {"likes": "7"}
    assert rows["2#1"]["raw_text"] == "hello" and rows["u"]["raw_text"] == "" and rows["2#1"]["extras"]["views"] == "3"
    assert A.posts(tracked, span=100).rdd.getNumPartitions() > 5
    assert A.posts(tracked.limit(0)).count() == 0
    with pytest.raises(Exception, match="no adapter"):
        A.posts(source(spark, (1, "fax", "x"))).count()


def test_a_stream_that_stops_loses_and_repeats_nothing(spark, tmp_path):
    file, checkpoint = tmp_path / "a.jsonl", f"{tmp_path}/checkpoint"
    lines(file, [{"text": f"t{i}"} for i in range(20)])
    s = S.Store(spark, f"file://{tmp_path}/store")
    s.commit("sources", {"source": source(spark, (1, "jsonl", str(file)))})
    A.collect(s, checkpoint, span=64)
    assert s.read("research_item").count() == 20
    with open(file, "a") as f:
        f.write('{"text":"half')
    A.collect(s, checkpoint, span=64)
    assert s.read("research_item").count() == 20
    with open(file, "a") as f:
        f.write('"}\n')
    lines(file, [{"text": "t0"}])
    real, s.commit = s.commit, lambda *_: 1 / 0  # stopped after reading, before anything is stored
    with pytest.raises(Exception):
        A.collect(s, checkpoint, span=64)
    s.commit = lambda *x: real(*x) and 1 / 0  # stopped after the rows are stored, before the checkpoint knows
    with pytest.raises(Exception):
        A.collect(s, checkpoint, span=64)
    s.commit = real
    A.collect(s, checkpoint, span=64)
    rows = s.read("research_item").collect()
    assert sorted(r["raw_text"] for r in rows) == sorted([f"t{i}" for i in range(20)] + ["half", "t0"])
    assert len({r["id"] for r in rows}) == 22
