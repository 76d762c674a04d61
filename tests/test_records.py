import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import corpus as C
from millrace.operators import evalstats as E
from millrace.operators import records as R
from millrace.sources import sinks

RUNS = "eval_id long, configuration string, run_number int, pass_rate double, time_seconds double, tokens long"


def runs(spark):
    rows = [(2, "with_skill", 1, 0.5, 10.0, 100), (1, "with_skill", 2, 1.0, 20.0, 201), (1, "with_skill", 1, 0.75, 30.0, 300), (1, "base_line", 1, 0.25, 12.5, 90), (2, "base_line", 1, None, None, None), (3, "third", 1, 0.0, 1.0, 1)]
    return spark.createDataFrame(rows, RUNS)


def test_benchmark_record_and_files(spark, tmp_path):
    r = R.benchmark(runs(spark), "s", "p", "2026-01-01T00:00:00Z", ["odd"])
    assert list(r["run_summary"]) == ["base_line", "with_skill", "third", "delta"]
    assert [(x["configuration"], x["eval_id"], x["run_number"]) for x in r["runs"]] == [("base_line", 1, 1), ("base_line", 2, 1), ("with_skill", 1, 1), ("with_skill", 1, 2), ("with_skill", 2, 1), ("third", 3, 1)]
    assert r["runs"][1]["result"] == {"pass_rate": 0.0, "passed": 0, "failed": 0, "total": 0, "time_seconds": 0.0, "tokens": 0, "tool_calls": 0, "errors": 0}
    assert r["run_summary"]["delta"] == {"pass_rate": "-0.50", "time_seconds": "-7.5", "tokens": "-110"}
    assert r["metadata"]["evals_run"] == [1, 2, 3] and r["metadata"]["runs_per_configuration"] == 2
    sinks.benchmark_files(spark, r, str(tmp_path))
    assert json.loads((tmp_path / "benchmark.json").read_text()) == r
    lines = (tmp_path / "benchmark.md").read_text().split("\n")
    assert lines[8:12] == ["| Metric | Base Line | With Skill | Delta |", "|--------|------------|---------------|-------|", "| Pass Rate | 25% ± 0% | 75% ± 25% | -0.50 |", "| Time | 12.5s ± 0.0s | 20.0s ± 10.0s | -7.5s |"]
    assert lines[-3:] == ["## Notes", "", "- odd"]


def test_benchmark_of_nothing(spark):
    r = R.benchmark(spark.createDataFrame([], RUNS))
    assert r["runs"] == [] and r["run_summary"] == {"delta": {"pass_rate": "+0.00", "time_seconds": "+0.0", "tokens": "+0"}}
    assert "| Metric | Config A | Config B | Delta |" in R.benchmark_lines(r)
    assert R.deltas(spark.createDataFrame([], RUNS)).first().asDict() == {"delta_pass_rate": 0.0, "delta_time_seconds": 0.0, "delta_tokens": 0.0}


def test_one_configuration_is_its_own_delta(spark):
    x = runs(spark).filter("configuration = 'third'")
    assert R.deltas(x).first().asDict() == {"delta_pass_rate": 0.0, "delta_time_seconds": 1.0, "delta_tokens": 1.0}
    assert R.paired(x, "tokens").first().asDict() == {"eval_id": 3, "first": 1.0, "second": None, "change": None}


def test_packaged(spark):
    names = ["s/a.md", "s/evals/x", "s/sub/evals/x", "s/__pycache__/a.py", "s/q/node_modules/z", "s/.DS_Store", "s/a.pyc", "evals", "s/evals"]
    kept = R.packaged(spark.createDataFrame([(n,) for n in names], "path string"))
    assert sorted(r[0] for r in kept.collect()) == ["evals", "s/a.md", "s/sub/evals/x"]


def test_reviews_versions_and_items(spark):
    said = spark.createDataFrame([(1, " \n\t"), (1, None), (2, ""), (2, "no")], "iteration int, feedback string")
    assert {r["iteration"]: r["stop"] for r in R.may_stop(said, ["iteration"]).collect()} == {1: True, 2: False}
    v = spark.createDataFrame([("v2", 0.9), ("v1", 0.9), ("v0", 0.5), ("v3", None)], "version string, expectation_pass_rate double")
    assert R.current_best(v).first()["version"] == "v1"
    assert R.current_best(v.limit(0)).first()["version"] is None
    items = spark.createDataFrame([(1, "a", " \t", None), (2, "a", None, "m"), (3, None, "t", "m"), (4, "b", "t", None)], "id int, source string, text string, media string")
    assert sorted(r["id"] for r in R.acceptable(items, "source", ["text", "media"]).collect()) == [2, 4]


def test_headers_take_nulls_as_a_group(spark):
    x = spark.createDataFrame([(3, True), (1, True), (2, None), (4, None), (5, False)], "k int, should_trigger boolean")
    assert {r["k"] for r in R.headed(x, "k").collect() if r["header"]} == {1, 2, 5}
    assert R.class_counts(x).first().asDict() == {"total": 5, "positive": 2, "negative": 3}


def test_cascade_gives_a_pair_once(spark):
    p = lambda *rows: spark.createDataFrame(list(rows), "a_id int, b_id int")
    got = R.cascade([("exact", p((1, 2), (2, 1))), ("near", p((2, 1), (3, 4))), ("semantic", p((4, 3), (5, 6)))])
    assert sorted(map(tuple, got.collect())) == [(1, 2, "exact"), (3, 4, "near"), (5, 6, "semantic")]


def test_suggestions_are_in_order_of_priority(spark):
    x = spark.createDataFrame([("low", "a"), ("high", "b"), ("odd", "c"), ("medium", "d"), (None, "e"), ("high", "b")], "priority string, category string")
    got = [(r["priority"], r["n"], r["rank"]) for r in R.suggestion_counts(x).collect()]
    assert got[:3] == [("high", 2, 1), ("medium", 1, 2), ("low", 1, 3)] and {r[2] for r in got[3:]} == {4}


def test_columns_of_text(spark):
    x = spark.createDataFrame([("| a | b |\n|--|--|\n", 1), ("see https://x.y", 2), ("| a |", 3), (None, 4)], "t string, k int")
    assert [r[0] for r in x.orderBy("k").select(C.shape(F.col("t"))).collect()] == ["table", "link", "text", "text"]
    y = spark.createDataFrame([("🔥🔥🔥 hot **now\n**kept** x", 1)], "t string, k int")
    assert y.select(T.decluttered(F.col("t"))).first()[0] == "🔥 hot now\n**kept** x"
    found = spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.1), (4, None)], "k int, confidence double")
    assert sorted(r["k"] for r in C.unsure(found).collect()) == [3, 4]


def test_small_evaluation_functions(spark):
    x = spark.createDataFrame([({"a": 1, "b": 2},), ({},), (None,)], "m map<string,bigint>")
    assert [r[0] for r in x.select(R.total_calls(F.col("m"))).collect()] == [3, 0, 0]
    row = spark.range(1).select(*[E.bucket(F.lit(a), F.lit(b)) for a, b in ((8, 10), (5, 10), (4, 10), (0, 0))])
    assert list(row.first()) == ["good", "ok", "bad", "bad"]
    row = spark.range(1).select(*[E.winner(*map(F.lit, v)) for v in ((2, 1, 0.0, 1.0), (1, 2, 1.0, 0.0), (1, 1, 0.9, 0.5), (1, 1, 0.5, 0.9), (1, 1, 0.5, 0.5))])
    assert list(row.first()) == ["A", "B", "A", "B", "TIE"]
    assert sorted(r["run_idx"] for r in E.expanded(spark.range(1), 3).collect()) == [0, 1, 2]
    v = spark.createDataFrame([("v1", None, 0.5), ("v2", "v1", 0.75)], "version string, parent string, expectation_pass_rate double")
    assert {r["version"]: r["change"] for r in E.version_steps(v).collect()} == {"v1": None, "v2": 0.25}
    g = spark.createDataFrame([([("t", "factual", True, ""), ("u", "factual", False, "")],)], "claims array<struct<claim:string,type:string,verified:boolean,evidence:string>>")
    assert E.claim_tally(g).first().asDict() == {"type": "factual", "verified": 1, "total": 2}


def test_sinks_write_what_is_read_again(spark, tmp_path):
    x = spark.createDataFrame([(" a\t", True), ("", False), (" \n", False)], "query string, should_trigger boolean")
    sinks.eval_set(x, f"{tmp_path}/set")
    assert [r.asDict() for r in spark.read.json(f"{tmp_path}/set").collect()] == [{"query": "a", "should_trigger": True}]
    sinks.csv_snapshot(spark.range(2), f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == 2
    for _ in range(2):
        sinks.append(spark.range(3).withColumn("p", F.col("id") % 2), f"{tmp_path}/tab", "p")
    assert spark.read.parquet(f"{tmp_path}/tab").count() == 6
    with pytest.raises(ValueError):
        sinks.feedback(spark.range(1), f"{tmp_path}/f")
    sinks.feedback(spark.createDataFrame([([("r", "x")],)], "reviews array<struct<run_id:string,feedback:string>>"), f"{tmp_path}/f")
    assert spark.read.json(f"{tmp_path}/f").count() == 1
    a, b = (spark.createDataFrame(v, "k int, v string") for v in ([(1, "x")], [(1, "y"), (2, "z"), (2, "z")]))
    assert sorted(r["k"] for r in C.append_once(a, b, ["k"]).collect()) == [1, 2]
