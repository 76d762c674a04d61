"""The stratified split by counted digits, held against a ranking of all rows."""

import hashlib
from collections import Counter, defaultdict

import pytest

from millrace.operators import evalstats
from millrace.plans import registry
from tests.helpers import SF, same_as_sql

KINDS = "key string, kind string, n int, split_at int"


def ranked(rows, holdout, seed=42):
    """Of each class, how many rows of each key are test."""
    by = defaultdict(list)
    for key, kind, *_ in rows:
        by[kind].append((hashlib.md5(f"{seed}:{key or ''}".encode()).hexdigest(), key))
    return {kind: Counter(k for _, k in sorted(x, key=lambda y: y[0])[: max(1, int(len(x) * holdout))]) for kind, x in by.items()}


def split(df, holdout):
    got, n = defaultdict(Counter), 0
    for r in evalstats.stratified_split(df, "key", "kind", holdout).collect():
        n += 1
        if r["split"] == "test":
            got[r["kind"]][r["key"]] += 1
    return dict(got), n


@pytest.mark.parametrize("at_once", [100_000, 3])
@pytest.mark.parametrize("holdout", [0.4, 0.01, 0.999])
def test_split_equals_ranking(spark, monkeypatch, at_once, holdout):
    monkeypatch.setattr(evalstats, "RANKED", at_once)
    monkeypatch.setattr(evalstats, "DIGITS", 1 if at_once == 3 else 4)
    rows = [(f"q{i}", "abc"[i % 3], i, 1) for i in range(900)] + [("one", "z", 1, 1), ("a null kind", None, 1, 1), (None, "n", 1, 1), (None, "n", 1, 1)]
    assert split(spark.createDataFrame(rows, KINDS).repartition(5), holdout) == (ranked(rows, holdout), len(rows))


@pytest.mark.parametrize("at_once", [100_000, 3])
def test_one_key_with_most_rows(spark, monkeypatch, at_once):
    """Repeated rows at the border: as many are test as are wanted, and none is lost."""
    monkeypatch.setattr(evalstats, "RANKED", at_once)
    monkeypatch.setattr(evalstats, "DIGITS", 2)
    rows = [("hot", "a", 1, 1)] * 700 + [(f"q{i}", "a", i, 1) for i in range(300)] + [("hot", "b", 1, 1)] * 40
    for holdout in (0.2, 0.5, 0.9):
        got, n = split(spark.createDataFrame(rows, KINDS).repartition(6), holdout)
        assert n == len(rows) and got == ranked(rows, holdout)


def test_no_class_is_one_task(spark):
    """The plan has windows over counts and over the border's rows alone: none reads the items."""
    df = spark.createDataFrame([(f"q{i}", "ab"[i % 2], i, 1) for i in range(50)], KINDS)
    out = evalstats.stratified_split(df, "key", "kind", 0.4)
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    (at,) = [k for k, x in enumerate(lines) if "Window [" in x]
    depth = lines[at].index("Window")
    below = next((k for k in range(at + 1, len(lines)) if len(lines[k]) - len(lines[k].lstrip(" :+-")) <= depth), len(lines))
    assert below > at + 1 and not any("42:" in x for x in lines[at:below])  # the digest of the items' keys isn't below it
    assert any("42:" in x for x in lines)
    assert evalstats.stratified_split(df.limit(0), "key", "kind", 0.4).count() == 0
    assert evalstats.stratified_split(df, "key", "kind", 0).filter("split = 'train'").count() == 50


@pytest.mark.parametrize("name", ["stratified_split", "train_semi", "test_anti", "history_sizes"])
def test_queries_equal_sql(spark, name):
    d = SF.replace("0.001", "0.01")
    same_as_sql(registry.QUERIES[name](spark, d), registry.ORACLES[name], d)
