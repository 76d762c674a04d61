"""Front matter, metadata and assertion classes, case by case."""

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import evalstats
from millrace.plans import registry
from millrace.sources import results
from tests.helpers import SF, same_as_sql

MATTER = [
    ("---\nname: a-b\ndescription: one\n---\nbody", ("a-b", "one")),
    ("--- \r\nname: 'x'\r\ndescription: \"y z\"\r\n---\r\n", ("x", "y z")),
    ("---\nname: first\nname: last\ndescription: d1\ndescription: d2\n---", ("last", "d2")),
    ("---\nname: n\ndescription: >-\n  one\n\ttwo  \n  three\nlicense: MIT\n---", ("n", "one two three")),
    ("---\ndescription: |\n  one\n\n  after a blank line\nname: n\n---", ("n", "one")),
    ("---\ndescription: |\n---\n", ("", "")),
    ("---\n  name: indented\n---", ("", "")),
    ("---\nname: never closed", None), ("no matter\n---\n---", None), ("", None), (None, None), ("---\n---", ("", "")),
]


def test_front_matter(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(MATTER)], "k int, t string")
    got = {r["k"]: r for r in df.select("k", *[c.alias(n) for n, c in results.front_matter(F.col("t")).items()]).collect()}
    for k, (_, want) in enumerate(MATTER):
        assert got[k]["has_front_matter"] == (want is not None), k
        assert (got[k]["name"], got[k]["description"]) == (want or ("", "")), k


def test_metadata_rules(spark):
    ok = ["name", "description"]
    cases = [
        ("", "d", ok, None, None), (" a ", " d ", ok, None, None), ("a-b\t", "", ok, "x" * 500, None), ("A", "d", ok, None, "name not hyphen-case"), ("-a", "d", ok, None, "misplaced hyphen"), ("a--b", "d", ok, None, "misplaced hyphen"),
        ("a" * 65, "d", ok, None, "name too long"), (f" {'a' * 64} ", "d", ok, None, None), ("a", "<d", ok, None, "angle bracket"), ("a", "d" * 1025, ok, None, "description too long"), ("a", f" {'d' * 1024} ", ok, None, None),
        ("a", "d", ok, "x" * 501, "compatibility too long"), (None, "d", ok, None, "missing name"), ("a", None, ok, None, "missing description"), ("A", "d", [*ok, "color"], None, "unexpected key"),
    ]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, name string, description string, keys array<string>, compatibility string, want string")
    got = df.select("k", "want", evalstats.metadata_problem(*map(F.col, ("name", "description", "keys", "compatibility"))).alias("got")).collect()
    assert [(r["k"], r["got"]) for r in got] == [(r["k"], r["want"]) for r in got]


def test_a_text_of_one_side_has_its_own_class(spark):
    rows = [(1, "both", True, True), (1, "both", False, True), (1, "skill", True, True), (1, "base", False, False), (1, "mixed", True, True), (1, "mixed", True, False), (1, "mixed", False, True)]
    got = evalstats.assertion_classes(spark.createDataFrame(rows, "eval_id int, text string, with_skill boolean, passed boolean"))
    assert {r["text"]: r["class"] for r in got.collect()} == {"both": "always pass", "skill": "one side", "base": "one side", "mixed": "variable"}


@pytest.mark.parametrize("name", ["metadata_validation", "assertion_classes"])
def test_queries_equal_sql(spark, name):
    d = SF.replace("0.001", "0.01")
    same_as_sql(registry.QUERIES[name](spark, d), registry.ORACLES[name], d)
    if name == "metadata_validation":
        assert registry.QUERIES[name](spark, d).select("problem").distinct().count() >= 4


def test_a_mean_is_rounded_as_sql_rounds_it(spark):
    cases = [63.949999999999996, -63.949999999999996, 63.94999999999998, 0.25, 0.45, -0.05, 1e308, 0.0]
    got = spark.createDataFrame([(x,) for x in cases], "x double").select(evalstats.rounded(F.col("x"), 1).alias("r")).collect()
    want = [duckdb.execute("SELECT round(?::DOUBLE, 1)", [x]).fetchone()[0] for x in cases]
    assert [r["r"] for r in got] == want and want[:3] == [64.0, -64.0, 63.9]


def test_eval_variance_equals_sql(spark):
    d = SF.replace("0.001", "0.1")
    same_as_sql(registry.QUERIES["eval_variance"](spark, d), registry.ORACLES["eval_variance"], d)
