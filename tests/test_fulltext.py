"""The stored index, held against plain counts of words."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import fulltext
from millrace.plans import registry
from millrace.shared import new_path
from tests.helpers import SF, same_as_sql

WORDS = "the and with of to a b c rare über 漢字".split()


def plain(rows, terms, k):
    held = [(i, Counter((text or "").lower().split())) for i, text in rows if i is not None]
    hits = [(i, sum(c[t] for t in set(terms))) for i, c in held if all(c[t] for t in terms)]
    return sorted(hits, key=lambda x: (-x[1], x[0]))[:k]


@pytest.fixture(scope="module")
def some():
    rng = random.Random(4)
    rows = [(rng.randrange(-(2**62), 2**62), " ".join(rng.choices(WORDS, weights=[90, 40, 30, 20, 20, 9, 9, 9, 1, 2, 3], k=rng.choice([0, 3, 20, 200])))) for _ in range(2500)]
    return rows + [(1, None), (2, ""), (None, "the and with"), (3, "The THE the"), (3, "and with"), (5, "the and with"), (5, "the and with"), (4, "the and with " * 20_000)]


@pytest.mark.parametrize("per_block", [20, 300, 10**6])
def test_search_equals_plain_counts(spark, some, per_block, monkeypatch):
    monkeypatch.setattr(fulltext, "FIRST", 4)
    df, path = spark.createDataFrame(some, "id long, text string"), new_path(spark, "index")
    fulltext.write_index(df, path, "id", "text", per_block=per_block, n_buckets=7)
    for terms, k in ((["the", "and", "with"], 20), (["rare"], 5), (["rare", "über", "the"], 1000), (["a", "b", "c", "the"], 7), (["the", "the"], 3), (["the", "nowhere"], 3), (["漢字", "b"], 1)):
        assert [tuple(r) for r in fulltext.search(spark, path, terms, k).collect()] == plain(some, terms, k), terms
    with pytest.raises(ValueError):
        fulltext.search(spark, path, [], 3)


def test_appended_items_are_found(spark, some):
    df, path = spark.createDataFrame(some, "id long, text string"), new_path(spark, "index")
    old = F.pmod(F.xxhash64("id"), F.lit(3)) < 2
    fulltext.write_index(df.filter(old), path, "id", "text", per_block=100, n_buckets=5)
    fulltext.write_index(df.filter(~old), path, "id", "text", append=True)
    assert [tuple(r) for r in fulltext.search(spark, path, ["the", "with"], 50).collect()] == plain(some, ["the", "with"], 50)


def test_only_the_terms_folders_are_read(spark, some):
    df, path = spark.createDataFrame(some, "id long, text string"), new_path(spark, "index")
    fulltext.write_index(df, path, "id", "text", per_block=50, n_buckets=16)
    rows = fulltext.postings(spark, path, ["the", "rare"])
    opened = {r[0].split("bucket=")[1].split("/")[0] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert opened == {str(r[0]) for r in rows.select("bucket").distinct().collect()} and len(opened) <= 2
    plan = rows.select("greatest")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(term" in plan and "gaps" not in plan.split("ReadSchema")[1]
    assert rows.agg(F.max("n")).first()[0] <= 50  # items of a block, however common a term is


def test_empty_table(spark):
    path = new_path(spark, "index")
    fulltext.write_index(spark.createDataFrame([], "id long, text string"), path, "id", "text")
    assert fulltext.search(spark, path, ["a"], 3).count() == 0 and fulltext.term_statistics(spark, path).count() == 0


def test_index_is_written_once(spark):
    assert registry.text_index(spark, SF) == registry.text_index(spark, SF) != registry.text_index(spark, SF.replace("0.001", "0.01"))
    for d in (SF, SF.replace("0.001", "0.01")):
        for name in ("fulltext_search", "term_statistics"):
            same_as_sql(registry.QUERIES[name](spark, d), registry.ORACLES[name], d)


def test_terms_are_counted_without_an_index_as_with_one(spark):
    rows = [(1, "a b a"), (2, None), (3, ""), (4, "  B\tc "), (4, "b b"), (None, "a lost")]
    items, path = spark.createDataFrame(rows, "id long, text string"), new_path(spark, "terms")
    fulltext.write_index(items, path, "id", "text")
    plain = lambda df: sorted(tuple(r) for r in df.select("term", "n_items", "n_occurrences").collect())
    got = plain(fulltext.term_counts(items, "id", "text"))
    assert got == plain(fulltext.term_statistics(spark, path)) == [("a", 1, 2), ("b", 3, 4), ("c", 1, 1)]
    assert "MapInArrow" not in registry.QUERIES["term_statistics"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    same_as_sql(registry.QUERIES["term_statistics"](spark, SF), registry.ORACLES["term_statistics"])
