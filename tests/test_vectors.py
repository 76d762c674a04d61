"""The index of vectors, held against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import corpus, vectors
from millrace.plans import registry
from millrace.shared import new_path
from tests.helpers import SF, same_as_sql

KINDS = "id long, vec array<float>"
MID = SF.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def some():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    x = [(i, (centres[i % 30] + 0.4 * rng.normal(size=16)).tolist()) for i in range(1500)]
    return x + [(5000 + i, x[7][1]) for i in range(700)] + [(9000, None), (9001, [0.0] * 16), (9002, [1.0]), (9003, [float("nan")] * 16), (9004, [None] * 16)]


def all_pairs(rows, queries, least):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in ok]), np.array([v / np.linalg.norm(v) for _, v in ok])
    out = {}
    for q in np.flatnonzero(np.isin(ids, queries)):
        for j, c in enumerate(x @ x[q]):
            if ids[j] != ids[q] and round(c, 4) >= least:
                out[int(ids[q]), int(ids[j])] = round(c, 4)
    return out


@pytest.mark.parametrize("least", [0.95, 0.6, -0.2])
def test_within_has_all_pairs(spark, some, least, monkeypatch):
    monkeypatch.setattr(vectors, "PART_ROWS", 60)
    monkeypatch.setattr(vectors, "PART_QUERIES", 5)
    df, path = spark.createDataFrame(some, KINDS), new_path(spark, "vectors")
    vectors.write_index(df, path, "id", "vec", n_cells=25)
    asked = [*range(0, 1500, 150), 5001, *range(9000, 9005)]
    got = vectors.Index(spark, path).within(df.filter(F.col("id").isin(asked)), "id", "vec", least).collect()
    want = all_pairs(some, asked, least)
    found = {(r["query_id"], r["id"]): r["cosine"] for r in got}
    assert len(found) == len(got)
    edge = {k for k, c in want.items() if abs(c - least) < 2e-4} | {k for k, c in found.items() if abs(c - least) < 2e-4}
    assert set(found) - edge == set(want) - edge
    assert all(abs(found[k] - want[k]) < 2e-4 for k in set(found) & set(want))


def recall(spark, index, table, queries, id_col, vec_col):
    got = index.search(queries, id_col, vec_col, 10).collect()
    want = corpus.nearest(table, queries, id_col, vec_col, 10).collect()
    least = {}
    for r in want:
        least[r["query_id"]] = min(r["cosine"], least.get(r["query_id"], 2))
    return sum(r["cosine"] >= least[r["query_id"]] for r in got) / len(want)  # a row as similar as the tenth is as good


def test_recall_on_clusters_and_on_the_tables(spark, some):
    df, path = spark.createDataFrame(some[:2200], KINDS), new_path(spark, "vectors")
    vectors.write_index(df, path, "id", "vec")
    index = vectors.Index(spark, path)
    assert index.n_probe < len(index.n) / 2
    assert recall(spark, index, df, df.filter("id % 50 = 0"), "id", "vec") >= 0.9
    e = spark.read.parquet(f"{MID}/embeddings.parquet")
    index = registry.vector_index(spark, MID)
    assert recall(spark, index, e, e.filter("vec_id % 100 = 0"), "vec_id", "embedding") >= 0.9
    assert index.n_probe < len(index.n)


def test_a_query_meets_its_cells_only(spark, some):
    """The work of a query is what its cells hold, and a narrow threshold leaves most cells out."""
    df, path = spark.createDataFrame(some[:2200], KINDS), new_path(spark, "vectors")
    vectors.write_index(df, path, "id", "vec")
    index = vectors.Index(spark, path)
    asked = df.filter("id < 1500 and id % 100 = 0")
    cells = index._probes(asked, "id", "vec", None, float(np.arccos(0.95))).count()
    assert 15 <= cells < 0.5 * 15 * len(index.n)
    probed = index._probes(asked, "id", "vec", index.n_probe, np.pi).count()
    assert probed <= 15 * index.n_probe


def test_empty_and_odd_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 0.0]), (2, [1.0, 0.0])]):
        df, path = spark.createDataFrame(rows, KINDS), new_path(spark, "vectors")
        vectors.write_index(df, path, "id", "vec")
        index = vectors.Index(spark, path)
        got = sorted(tuple(r) for r in index.search(df, "id", "vec", 3).select("query_id", "id", "cosine").collect())
        assert got == ([(1, 2, 1.0), (2, 1, 1.0)] if len(rows) == 2 else [])
        assert index.within(df, "id", "vec", 0.5).count() == len(got)


def test_semantic_dups_equal_sql(spark):
    same_as_sql(registry.QUERIES["semantic_dups"](spark, MID), registry.ORACLES["semantic_dups"], MID)


def test_exact_search_makes_no_row_of_each_pair(spark, monkeypatch):
    """Odd vectors, repeated ones and small parts and blocks give what joining all pairs gives."""
    monkeypatch.setattr(corpus, "PART_ROWS", 40)
    monkeypatch.setattr(corpus, "BLOCK_QUERIES", 7)
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(4)]) for k in range(150)] + [(200 + k, [1.0, 2.0, 3.0, 4.0]) for k in range(60)]
    rows += [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 2.0, 3.0]), (304, [1.0, 2.0]), (305, [2.0, 1.0]), (306, [float("nan"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (307, [-1.0, -2.0, -3.0, -4.0])]
    table = spark.createDataFrame(rows, "i long, v array<double>")
    asked = table.filter("i % 10 = 0 or i >= 300 or i is null")
    found = corpus.nearest(table, asked, "i", "v", 5)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    q = asked.select(F.col("i").alias("query_id"), F.col("v").alias("q"))
    pairs = table.join(q, F.col("i") != F.col("query_id")).select("query_id", "i", F.round(text.cosine(F.col("v"), F.col("q")), 4).alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "i"))
    plain = lambda df: sorted(repr(tuple(r)) for r in df.select("query_id", "i", "cosine", "rank").collect())
    assert plain(found) == plain(pairs.withColumn("rank", rank).filter("rank <= 5"))
    assert corpus.nearest(table.limit(0), asked, "i", "v", 5).count() == 0
