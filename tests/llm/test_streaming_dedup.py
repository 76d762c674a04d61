"""Exact deduplication that goes on from run to run, against brute force over all rows so far."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import common, exact_dedup, near_dup

RUNS = [
    [(1, "a b"), (2, "c"), (3, None), (4, "ab "), (5, "z"), (6, "long one")],
    [(7, "a  b"), (8, "c"), (9, "new"), (10, ""), (11, "zz"), (None, "lon gone")],
    [(12, "c"), (13, "new "), (14, "zzz"), (15, "other"), (16, "a b"), (16, "a b")],
]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1), lambda c: F.lit("all collide")])
def test_three_runs_on_one_state(spark, tmp_path, digest):
    state, seen = common.shared_path(spark, "goes-on"), []
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for k, rows in enumerate(RUNS):
        path = str(tmp_path / f"in {k}")
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
        docs = spark.read.parquet(path) if k != 1 else spark.createDataFrame(rows, "doc_id long, text string")  # not a file scan
        seen += rows
        want = []
        for i, t in rows:
            group = [(j, u) for j, u in seen if norm(u) == norm(t)]
            want.append((i, min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))[0], len(group)))
        for _ in range(2 if k == 2 else 1):  # the last run is done again under its name
            got = exact_dedup.duplicate_groups(docs, digest=digest, state_dir=state, run=str(k)).collect()
            assert sorted(((r["id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == sorted(want, key=repr)
            assert sum(r["kept"] for r in got) == len({(m, n) for (_, m, _), (_, t) in zip(want, rows, strict=True) if (n := norm(t)) and any(i == m and norm(u) == n for i, u in rows)} | {m for (_, m, _), (_, t) in zip(want, rows, strict=True) if not norm(t) and any(i == m for i, _ in rows)})


def test_columns_named_as_the_row_key(spark):
    """Three rows, two of them equal, with constant columns of the key's names: one copy goes, and the columns come back."""
    df = spark.createDataFrame([(1, "a b c d e f", 7, 7, "x"), (2, "a b c d e f", 7, 7, "y"), (3, "other words than these are here", 7, 7, "z")], "doc_id long, text string, _mr_file long, _MR_ROW long, _mr_score string")
    for out in (exact_dedup.drop_duplicates(df), near_dup.drop_near_duplicates(df)):
        assert out.columns == df.columns
        assert sorted(map(tuple, out.collect())) == [(1, "a b c d e f", 7, 7, "x"), (3, "other words than these are here", 7, 7, "z")]
