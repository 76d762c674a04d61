"""Connected components of a table of links: spanning forests where the links lie, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, saved

BLOCK = 1 << 20  # links that a task holds at once


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links a, b: each node that can reach a lesser one, and the least node it can reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:  # each node to its label's label, until all labels are roots
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _forests(edges: DataFrame) -> DataFrame:
    """Links that join the same nodes as edges do, fewer: of each block of a task's rows its spanning forest, as stars."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            a, b = forest(*(np.concatenate([r.column(k).to_numpy() for r in held]) for k in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for r in batches:
            held.append(r)
            n += r.num_rows
            if n >= BLOCK:
                yield out()
                held, n = [], 0
        if n:
            yield out()

    return edges.select("a", "b").mapInArrow(cut, "a long, b long")


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """edges: a > b. Each node's neighbours (large: the greater ones; small: the lesser ones) are linked to its least one."""
    swapped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges if small else edges.unionByName(swapped)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = (edges if small else swapped).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    else:  # what is below a node stays linked to the node's least one
        moved = moved.unionByName(least.filter("m < a").select("a", F.col("m").alias("b")))
    moved = moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return moved if small else moved.distinct()  # the small star reads this twice: its exchange is used again


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node has two labels, or is both a label and labelled."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")), F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("up")))).alias("e")).select("e.*")
    seen = ends.groupBy("node").agg(F.min("up").alias("lo"), F.max("up").alias("hi"), F.bool_or(F.col("up").isNull()).alias("label"))
    return seen.filter("lo <> hi or (label and lo is not null)").agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """links: a, b (long). One row per linked node: node, label (the least node it can reach). Each round is a table in the shared folder.

    A link of a node with itself links nothing. No links give no rows.
    """
    edges = saved(_forests(links), "edges")
    while not _are_stars(edges):
        new = saved(_forests(_star(_star(edges, False), True)), "edges")
        dropped(edges)
        edges = new
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")))
    return ends.distinct()
