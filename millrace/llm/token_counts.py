"""Token counts: the exact histogram of encoded lengths, and what its suffix sums answer.

Lengths are counted per task, then summed: what is shuffled and kept is one row per length that
occurs, however many documents there are. With suffix sums over it (documents and tokens of at least
a length), the total, any quantile, and the total left when documents are cut to any context limit
are read off without another pass over the texts.

Null text has length 0, as empty text has. Each row counts, repeated or not; identifiers and other
columns aren't read. An empty table has no lengths, and its totals are 0 and its quantiles null.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import VOCAB, encoder
from millrace.llm.common import documents, saved

#: Lengths of one window of the suffix sums; the windows' own totals are summed apart.
SPAN = 4096


def length_histogram(docs: DataFrame, text_col: str = "text", vocab: str = VOCAB, extra: int = 0) -> DataFrame:
    """n_tokens, n_docs. extra: ids that are added to each document, such as an end id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, found = encoder(vocab), Counter()
        size = of.dtype.itemsize
        for b in batches:
            of = encoder(vocab)
            for text in b.column(0):
                found[len(of.ids(text.as_py() or "")) // size + extra] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (found.keys(), found.values())], ["n_tokens", "n_docs"])

    lengths = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "n_tokens long, n_docs long")
    return lengths.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """And docs_at_least, tokens_at_least: over all lengths from this one; truncated_total: tokens left if each document is cut to this length."""
    spans = histogram.withColumns({"span": F.floor(F.col("n_tokens") / SPAN), "tokens": F.col("n_tokens") * F.col("n_docs")})
    later = W.orderBy(F.desc("span")).rowsBetween(W.unboundedPreceding, -1)  # one row a span
    earlier = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    known = lambda c: F.coalesce(c, F.lit(0))
    by_span = spans.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    beside = by_span.select("span", known(F.sum("d").over(later)).alias("docs_above"), known(F.sum("t").over(later)).alias("tokens_above"), known(F.sum("t").over(earlier)).alias("tokens_below"))
    down = W.partitionBy("span").orderBy(F.desc("n_tokens"))
    up = W.partitionBy("span").orderBy("n_tokens").rowsBetween(W.unboundedPreceding, -1)
    out = spans.join(beside, "span").withColumns(
        {
            "docs_at_least": F.sum("n_docs").over(down) + F.col("docs_above"),
            "tokens_at_least": F.sum("tokens").over(down) + F.col("tokens_above"),
            "shorter": known(F.sum("tokens").over(up)) + F.col("tokens_below"),
        }
    )
    cut = F.col("shorter") + F.col("n_tokens") * F.col("docs_at_least")
    return out.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("truncated_total"))


def totals(summed: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit, whether it occurs as a length or not: documents longer than it, tokens kept if they are cut to it, tokens lost.

    summed: of with_suffix_sums(). The suffix sums at the least length above a limit are the greatest of those above it, so
    that they answer all limits in one pass over the lengths, without summing documents again.
    """
    spark = summed.sparkSession
    above = [F.coalesce(F.max(F.when(F.col("n_tokens") > x, F.col(c))), F.lit(0)).alias(f"{c}{i}") for i, x in enumerate(limits) for c in ("docs_at_least", "tokens_at_least")]
    row = summed.agg(F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("total"), *above).first()
    out = []
    for i, x in enumerate(limits):
        over, tokens = row[f"docs_at_least{i}"], row[f"tokens_at_least{i}"]
        kept = row["total"] - tokens + x * over
        out.append((x, over, kept, row["total"] - kept))
    return spark.createDataFrame(out, "context long, docs_over long, tokens_kept long, tokens_lost long")


def quantiles(summed: DataFrame, shares: list[float]) -> DataFrame:
    """For each share q, the least length that at least q of all documents don't exceed. summed: of with_suffix_sums()."""
    n = F.max("docs_at_least")
    count = summed.agg(n).first()[0]
    if count is None:
        return summed.sparkSession.createDataFrame([(q, None) for q in shares], "share double, n_tokens long")
    upto = F.lit(count) - F.col("docs_at_least") + F.col("n_docs")
    row = summed.agg(*[F.min(F.when(upto >= q * count, F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)]).first()
    return summed.sparkSession.createDataFrame([(q, row[f"q{i}"]) for i, q in enumerate(shares)], "share double, n_tokens long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_suffix_sums(saved(length_histogram(documents(spark, sf_dir)), "lengths"))
