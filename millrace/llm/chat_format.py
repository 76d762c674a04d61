"""Preference formatting: pairs of conversations become one prompt and two masked completions.

The turns of each side are numbered from 0 by their order, whatever numbers they have, and so aligned; `turn` is that
number in all results. The first place where the sides differ in role or text (or where one has ended) ends the prompt. The turns before it are rendered once, those from
it on as two completions. Loss falls on the text and end mark of a completion's assistant turns; headers and all
else are masked.

preference_records() gives one record a pair: prompt, chosen, rejected, and for each completion the spans (in characters,
end exclusive) that are trained. A record holds PIECE turns at most, and PIECE different rows of one turn, so that a
conversation of any length is never gathered in one task: one of more than PIECE turns has several records, whose texts joined in order of
turns_from and places_from are the whole. preference_rows() gives the same as one row a turn.

Null pair or turn: the row is left out. Null role or text counts as empty. Exactly repeated rows are
one turn; different rows of one turn follow one another by role and text. A pair of which a side has
no rows has no prompt and one completion. Equal sides have a prompt only. What a record has nothing of is null. Other
columns aren't read. Texts of any length are whole. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import join_small, saved

END = "<|end|>\n"
PIECE = 256  # turns of one record at most
SPANS = "array<struct<start:int,end:int>>"


def _in_order(rows: DataFrame) -> DataFrame:
    """rows with `turn` as the number of its turn in the order of its pair's side, from 0, and `place` among the rows of its turn.

    Turns are ranked within blocks of PIECE turn numbers; a block's first number is the sum of the counts before it, so that
    only one narrow row a block is ordered over a whole conversation.
    """
    rows = rows.withColumn("block", F.col("turn") - F.pmod("turn", F.lit(PIECE)))
    turns = rows.select("pair_id", "side", "block", "turn").distinct().groupBy("pair_id", "side", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("pair_id", "side").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = saved(turns.select("pair_id", "side", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "blocks")
    block = W.partitionBy("pair_id", "side", "block")
    ranked = rows.distinct().withColumn("rank", F.dense_rank().over(block.orderBy("turn")))
    ranked = ranked.withColumn("place", F.row_number().over(W.partitionBy("pair_id", "side", "block", "turn").orderBy("role", "text")).cast("long"))
    found = join_small(ranked, blocks, ["pair_id", "side", "block"], "inner", blocks.count(), 60)
    return found.select("pair_id", "side", (F.col("before") + F.col("rank") - 1).alias("turn"), "place", "role", "text")


def aligned(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """pair_id, turn, place, c and r (role and text on either side, null where it has none), in_prompt."""
    side = lambda x, n: x.select(F.col(pair).alias("pair_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(n).alias("side"))
    placed = _in_order(side(chosen, "c").unionByName(side(rejected, "r")).filter("pair_id is not null and turn is not null"))
    said = lambda n: F.max(F.when(F.col("side") == n, F.struct("role", "text"))).alias(n)
    both = saved(placed.groupBy("pair_id", "turn", "place").agg(said("c"), said("r")), "turns")
    first = saved(both.filter(~F.col("c").eqNullSafe(F.col("r"))).groupBy("pair_id").agg(F.min(F.struct("turn", "place")).alias("first")), "first")
    split = join_small(both, first, "pair_id", "left", first.count(), 60)
    return split.withColumn("in_prompt", F.col("first").isNull() | (F.struct("turn", "place") < F.col("first"))).drop("first")


def _header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def preference_rows(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, place, role, rendered, n_masked, trained."""
    split = aligned(chosen, rejected, pair, turn, role, text)
    parts = F.when(F.col("in_prompt"), F.array(F.struct(F.lit("prompt").alias("part"), F.col("c").alias("said")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("part"), F.col("c").alias("said")), F.struct(F.lit("rejected").alias("part"), F.col("r").alias("said")))
    )
    out = split.select("pair_id", "turn", "place", F.explode(parts).alias("p")).select("pair_id", "turn", "place", "p.part", "p.said.role", "p.said.text", F.col("p.said").isNotNull().alias("there")).filter("there")
    header = _header(F.col("role"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    rendered = F.concat(header, F.col("text"), F.lit(END))
    n_masked = F.when(trained, F.char_length(header)).otherwise(F.char_length(rendered)).cast("long")
    return out.select("pair_id", "part", "turn", "place", "role", rendered.alias("rendered"), n_masked.alias("n_masked"), trained.alias("trained"))


def _spans(turns: Column) -> Column:
    """Of turns (role, text) in order: start and end of what is trained, in the joined rendering."""

    def add(at: Column, t: Column) -> Column:
        start = at["pos"] + F.char_length(_header(t["role"]))
        end = start + F.char_length(t["text"]) + len(END)
        spans = F.when(t["role"] == "assistant", F.concat(at["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(at["spans"])
        return F.struct(end.alias("pos"), spans.alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("pos"), F.array().cast(SPANS).alias("spans")), add, lambda at: at["spans"])


def preference_records(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """pair_id, turns_from, places_from, prompt, chosen, rejected, chosen_spans, rejected_spans."""
    split = aligned(chosen, rejected, pair, turn, role, text)
    at = {"turns_from": (F.floor(F.col("turn") / PIECE) * PIECE).cast("long"), "places_from": (F.floor((F.col("place") - 1) / PIECE) * PIECE + 1).cast("long")}
    turns = split.withColumns(at).groupBy("pair_id", *at).agg(F.array_sort(F.collect_list(F.struct("turn", "place", "in_prompt", "c", "r"))).alias("turns"))  # PIECE * PIECE at most
    part = lambda wanted, side: F.transform(F.filter("turns", lambda t: (t["in_prompt"] == wanted) & t[side].isNotNull()), lambda t: t[side])
    said = turns.select("pair_id", *at, part(True, "c").alias("p"), part(False, "c").alias("c"), part(False, "r").alias("r"))
    joined = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda t: F.concat(_header(t["role"]), t["text"], F.lit(END))), ""))
    return said.select("pair_id", *at, joined("p").alias("prompt"), joined("c").alias("chosen"), joined("r").alias("rejected"), _spans(F.col("c")).alias("chosen_spans"), _spans(F.col("r")).alias("rejected_spans"))


def swapped_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: chosen is all of one; rejected is it up to the last assistant turn, with the text of the partner's, conv_id xor 1. Without an answer of both there is no rejected side."""
    rows = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text").filter("pair_id is not null and turn is not null")
    last = rows.filter("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("last"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("other"))
    ends = last.select("pair_id", F.col("last.turn").alias("last")).join(other, "pair_id")
    before = rows.join(ends, "pair_id").filter("turn < last").select("pair_id", "turn", "role", "text")
    swap = ends.select("pair_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"), F.col("other").alias("text"))
    return rows, before.unionByName(swap)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = preference_records(*swapped_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    told = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ","))
    return out.withColumns({c: told(c) for c in ("chosen_spans", "rejected_spans")})


ORACLE = rf"""
WITH t AS (SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l0 AS (SELECT pair_id, turn, text, row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC) AS k FROM t WHERE role = 'assistant'),
l AS (SELECT a.pair_id, a.turn AS last, b.text AS other FROM l0 a JOIN l0 b ON b.pair_id = xor(a.pair_id, 1) AND b.k = 1 WHERE a.k = 1),
c0 AS (SELECT DISTINCT pair_id, dense_rank() OVER (PARTITION BY pair_id ORDER BY turn) - 1 AS turn, role, text FROM t),
r0 AS (SELECT DISTINCT pair_id, dense_rank() OVER (PARTITION BY pair_id ORDER BY turn) - 1 AS turn, role, text FROM (SELECT t.* FROM t JOIN l USING (pair_id) WHERE turn < last UNION ALL SELECT pair_id, last, 'assistant', other FROM l)),
c AS (SELECT *, row_number() OVER (PARTITION BY pair_id, turn ORDER BY role, text) AS place FROM c0),
r AS (SELECT *, row_number() OVER (PARTITION BY pair_id, turn ORDER BY role, text) AS place FROM r0),
b AS (SELECT pair_id, turn, place, c.role AS crole, c.text AS ctext, r.role AS rrole, r.text AS rtext FROM c FULL JOIN r USING (pair_id, turn, place)),
f AS (SELECT pair_id, turn AS fturn, place AS fplace FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, place) AS k FROM b WHERE crole IS DISTINCT FROM rrole OR ctext IS DISTINCT FROM rtext) WHERE k = 1),
s AS (SELECT b.*, fturn IS NULL OR turn < fturn OR (turn = fturn AND place < fplace) AS same FROM b LEFT JOIN f USING (pair_id)),
p AS (SELECT pair_id, 'prompt' AS part, turn, place, crole AS role, ctext AS text FROM s WHERE same
  UNION ALL SELECT pair_id, 'chosen', turn, place, crole, ctext FROM s WHERE NOT same AND crole IS NOT NULL
  UNION ALL SELECT pair_id, 'rejected', turn, place, rrole, rtext FROM s WHERE NOT same AND rrole IS NOT NULL),
d AS (SELECT *, CAST(floor(turn / {PIECE}) * {PIECE} AS BIGINT) AS turns_from, CAST(floor((place - 1) / {PIECE}) * {PIECE} + 1 AS BIGINT) AS places_from, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS said FROM p),
e AS (SELECT *, sum(length(said)) OVER (PARTITION BY pair_id, turns_from, places_from, part ORDER BY turn, place ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT pair_id, turns_from, places_from, string_agg(said, '' ORDER BY turn, place) FILTER (part = 'prompt') AS prompt, string_agg(said, '' ORDER BY turn, place) FILTER (part = 'chosen') AS chosen,
  string_agg(said, '' ORDER BY turn, place) FILTER (part = 'rejected') AS rejected,
  string_agg((upto - length(text) - {len(END)})::BIGINT || '-' || upto::BIGINT, ',' ORDER BY turn, place) FILTER (part = 'chosen' AND role = 'assistant') AS chosen_spans,
  string_agg((upto - length(text) - {len(END)})::BIGINT || '-' || upto::BIGINT, ',' ORDER BY turn, place) FILTER (part = 'rejected' AND role = 'assistant') AS rejected_spans
FROM e GROUP BY pair_id, turns_from, places_from
"""
