"""Corpus operators: cleaning, duplicate flags, extraction, search. Source text is never changed; duplicates are flagged."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions import text as T

CleaningStep = Callable[[DataFrame], DataFrame]
N_BITS, KEPT = 60, 3
#: Exact search: rows and queries of one group at most or so, places of a cosine, and what stands for one that is undefined.
PART_ROWS, BLOCK_QUERIES, PLACES, UNDEFINED = 10_000, 8192, 4, 40_000


@F.pandas_udf(StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def step(f: Callable[[Column], Column]) -> CleaningStep:
    return lambda df: df.withColumn("cleaned_text", f(F.col("cleaned_text")))


def drop_lines(patterns: list[str]) -> CleaningStep:
    """Lines that fit a pattern leave cleaned_text and go to removed_spans."""
    bad = "|".join(f"(?:{p})" for p in patterns)

    def run(df: DataFrame) -> DataFrame:
        lines = F.split("cleaned_text", "\n")
        gone = F.filter(lines, lambda x: x.rlike(bad))
        return df.withColumns({"removed_spans": F.concat("removed_spans", gone), "cleaned_text": F.array_join(F.filter(lines, lambda x: ~x.rlike(bad)), "\n")})

    return run


NFC: CleaningStep = step(_nfc)
STEPS: list[CleaningStep] = [step(T.stripped), step(T.collapsed)]


def clean(items: DataFrame, raw: str = "raw_text", steps: list[CleaningStep] | None = None, version: str = T.RULES_VERSION) -> DataFrame:
    """cleaned_text, removed_spans and cleaning_version beside the raw text."""
    out = items.withColumns({"cleaned_text": F.col(raw), "removed_spans": F.array().cast("array<string>"), "cleaning_version": F.lit(version)})
    for s in STEPS if steps is None else steps:
        out = out.transform(s)
    return out


def exact_flags(items: DataFrame, id_col: str, text_col: str, source_col: str | None = None) -> DataFrame:
    """content_hash, duplicate_of (the first item's id, null for itself), group size. Groups are summed before the join, so a hot one isn't gathered."""
    h = F.sha2(F.concat(T.normalized(F.coalesce(F.col(text_col), F.lit(""))), *([F.coalesce(F.col(source_col), F.lit(""))] if source_col else [])), 256)
    keyed = items.select(id_col, h.alias("content_hash"))
    first = keyed.groupBy("content_hash").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("group_size"))
    return keyed.join(first, "content_hash").select(id_col, "content_hash", F.when(F.col("first_id") != F.col(id_col), F.col("first_id")).alias("duplicate_of"), "group_size")


def simhash(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """60-bit SimHash of the tokens, by md5. A text's votes are summed where its row is, so tokens aren't shuffled.

    Rows with the same id are one text; those without a token, null and empty texts among them, have no signature and no row.
    """
    h = F.conv(F.substring(F.md5("t"), 1, 15), 16, 10).cast("long")
    voters = items.select(id_col, F.explode(T.tokens(F.col(text_col))).alias("t")).select(id_col, h.alias("h"))
    votes = voters.groupBy(id_col).agg(*[F.sum(F.when(F.expr(f"(h & {1 << b}L) <> 0"), 1).otherwise(-1)).alias(f"b{b}") for b in range(N_BITS)])
    bits = sum((F.when(F.col(f"b{b}") > 0, F.lit(1 << b)).otherwise(F.lit(0)) for b in range(N_BITS)), F.lit(0)).cast("long")
    return votes.select(id_col, bits.alias("simhash"))


def near_signatures(signed: DataFrame, id_col: str, distance: int = 3) -> DataFrame:
    """Pairs of different signatures within the distance, and each one's least id. Equal signatures are one class, so copies aren't paired.

    The bits are cut into KEPT blocks more than the distance; signatures within it agree in some KEPT blocks whole, so an
    equi-join on each choice of blocks finds all pairs. A key holds half the bits or so: few pairs meet that aren't near.
    """
    n_blocks = distance + KEPT
    edges = [N_BITS * k // n_blocks for k in range(n_blocks + 1)]
    masks = [sum((1 << edges[k + 1]) - (1 << edges[k]) for k in chosen) for chosen in combinations(range(n_blocks), KEPT)]
    classes = signed.groupBy("simhash").agg(F.min(id_col).alias("id"))
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"simhash & {m}L").alias("v")) for k, m in enumerate(masks)])
    keyed = classes.select("simhash", "id", F.explode(keys).alias("key"))
    a, b = (keyed.select("key", F.col("simhash").alias(f"{x}_sig"), F.col("id").alias(f"{x}_id")) for x in "ab")
    met = a.join(b, "key").filter("a_sig < b_sig").withColumn("distance", T.hamming(F.col("a_sig"), F.col("b_sig"))).filter(F.col("distance") <= distance)
    return met.select("a_sig", "b_sig", "a_id", "b_id", "distance").distinct()


def fields(items: DataFrame, id_col: str, text_col: str, rules: dict[str, str] = T.FIELDS) -> DataFrame:
    """Long rows of extracted values with their provenance."""
    found = F.array(*[F.struct(F.lit(k).alias("name"), F.regexp_extract_all(text_col, F.lit(p), F.lit(0)).alias("values")) for k, p in rules.items()])
    long = items.select(id_col, F.explode(found).alias("f")).select(id_col, "f.name", F.explode("f.values").alias("value"))
    return long.withColumns({"origin": F.lit("system"), "model": F.lit(None).cast("string"), "prompt_version": F.lit(T.RULES_VERSION), "confidence": F.lit(1.0)})


def links(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    return pages.select(id_col, F.posexplode(F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))).alias("position", "link"))


def _vectors(col: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of d numbers with their lengths; which rows have one."""
    fit = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(col), -1)) == d)
    flat = col.take(pa.array(fit)).flatten()
    ok = np.asarray(flat.is_valid()).reshape(-1, d).all(axis=1)
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)[ok], fit[ok]


def _ranked(x: pa.Array, q: pa.Array, own: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Of each query and row a whole number that sorts as their cosine does, rounded to PLACES: 0 where there is none, UNDEFINED for NaN, -1 for a row with the query's id."""
    out = np.zeros((len(q), len(x)), np.int64)
    sizes = lambda c: {n for n in pc.unique(pc.list_value_length(c)).to_pylist() if n}
    for d in sizes(x) & sizes(q):
        (a, at), (b, to) = _vectors(q, d), _vectors(x, d)
        with np.errstate(all="ignore"):
            length = np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))
            cosine = a @ b.T / length
            rank = np.where(np.isnan(cosine), UNDEFINED, np.sign(cosine) * np.floor(np.abs(cosine) * 10**PLACES + 0.5) + 10**PLACES + 1)
        rank[length == 0] = 0
        out[np.ix_(at, to)] = rank.astype(np.int64)
    out[asked[:, None] == own] = -1
    return out


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str, vec: str, k: int) -> DataFrame:
    """For each query vector the k most similar others by cosine, rounded to four places, then id: all are compared, by products of matrices.

    Rows are dealt to parts and queries to blocks by a hash of the id; a part meets a block in one group of bounded size, which
    keeps k rows of each query. Null vectors, those of length 0, with a null number or of another length than the query's
    have no cosine and come last; rows without an id aren't compared.
    """
    rows, asked = (x.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias(n), F.col(vec).alias(v)) for x, n, v in ((vectors, "id", "vec"), (queries, "query_id", "query_vec")))
    n_parts, n_blocks = max(1, -(-rows.count() // PART_ROWS)), max(1, -(-asked.count() // BLOCK_QUERIES))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select("id", "vec", dealt("id", n_parts).alias("part"), each(n_blocks).alias("block"))
    asked = asked.select("query_id", "query_vec", dealt("query_id", n_blocks).alias("block"), each(n_parts).alias("part"))

    keys, n_tasks = ["part", "block"], min(n_parts * n_blocks, 4096)  # a group is much work for its bytes: groups aren't put together by these
    held, asked = (x.repartition(n_tasks, *keys) for x in (held, asked))

    def meet(rows: pa.Table, asked: pa.Table) -> pa.Table:
        rows = rows.sort_by("id").combine_chunks()  # a place in the part sorts as the id does
        own, ids, low = rows.column("id").to_numpy(), asked.column("query_id").to_numpy(), (1 << 32) - 1
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        x, q = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (rows.column("vec"), asked.column("query_vec")))
        for at in range(0, len(ids), 1024):
            some, best = q.slice(at, 1024), np.full((len(ids[at : at + 1024]), k), -1, np.int64)
            for to in range(0, len(own), 2048):
                rank = _ranked(x.slice(to, 2048), some, own[to : to + 2048], ids[at : at + 1024])
                key = np.where(rank < 0, -1, rank << 32 | low - np.arange(to, to + rank.shape[1]))
                best = -np.partition(-np.concatenate([best, key], axis=1), k - 1, axis=1)[:, :k]
            i, j = np.nonzero(best >= 0)
            for out, got in zip(found, (ids[at : at + 1024][i], own[low - (best[i, j] & low)], best[i, j] >> 32), strict=True):
                out.append(got)
        a, b, rank = (np.concatenate(x) for x in found)
        cosine = np.where(rank == UNDEFINED, np.nan, (rank - 10**PLACES - 1) / 10**PLACES)
        return pa.table([pa.array(a), pa.array(b), pa.array(cosine, mask=rank == 0)], ["query_id", "id", "cosine"])

    met = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, "query_id long, id long, cosine double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("cosine"), "id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).withColumnRenamed("id", id_col)


def listed_terms(items: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """id, name, value, n: terms of a list (name, value; one word each, lower case) that a text holds, never guessed.

    The list is joined by term, so a long one isn't broadcast by force; a text's tokens are counted before.
    """
    held = items.select(id_col, F.explode(T.tokens(F.col(text_col))).alias("value")).groupBy(id_col, "value").agg(F.count(F.lit(1)).alias("n"))
    return held.join(terms.select("name", "value").distinct(), "value").select(id_col, "name", "value", "n")


def listed_phrases(items: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """id, name, value, place (of its first token, from 0), n_words: terms of one or several words (name, value) that a text holds.

    Of terms that begin at one token the longest counts, and one that lies inside another that was found doesn't; terms that
    only overlap both count, and so do equal terms of several names. A term meets the tokens that are its first word, each of which carries as many
    following ones as the longest term has; both are compared as normalised tokens. Null texts and blank terms give nothing; ids are unique.
    """
    words = terms.select("name", T.tokens(F.col("value")).alias("words")).filter(F.size("words") > 0).distinct()
    width = words.agg(F.coalesce(F.max(F.size("words")), F.lit(1))).first()[0]
    held = items.select(F.col(id_col).alias("id"), T.tokens(F.col(text_col)).alias("t"))
    near = held.select("id", F.explode(F.transform("t", lambda x, i: F.struct(i.alias("place"), F.slice("t", i + 1, F.lit(width)).alias("after")))).alias("p")).select("id", "p.*")
    met = near.join(words.withColumn("first", F.get("words", F.lit(0))), F.get("after", F.lit(0)) == F.col("first")).filter(F.slice("after", F.lit(1), F.size("words")) == F.col("words"))
    found = met.select("id", "name", F.array_join("words", " ").alias("value"), "place", F.size("words").alias("n_words"))
    end = F.col("place") + F.col("n_words")
    before = F.max(end).over(W.partitionBy("id").orderBy("place").rangeBetween(W.unboundedPreceding, -1))
    here = F.max(end).over(W.partitionBy("id").orderBy("place").rangeBetween(0, 0))
    kept = found.withColumns({"_before": before, "_here": here}).filter((end == F.col("_here")) & F.coalesce(F.col("_before") < end, F.lit(True)))
    return kept.select(F.col("id").alias(id_col), "name", "value", "place", "n_words")


def unsure(found: DataFrame, least: float = 0.8) -> DataFrame:
    """Fields that a person or a better model must see: confidence below the least, or unknown."""
    return found.filter(F.coalesce(F.col("confidence"), F.lit(0.0)) < least)


def shape(text: Column) -> Column:
    """What a text is made of: a table (two rows of cells one after another), else a link, else text."""
    return F.when(text.rlike(r"(?m)^\|.*\|[ \t]*\n\|.*\|[ \t]*$"), "table").when(text.rlike("https?://"), "link").otherwise("text")


def unreviewed(items: DataFrame, notes: DataFrame, item_id: str, note_item: str) -> DataFrame:
    return items.join(notes.select(F.col(note_item).alias(item_id)), item_id, "left_anti")


def append_once(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing and those rows of new whose keys it doesn't have yet."""
    return existing.unionByName(new.dropDuplicates(keys).join(existing.select(keys), keys, "left_anti"))
