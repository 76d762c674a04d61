"""Cleaning that can be undone: rules with the places of what they took, and footers found and dropped by source."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from urllib.parse import parse_qs, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

#: A rule: its name, a regular expression, and what a match becomes (a template or a function of the match).
Rule = tuple[str, str, str | Callable[[re.Match], str]]
#: Text, the places it came from, and the rules that made it (none: as given).
Piece = tuple[str, int, int, str]
SPANS = "struct<cleaned:string,spans:array<struct<start:int,end:int,rule:string,removed:string,put:string>>>"


def _target(m: re.Match) -> str:
    """The target of a redirecting url, else the url."""
    try:
        given = parse_qs(urlsplit(m[0]).query)
    except ValueError:
        return m[0]
    return next((v for k in ("url", "u", "target") for v in given.get(k, [])[:1] if v.startswith(("http://", "https://"))), m[0])


CONTROLS: Rule = ("controls", "[​-‍﻿\x00-\x08\x0b\x0c\x0e-\x1f]+", "")
NFC: Rule = ("nfc", r"(?s).?[^\x00-\x7f]+", lambda m: unicodedata.normalize("NFC", m[0]))
URLS: Rule = ("urls", r"https?://[^\s\"'<>]+", _target)
EMOJI: Rule = ("emoji", "([\U0001f300-\U0001faff☀-➿])\\1+", r"\1")
SPACES: Rule = ("spaces", "[ \t\n\x0b\f\r\xa0]+", " ")
ENDS: Rule = ("ends", r"\A +| +\Z", "")
RULES: list[Rule] = [CONTROLS, NFC, URLS, EMOJI, SPACES, ENDS]


def lines(name: str, patterns: list[str]) -> Rule:
    """A rule that takes whole lines that a pattern fits, with their line ends."""
    return name, rf"(?m)^(?:{'|'.join(f'(?:{p})' for p in patterns)})$\n?", ""


def _edits(now: str, pattern: str, put) -> list[tuple[int, int, str]]:
    """What a rule changes in a text: start, end, new; what a match leaves equal at its ends isn't part of it, but for one character."""
    out = []
    for m in re.finditer(pattern, now):
        old, new = m[0], put(m) if callable(put) else m.expand(put)
        if old and old != new:
            head = min(len(os.path.commonprefix([old, new])), len(old) - 1)
            tail = min(len(os.path.commonprefix([old[head:][::-1], new[head:][::-1]])), len(old) - head - 1)
            out.append((m.start() + head, m.end() - tail, new[head : len(new) - tail]))
    return out


def _cut(pieces: list[Piece], at: list[int]) -> Iterator[Piece]:
    """Pieces of text as given, cut at these places of the joined text, which are in order; changed pieces stay whole."""
    pos, k = 0, 0
    for s, x, y, by in pieces:
        end, done = pos + len(s), 0
        while k < len(at) and at[k] < end:
            if not by and at[k] - pos > done:
                yield s[done : at[k] - pos], x + done, x + at[k] - pos, ""
                done = at[k] - pos
            k += 1
        yield (s, x, y, by) if by else (s[done:], x + done, y, "")
        pos = end


def traced(text: str, rules: list[Rule]) -> tuple[str, list[tuple[int, int, str, str, str]]]:
    """The text after all rules, and what they changed as (start, end, rules, removed, put), places being in the text as given.

    The text is held as pieces, each with the places it came from. Changes that touch a piece that was changed before make one piece
    with it, which has all their rules' names. Time is linear in the text for each rule. Empty matches change nothing.
    """
    pieces: list[Piece] = [(text, 0, len(text), "")] if text else []
    for name, pattern, put in rules:
        now = "".join(p[0] for p in pieces)
        edits = _edits(now, pattern, put)
        if not edits:
            continue
        cut = list(_cut(pieces, [k for e in edits for k in e[:2]]))
        pieces, i, j, pos = [], 0, 0, 0
        while i < len(cut):
            s, x, y, by = cut[i]
            end = pos + len(s)
            if j == len(edits) or edits[j][0] >= end:
                pieces.append(cut[i])
                i, pos = i + 1, end
                continue
            said, at, end, names = [], pos, pos, []
            while end == pos or end < at:  # pieces until the end of the changes that touch them
                end += len(cut[i][0])
                names += [r for r in cut[i][3].split("+") if r and r not in names]
                y, i = cut[i][2], i + 1
                while j < len(edits) and edits[j][0] < end:
                    said += [now[at : edits[j][0]], edits[j][2]]
                    at, j = edits[j][1], j + 1
            said.append(now[at:end])
            pieces.append(("".join(said), x, y, "+".join(names + [name] * (name not in names))))
            pos = end
    return "".join(p[0] for p in pieces), [(x, y, by, text[x:y], s) for s, x, y, by in pieces if by]


def cleaned(text: Column, rules: list[Rule] | None = None) -> Column:
    """struct of cleaned and spans, by traced(); null for null. rebuilt() gives the text back."""
    chosen = RULES if rules is None else rules

    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            done = [(None, None) if x is None else traced(x, chosen) for x in s]
            yield pd.DataFrame(done, columns=["cleaned", "spans"])

    return run(text)


def rebuilt(cleaned: Column, spans: Column) -> Column:
    """The raw text from the cleaned one and its spans: what was kept lies between the spans, in order."""
    zero = F.struct(F.lit(1).alias("at"), F.lit(0).alias("raw"), F.array().cast("array<string>").alias("parts"))

    def add(state: Column, span: Column) -> Column:
        kept = span["start"] - state["raw"]
        return F.struct((state["at"] + kept + F.char_length(span["put"])).alias("at"), span["end"].alias("raw"), F.concat(state["parts"], F.array(F.substr(cleaned, state["at"], kept), span["removed"])).alias("parts"))

    return F.aggregate(spans, zero, add, lambda s: F.concat(F.array_join(s["parts"], ""), F.substr(cleaned, s["at"], F.char_length(cleaned) + 1)))


def _held_lines(items: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """id, source, line: a text's different lines, white space at both ends and blank lines aside."""
    held = F.array_distinct(F.filter(F.transform(F.split(text_col, "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    return items.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.explode(held).alias("line"))


def _digest(line: Column) -> Column:
    return F.unhex(F.sha2(line, 256))


def footers(items: DataFrame, id_col: str, source_col: str, text_col: str, least_docs: int = 3, least_share: float = 0.1) -> DataFrame:
    """source, line, n_docs: lines that at least least_docs texts of a source have, and that share of its texts: proposed rules.

    Counted over all texts and exactly, in one shuffle: counts are made before rows are shuffled, so a line of a hot source arrives
    once a task, and no line more than once a task. A null source is a source; null texts count as texts.
    """
    sizes = items.groupBy(F.col(source_col).alias("s")).agg(F.count(F.lit(1)).alias("n_texts"))
    counted = _held_lines(items, id_col, source_col, text_col).groupBy("source", "line").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= least_docs)
    return counted.join(sizes, F.col("source").eqNullSafe(F.col("s"))).filter(F.col("n_docs") >= F.col("n_texts") * least_share).select("source", "line", "n_docs")


def without_lines(items: DataFrame, rules: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """items with cleaned_text and removed_lines: lines that the rules (source, line; a null source: all sources) name are taken out.

    Rules are joined by the line's digest, so there may be any number of them; a text meets only its own. ids are unique. Lines are
    compared without white space at their ends. A text without such lines, and a null one, is as it was.
    """
    r = rules.select(F.col("source").alias("r_source"), _digest(F.trim("line")).alias("h")).distinct()
    keyed = _held_lines(items, id_col, source_col, text_col).select("id", "source", _digest(F.col("line")).alias("h"))
    hit = keyed.join(r, "h").filter("r_source is null or r_source = source").groupBy("id").agg(F.collect_set("h").alias("_bad"))
    split = F.split(text_col, "\n")
    bad = lambda x: F.array_contains("_bad", _digest(F.trim(x)))
    out = items.join(hit, F.col(id_col) == F.col("id"), "left").drop("id") if id_col != "id" else items.join(hit, "id", "left")
    return out.withColumns(
        {
            "cleaned_text": F.when(F.col("_bad").isNull(), F.col(text_col)).otherwise(F.array_join(F.filter(split, lambda x: ~bad(x)), "\n")),
            "removed_lines": F.when(F.col("_bad").isNull(), F.array().cast("array<string>")).otherwise(F.filter(split, bad)),
        }
    ).drop("_bad")
