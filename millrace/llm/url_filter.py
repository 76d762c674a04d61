"""URL filter: allow and block rules in a trie over reversed host labels and path segments.

A rule is (host, path, verdict). It fits a url whose host is the rule's or a subdomain of it and
whose path starts with the rule's. Of the rules that fit, the one with most host labels, then the
longest path, wins, whether it allows or blocks. Host: after the first ``://`` up to ``/``, ``?``,
``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end.

Defined cases: a null url or one without ``://`` has an empty host and path and gets the default
verdict; of two rules with the same host and path, the blocking one stays; a rule without a host
fits every url that has a host; repeated rows and ties in the page key are judged row by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The trie goes to the executors only if its rules have no more characters than this; beyond it, rules are joined.
TRIE_CHARS = 32 << 20

#: The rules of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_URL = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def split_url(url: str | None) -> tuple[str, str]:
    m = _URL.match(url) if url else None
    return (m[1].translate(_AZ), m[2]) if m else ("", "")


class Trie:
    """Host labels from the right, then whole path segments, then the rest of a rule's path within a segment."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for r in rules:
            node = self.root
            for label in reversed(r.host.split(".")) if r.host else ():
                node = node.setdefault(("h", label), {})
            *whole, rest = r.path.split("/")
            for segment in whole:
                node = node.setdefault(("p", segment), {})
            old = node.setdefault("rules", {}).get(rest)
            if old is None or r.verdict == "block":
                node["rules"][rest] = (r.name, r.verdict)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """Longest match: the deepest host node that has a fitting rule, there the longest path."""
        if not host:
            return None
        found, node = self._in_path(self.root, path), self.root
        for label in reversed(host.split(".")):
            node = node.get(("h", label))
            if node is None:
                break
            found = self._in_path(node, path) or found
        return found

    @staticmethod
    def _in_path(node: dict, path: str) -> tuple[str, str] | None:
        found, segments = None, path.split("/")
        for k, segment in enumerate(segments):
            rules = node.get("rules")
            if rules:
                fits = [x for x in rules if segment.startswith(x)]
                if fits:
                    found = rules[max(fits, key=len)]
            if k == len(segments) - 1:
                break
            node = node.get(("p", segment))
            if node is None:
                break
        return found


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of pages: key, host, path, rule, verdict."""
    known = [Rule(*r) for r in rules]
    if sum(len(r.name) + 8 for r in known) > TRIE_CHARS:
        return judge_urls_by_join(pages, pages.sparkSession.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string"), key, url, default)
    trie = pages.sparkSession.sparkContext.broadcast(Trie(known))
    kind = pages.schema[key].dataType

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for b in batches:
            at = [split_url(u) for u in b.column(1).to_pylist()]
            found = [match(h, p) or (None, default) for h, p in at]
            cols = [pa.array(c, pa.string()) for c in ([h for h, _ in at], [p for _, p in at], [r for r, _ in found], [v for _, v in found])]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["key", "host", "path", "rule", "verdict"])

    out = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url")).mapInArrow(judge, f"key {kind.simpleString()}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)


def judge_urls_by_join(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """The same for rule lists too large to broadcast: distinct (host, path) pairs meet rules by each of their host suffixes.

    Pairs are made distinct first, so that a host with a third of all pages is joined once per path.
    A rule host is an equi-join key; which of its paths fit is a residual test.
    """
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))  # block > allow
    at = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    pairs = at.select("host", "path").distinct().filter("host <> ''")
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    met = pairs.withColumn("rule_host", F.explode(F.array_append(tails, F.lit("")))).join(rules, "rule_host").filter("startswith(path, rule_path)")
    rank = F.struct(F.length("rule_host"), F.length("rule_path"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), rank).alias("best"))
    return at.join(best, ["host", "path"], "left").select(key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


ORACLE = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id,
  CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path FROM u),
r(rule_host, rule_path, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT h.page_id, h.host, h.path, r.rule_host || r.rule_path AS rule, r.v,
  row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule_host) DESC, length(r.rule_path) DESC) AS k
  FROM h JOIN r ON (h.host = r.rule_host OR ends_with(h.host, '.' || r.rule_host)) AND starts_with(h.path, r.rule_path))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id AND m.k = 1
"""
