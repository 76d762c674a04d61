import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import cleaning as K
from millrace.operators import corpus as C
from millrace.operators import extras as Y
from millrace.sources.results import lines_of_chunks

FOOTER = K.lines("footer", ["ad.*"])
ODD = [("x", "ab", "b"), ("y", "bb", ""), ("z", "c+", "ab"), ("w", "ab", "q"), ("e", "b?a", ""), ("i", "d", "dbd"), ("k", "c", "cc"), ("n", "b*", "c")]


def plain(text, rules):
    for _, pattern, put in rules:
        text = re.sub(pattern, lambda m: m[0] if not m[0] else put(m) if callable(put) else m.expand(put), text)
    return text


def back(cleaned, spans):
    at, raw, out = 0, 0, []
    for start, end, _, removed, put in spans:
        kept = start - raw
        assert cleaned[at + kept : at + kept + len(put)] == put
        out += [cleaned[at : at + kept], removed]
        at, raw = at + kept + len(put), end
    return "".join(out) + cleaned[at:]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab \n\x00​éé☀cd"))
def test_spans_give_the_raw_text_back(text):
    for rules in ([FOOTER, *K.RULES], ODD):
        cleaned, spans = K.traced(text, rules)
        assert cleaned == plain(text, rules) and back(cleaned, spans) == text
    assert unicodedata.normalize("NFC", text) == plain(text, [K.NFC])
    once = K.traced(text, K.RULES)[0]
    assert K.traced(once, K.RULES)[0] == once


def test_rules_of_urls_pictographs_and_lines():
    raw = "see https://r.x/?u=https%3A%2F%2Fy.z%2Fa&k=1 ☀☀☀\nad: buy\nhttps://[bad?u=x end"
    assert K.traced(raw, [FOOTER, *K.RULES])[0] == "see https://y.z/a ☀ https://[bad?u=x end"
    spans = K.traced(raw, [FOOTER])[1]
    assert spans == [(raw.index("ad"), raw.index("https://["), "footer", "ad: buy\n", "")]
    assert K.traced("", K.RULES) == ("", []) and K.traced(" \n ", K.RULES)[0] == ""


def test_cleaned_column_with_nulls_and_long_texts(spark):
    texts = [None, "", "  a ​ b  ", "é" * 3 + "é" * 50_000 + "  z", "x" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", "text", K.cleaned(F.col("text")).alias("c"))
    rows = df.select("id", "text", "c", K.rebuilt(F.col("c.cleaned"), F.col("c.spans")).alias("again")).orderBy("id").collect()
    assert [r["again"] for r in rows] == texts and rows[0]["c"]["cleaned"] is None and rows[2]["c"]["cleaned"] == "a b"
    assert rows[3]["c"]["cleaned"] == "é" * 50_003 + " z"


def test_footers_of_sources(spark):
    said = [(i, "a" if i % 3 else None, f"text {i}\n Join us! \nmore {i}") for i in range(30)] + [(100, "b", "Join us!"), (101, "b", None), (102, "c", ""), (103, "b", "x\nx\nx\nx")]
    docs = spark.createDataFrame(said, "doc_id long, source string, text string")
    found = {(r["source"], r["line"], r["n_docs"]) for r in K.footers(docs, "doc_id", "source", "text").collect()}
    assert found == {("a", "Join us!", 20), (None, "Join us!", 10)}  # a line of one text only is none, however often
    assert K.footers(docs, "doc_id", "source", "text", least_docs=1, least_share=0.3).filter("source = 'b'").count() == 2
    rules = spark.createDataFrame([("a", "Join us!"), (None, "more 3"), ("z", "text 1")], "source string, line string")
    out = {r["doc_id"]: r for r in K.without_lines(docs.withColumn("h", F.lit(1)), rules, "doc_id", "source", "text").collect()}
    assert len(out) == 34 and out[1]["cleaned_text"] == "text 1\nmore 1" and out[1]["removed_lines"] == [" Join us! "]
    assert out[3]["cleaned_text"] == "text 3\n Join us! " and out[100]["cleaned_text"] == "Join us!"
    assert out[101]["cleaned_text"] is None and out[102]["cleaned_text"] == "" and out[103]["removed_lines"] == []
    assert K.footers(docs.limit(0), "doc_id", "source", "text").count() == 0 and K.without_lines(docs.limit(0), rules, "doc_id", "source", "text").count() == 0


def test_longest_phrases(spark):
    docs = spark.createDataFrame([(1, "New  York times square and New York; new york"), (2, None), (3, ""), (4, "a b c a b"), (5, "york")], "id int, text string")
    terms = spark.createDataFrame([("geo", "new york"), ("city", "New York"), ("paper", "new york times"), ("place", "times square"), ("x", "a b"), ("x", "b c"), ("x", "a"), ("x", " "), ("x", None)], "name string, value string")
    got = sorted((r["id"], r["name"], r["value"], r["place"], r["n_words"]) for r in C.listed_phrases(docs, "id", "text", terms).collect())
    assert got == [(1, "city", "new york", 7, 2), (1, "geo", "new york", 7, 2), (1, "paper", "new york times", 0, 3), (1, "place", "times square", 2, 2), (4, "x", "a b", 0, 2), (4, "x", "a b", 3, 2), (4, "x", "b c", 1, 2)]
    assert C.listed_phrases(docs, "id", "text", terms.limit(0)).count() == 0


@pytest.mark.parametrize("size,block", [(1, 4), (3, 2), (7, 1024), (1000, 1024)])
def test_any_cut_of_the_bytes_gives_the_same_lines(spark, size, block):
    streams = {"a": "one\n\n  é☀ two \r\nthree\nhalf".encode(), "b": b"\xffx\ny\n", "c": b"", "d": b"no end", "e": b"\n\n", "f": ("z" * 400 + "\nlast\n").encode()}
    cut = [(k, n, bytearray(b[at : at + size])) for k, b in streams.items() for n, at in enumerate(range(0, max(len(b), 1), size))] + [("g", 0, None)]
    chunks = spark.createDataFrame(cut, "key string, chunk int, bytes binary")
    got = sorted(tuple(r) for r in lines_of_chunks(chunks, block).collect())
    want = [(k, i, s) for k, b in streams.items() for i, line in enumerate(b.decode("utf-8", "replace").split("\n")[:-1]) if (s := line.strip())]
    assert got == sorted(want)


def test_extras_of_any_type(spark):
    said = [(1, '{"a":1,"b":"x","c":null,"d":[1,"y"],"e":{"f":true},"g":1.5}'), (2, "{"), (3, None), (4, '{"a":1,"a":2}'), (5, "[1]"), (6, "{}"), (7, "null"), (8, "")]
    good, bad = Y.parsed(spark.createDataFrame(said, "id int, extras string"), "extras")
    assert {r["id"] for r in bad.collect()} == {2, 4, 8} and {r["id"] for r in good.collect()} == {1, 3, 5, 6, 7}
    got = {(r["name"], r["kind"], r["value"]) for r in Y.entries(good, "id", "extras").filter("name is not null").collect()}
    assert got == {("a", "BIGINT", "1"), ("b", "STRING", "x"), ("c", "VOID", None), ("d", "ARRAY", '[1,"y"]'), ("e", "OBJECT", '{"f":true}'), ("g", "DECIMAL", "1.5")}
    assert Y.entries(good, "id", "extras").filter("id <> 1").count() == 0
