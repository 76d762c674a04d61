"""The byte automaton and the fill-in-middle transformation, held against regular expressions and SQL."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import fill_middle
from tests.helpers import SF, same_as_sql

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SOME = ["a", "<", "P", ">", "S", "M", " ", "\n", "\t", "é", "漢", "😀", "<P>", "<<S>", "\x0b", "\x1c", "\xa0"]


def scanned(raw):
    return fill_middle.Scan(np.frombuffer(b"".join(raw) or b"\0", np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw], dtype=np.int64)]))


def test_state_depends_on_three_bytes_at_most():
    assert fill_middle.compile_table()[2] == 3


def test_scan_and_cuts_equal_regular_expressions():
    rng = random.Random(12)
    texts = ["".join(rng.choice(SOME) for _ in range(rng.choice([0, 1, 5, 40, 700, 3000]))) for _ in range(300)]
    scan = scanned([t.encode() for t in texts])
    assert (scan.per_text(scan.units) + [bool(t) for t in texts]).tolist() == [len(UNITS.findall(t)) for t in texts]
    assert scan.per_text(scan.points).tolist() == [len(t) for t in texts]
    assert scan.per_text(scan.sentinels).tolist() == [len(re.findall("<[PSM]>", t)) for t in texts]
    for i, t in enumerate(texts):
        if len(u := UNITS.findall(t)) > 1:
            ends = np.arange(1, len(u))
            byte, char = scan.cuts(np.full(len(ends), i), ends)
            assert byte.tolist() == np.cumsum([len(x.encode()) for x in u])[:-1].tolist()
            assert char.tolist() == np.cumsum([len(x) for x in u])[:-1].tolist()


def test_bytes_that_are_no_text():
    raw = [b"\xff a", b"\xe6\xbc a", b"\x80\x80", b"\xf0\x9f\x98\x80\x80 \xe6<P>", b""]
    scan = scanned(raw)
    assert scan.per_text(scan.points).tolist() == [3, 3, 2, 7, 0]  # a broken or stray sequence is one code point, begun once
    assert scan.per_text(scan.sentinels).tolist() == [0, 0, 0, 1, 0]


def expected(i, text, share=50, spm=80):
    text = text or ""
    u = UNITS.findall(text)
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= share:
        return i, len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    return (i, len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (i, len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_transformation_equals_brute_force_and_comes_back(spark):
    rng = random.Random(5)
    rows = [(None, "a null id"), (1, None), (2, ""), (3, " \n\t"), (7, "twice the same"), (7, "twice the same"), (8, "x" * 300_000), (9, "漢字 😀 " * 60_000), (-5, " lead and trail \n")]
    rows += [(k, "".join(rng.choice(SOME[:-5] if k % 3 else SOME) for _ in range(rng.choice([1, 6, 60, 1500])))) for k in range(10, 400)]
    docs = spark.createDataFrame([(i, t, "x", "y", 5) for i, t in rows], "doc_id long, text string, form string, output string, n int")
    for share, spm in ((50, 80), (100, 0), (0, 50)):
        out = fill_middle.fill_middle(docs, share=share, spm=spm)
        got = sorted(map(tuple, out.collect()), key=repr)
        assert got == sorted((expected(i, t, share, spm) for i, t in rows), key=repr)
        back = sorted(r[0] for r in out.select(fill_middle.restored(F.col("output"), F.col("form"))).collect())
        assert back == sorted(t or "" for _, t in rows)
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0


def test_query_equals_sql(spark):
    for d in (SF, SF.replace("0.001", "0.01")):
        same_as_sql(fill_middle.op12_fill_middle(spark, d), fill_middle.ORACLE, d)
