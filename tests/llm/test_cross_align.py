"""Groups and links of two tokenizers, held against whole texts by both libraries and all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from millrace.llm import cross_align
from tests.helpers import SF

KINDS = "doc_id long, text string, block long, said string, n int"


class Both(cross_align.Surfaces):
    """And the library that the vocabulary is a file of."""

    def __init__(self):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(public_tokenizers.path(cross_align.VOCAB))
        self.library.encode_special_tokens = True


@pytest.fixture(scope="module")
def both():
    return Both()


def spans(ids, surface):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(surface[i])))
        at = out[-1][2]
    return out


def brute(both, rows):
    """rows: (id, text). The contract's columns for each row, from byte ranges alone."""
    read, count = [], Counter()
    for i, text in rows:
        a = b = []
        if text:
            raw = (" " + text).encode()
            a, b = both.library.encode(" " + text, add_special_tokens=False).ids, both.pieces.encode(text)
            if any(b"".join(s[x] for x in ids) != raw for ids, s in ((a, both.a), (b, both.b))):
                a = b = []
        a, b = spans(a, both.a), spans(b, both.b)
        found, at = [], 0
        for x, low, high in a:
            while at < len(b) and b[at][2] <= low:
                at += 1
            k = at
            while k < len(b) and b[k][1] < high:
                found.append((x, b[k][0]))
                k += 1
        cuts, groups, ga, gb = {e for *_, e in a} & {e for *_, e in b}, [], 0, 0
        for e in sorted(cuts):
            na, nb = sum(x[2] <= e for x in a[ga : ga + 5000]), sum(x[2] <= e for x in b[gb : gb + 5000])
            groups.append(",".join(str(x[0]) for x in a[ga : ga + na]) + "|" + ",".join(str(x[0]) for x in b[gb : gb + nb]))
            ga, gb = ga + na, gb + nb
        count.update(found)
        read.append((i, len(a), len(b), len(groups), found, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((i, na, nb, ng, len(f), sum(count[x] == most[x[1]] for x in f), sum(count[x] for x in f), d) for i, na, nb, ng, f, d in read), key=repr)


def aligned(df):
    cols = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in cross_align.aligned(df).collect()), key=repr)


def texts():
    rng = random.Random(11)
    some = ["a", "the ", " and", "'s", " ", "  ", "\n", "\t", "1", "23", "!", "é", "漢", "😀", "ñandú", "<|endoftext|>", "<s>", "\xa0", "\x1c", " ", "\r\n", "<0x0A>"]
    out = [None, "", " ", "\n", "  x", "x ", "a▁b", "▁", "plain words here", "　", "\x00", "é", "ﬁ", "x" * 3000, "漢字" * 500, "﻿z", "a​b"]
    return out + ["".join(rng.choice(some) for _ in range(rng.choice([2, 5, 30, 120]))) for _ in range(300)] + ["twice the same"] * 3


def test_all_pairs_of_tokens(spark, both):
    rows = [(k % 40 if k % 5 else None, t) for k, t in enumerate(texts())]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], KINDS)
    assert aligned(df.repartition(3)) == brute(both, rows)


def test_segments_and_blocks_equal_whole_texts(monkeypatch):
    """Segments have the groups of the whole text, and blocks their frequencies, however small both are."""
    of, said = cross_align.Aligner(), [t for t in texts() if t and " x y z " * 3 not in t] + ["some words of a text, that goes on " * 90, "a line\nand\nlines of 漢字\n\n  x  y z " * 30]
    whole = {t: list(of.read(t)) for t in said}
    assert all(len(x) < 2 for x in whole.values())
    monkeypatch.setattr(cross_align, "SEGMENT", 40)
    monkeypatch.setattr(cross_align, "BLOCK_GROUPS", 50)
    block, freq, n_blocks = cross_align.Block(), Counter(), 0
    for t in said:
        parts = list(of.read(t))
        assert ";".join(parts) == "".join(whole[t])
        for x in parts:
            block.add((1, 1, 1), None, x.split(";"))
            if block.full() or t == said[-1]:
                n_blocks += 1
                for b in block.rows(n_blocks):
                    freq.update({g: n for g, n in zip(*(b.column(c).to_pylist() for c in ("said", "freq")), strict=True) if g})
                block = cross_align.Block()
    assert n_blocks > 20 and freq == Counter(g for t in said if whole[t] for g in whole[t][0].split(";"))


def test_ids_are_those_of_the_vocabulary_file(spark, both):
    of = cross_align.Aligner()
    words = {w for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("text").collect() for w in r["text"].split()}
    every = [chr(x) for k in (range(0xD800), range(0xE000, 0x20000)) for x in k]
    for t in [*words, *(f"a{c}e 1{c}2 !{c}? {c} {c}{c}  {c}\n" for c in every)]:
        assert of.library.encode_ordinary(" " + t) == both.library.encode(" " + t, add_special_tokens=False).ids, t


def test_long_texts_and_empty_table(spark, both):
    rows = [(1, "word 漢字 and more, " * 90_000), (2, "word"), (3, "x" * 60_000), (4, "long " * 300_000 + "▁")]
    got = aligned(spark.createDataFrame(rows, "doc_id long, text string"))
    a, b = both.library.encode(" " + rows[0][1], add_special_tokens=False).ids, both.pieces.encode(rows[0][1])
    assert got[0][:3] == (1, len(a), len(b)) and got[3] == (4, 0, 0, 0, 0, 0, 0, "")
    unit = list(cross_align.Aligner().read("word 漢字 and more, " * 2))[0].split(";")
    n = (len(unit) - 1) // 2  # groups of one round; the last one is the space that ends the text
    assert got[0][7] == hashlib.sha256(";".join(unit[:n] * 90_000 + unit[-1:]).encode()).hexdigest()
    assert cross_align.aligned(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_all_pairs(spark, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted((tuple(r[c] for c in cols) for r in cross_align.op11_cross_align(spark, SF).collect()), key=repr)
    assert got == brute(both, rows)
