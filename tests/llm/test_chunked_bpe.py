"""Overlapping chunk encoding, held against the tokenizer library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from millrace.llm import chunked_bpe
from tests.helpers import SF

KINDS = "doc_id long, text string, id string, ids int, k int"


@pytest.fixture(scope="module")
def library():
    import base64

    with open(public_tokenizers.path(chunked_bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(13)
    some = ["a", "b", "'s", "'re", "'", " ", "  ", "\n", "\n\n", "\t", "1", "23", "!", "é", "漢", "😀", "'ll", "\r\n", "\xa0", "<|endoftext|>", "word ", " the"]
    out = [None, "", " ", "\n \n", "a", "x" * 5000, " " * 3000, "'" * 1000 + "s" * 900, "a's" * 400, "\n" * 700 + "x", "!" * 300 + "'re" * 300, "1" * 64 + "a" * 64, "漢字" * 600]
    return out + ["".join(rng.choice(some) for _ in range(rng.choice([3, 60, 64, 65, 200, 1000]))) for _ in range(150)] + ["".join(rng.choice(some) * rng.randint(1, 40) for _ in range(60)) for _ in range(60)]


@pytest.mark.parametrize(("size", "overlap"), [(64, 16), (40, 40), (200, 8), (chunked_bpe.CHUNK, chunked_bpe.OVERLAP)])
def test_chunks_equal_library(spark, library, size, overlap):
    said = texts()
    rows = [(k % 50 if k % 7 else None, t, "x", 1, 2) for k, t in enumerate(said)] + [(3, "twice " * 30, "x", 1, 2)] * 2
    got = chunked_bpe.encode(spark.createDataFrame(rows, KINDS), size=size, overlap=overlap).collect()
    want = [(i, library.encode_ordinary(t or "")) for i, t, *_ in rows]
    assert sorted(((r["id"], r["ids"]) for r in got), key=repr) == sorted(want, key=repr)


def test_one_pre_token_is_one_chunk(spark, library):
    """A run longer than many overlaps between others; only its chunks are joined."""
    text = "some words " * 50 + "z" * 4000 + " and more" * 100
    docs = chunked_bpe.with_row_key(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    raw = docs.selectExpr(*chunked_bpe.ROW_KEY, "doc_id id", "cast(text as binary) text")
    parts = chunked_bpe.stitched(chunked_bpe.saved(chunked_bpe.chunks(raw, 100, 20), "c"), overlap=20).collect()
    assert len(parts) < 22 and max(len(r["body"]) for r in parts) >= 4000
    assert sorted(len(r["body"]) for r in parts)[-2] <= 200


def test_decoding_and_edges(spark, library):
    rows = [(1, "漢字 😀 ñ"), (2, None), (3, "a  b\n")]
    encoded = chunked_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["id"]: bytes(r["decoded"]).decode() for r in chunked_bpe.decode(encoded).collect()} == {i: t or "" for i, t in rows}
    assert chunked_bpe.digest(chunked_bpe.encode(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
    with pytest.raises(ValueError):
        chunked_bpe.encode(encoded, "id", "ids", size=10, overlap=20)


def test_query_equals_library(spark, library):
    for d in (SF, SF.replace("0.001", "0.01")):
        got = {r["doc_id"]: tuple(r)[1:] for r in chunked_bpe.op13_byte_bpe(spark, d).collect()}
        docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
        assert len(got) == len(docs)
        for i, t in docs:
            ids = library.encode_ordinary(t or "")
            assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
