import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, chat_format, common, decontaminate, exact_dedup, license_scan, near_dup, piece_fst, sstable, token_counts, token_shards, toxicity, url_filter
from millrace.llm.components import components
from tests.helpers import SF, same_as_sql

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, key string, n int"
LONG = "word " * 40_000
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "a b"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "A b  c D e f"), (9, LONG), (10, LONG + "end"), (11, "漢字 😀 ñ")]


def edge(spark, rows=EDGE):
    return spark.createDataFrame([(i, t, "en", "s", None, 1, "k", 3) for i, t in rows], DOCS)


def test_registered_oracles(spark):
    from millrace.llm import registry

    for name, sql in registry.ORACLES.items():
        same_as_sql(registry.QUERIES[name](spark, SF), sql)


# 1, 5: token ids


def test_byte_bpe_equals_library():
    e = byte_bpe.encoder()
    rng, alphabet = random.Random(1), "ab Z'\n\t  é1_.,!<|endoftext|>  'sñ漢😀\r\x1c\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [t for _, t in EDGE if t]
    for t in texts:
        assert np.frombuffer(e.ids(t), e.dtype).tolist() == e.library.encode(t, add_special_tokens=False).ids, t


def test_token_counts(spark):
    docs = edge(spark)
    h = token_counts.with_suffix_sums(token_counts.length_histogram(docs))
    e = byte_bpe.encoder()
    n = [len(e.ids(t or "")) // 2 for _, t in EDGE]
    got = {r["n_tokens"]: tuple(r)[1:] for r in h.collect()}
    assert got == {k: (c, sum(x >= k for x in n), sum(x for x in n if x >= k), sum(min(x, k) for x in n)) for k, c in Counter(n).items()}
    for limits in ([0], [1, 3, 7, 39_999, 50_000]):
        assert [tuple(r) for r in token_counts.totals(h, limits).collect()] == [(k, sum(x > k for x in n), sum(min(x, k) for x in n), sum(max(0, x - k) for x in n)) for k in limits]
    assert [tuple(r) for r in token_counts.totals(h, [4]).collect()] == [(4, sum(x > 4 for x in n), sum(min(x, 4) for x in n), sum(max(0, x - 4) for x in n))]
    assert [r["n_tokens"] for r in token_counts.quantiles(h, [0.5, 1.0]).collect()] == [sorted(n)[len(n) // 2 - 1], max(n)]
    empty = token_counts.length_histogram(docs.limit(0))
    assert token_counts.with_suffix_sums(empty).count() == 0
    assert token_counts.quantiles(token_counts.with_suffix_sums(empty), [0.5]).first()["n_tokens"] is None


def test_token_shards(spark):
    folder = common.shared_path(spark, "t")
    manifest = token_shards.write_shards(edge(spark), folder)
    got = sorted((r for r in token_shards.read_shards(manifest, folder).collect()), key=lambda r: r["start"])
    e, start = byte_bpe.encoder(), 0
    for r, (i, t) in zip(got, sorted(EDGE, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), strict=True):
        ids = [*np.frombuffer(e.ids(t or ""), e.dtype).tolist(), 0]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    look = token_shards.Lookup(manifest, folder)
    assert len(look.get(7)) == 2 and look.get(6) == [] and look.get(None) and look.get(2) == [[0]]
    empty = token_shards.write_shards(edge(spark).limit(0), folder)
    assert token_shards.read_shards(empty, folder).count() == 0


def test_sstable(tmp_path):
    from pyarrow import fs

    keys = sorted(random.Random(3).sample(range(-(10**6), 10**6), 5000))
    store, path = fs.LocalFileSystem(), str(tmp_path / "t.sst")
    with store.open_output_stream(path) as out:
        w = sstable.Writer(out, 2, block_bytes=2000)
        for k in keys:
            w.add(sstable.key_of(k), str(k).encode().ljust(8))
        w.close()
    with store.open_input_file(path) as f:
        r = sstable.Reader(f)
        assert [sstable.id_of(k) for k, _ in r] == keys
        assert all(r.get(sstable.key_of(k)) == [str(k).encode().ljust(8)] for k in keys[::97])
        others = [k for k in range(10**6, 10**6 + 2000)]
        assert sum(r.may_have(sstable.key_of(k)) for k in others) < 80 and r.get(sstable.key_of(10**6)) == []
    raw = bytearray((tmp_path / "t.sst").read_bytes())
    raw[100] ^= 1
    (tmp_path / "t.sst").write_bytes(raw)
    with store.open_input_file(path) as f, pytest.raises(ValueError):
        list(sstable.Reader(f))


# 2: pieces


def test_pieces_equal_library(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(piece_fst.MODEL)
    sp, c = sentencepiece.SentencePieceProcessor(model_file=path), piece_fst.Codec(piece_fst.compile_model(path))
    rng, alphabet = random.Random(2), "abe Z'\n\t  é1_.,! ▁ 'sñ漢😀\rthe in er"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [" " * k + w for k in range(40) for w in ("", "a", "\n")] + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts:
        ids = np.frombuffer(c.encode(t), c.dtype).tolist()
        assert ids == sp.encode(t) and c.decode(c.encode(t)) == t.replace("▁", " ")


def test_piece_columns(spark):
    out = piece_fst.decode(piece_fst.encode(edge(spark).withColumn("piece_ids", F.lit("clash")))).collect()
    assert [r["decoded"] for r in out] == [t or "" for _, t in EDGE]
    assert piece_fst.digest(edge(spark).limit(0)).count() == 0


# 3: toxicity


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"  # with 97 held-out toxic rows
    docs, labels = common.documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).join(labels, "doc_id").select("doc_id", "score", "toxic").collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(0 <= r["score"] <= 1 for r in got)
    pos, neg = ([r["score"] for r in held if r["toxic"] == y] for y in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg]) > 0.9
    assert sum(x >= 0.5 for x in pos) >= 0.8 * len(pos) and sum(x >= 0.5 for x in neg) <= 0.01 * len(neg)


def test_restoring(spark):
    docs = spark.createDataFrame([(1, "you idiot stupid loser worthless moron " * 50)], "doc_id long, text string")
    fix = toxicity.Restorer(toxicity.ngram_costs(toxicity.ngram_counts(docs)))
    for hidden, word in (("1d10t", "idiot"), ("5tup1d", "stupid"), ("i.d.i.o.t", "idiot"), ("l0$er", "loser"), ("stuuuupid", "stupid"), ("w0rthless!", "worthless")):
        assert word in fix.words(hidden)
    assert fix.words("plain,") == ["plain"] and fix.words("108.51.2.1") == []
    assert fix.spaced("such i d i o t.") == ["idiot"]


def test_toxicity_edges(spark):
    no = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.scored(edge(spark), toxicity.train(edge(spark), no)).collect()} == {0.0}
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(edge(spark).withColumn("score", F.lit(9)), labels).columns[-1] == "score"
    assert toxicity.scored(edge(spark).limit(0), toxicity.train(edge(spark).limit(0), labels)).count() == 0


# 4: urls


def test_urls(spark):
    rows = [(1, None), (2, "x"), (3, "http://A.Example.com/en/x?y"), (4, "http://www.example.com/en/"), (5, "http://example.com/en"), (6, "http://notexample.com/en/"), (7, "http://a.net/fr/#"), (8, "http://a.net"), (9, "http://example.com.evil.org/en/"), (9, "http://x.com/?q=a://b"), (None, "://"), (11, "http://com/")]
    pages = spark.createDataFrame([(*r, "e", "e") for r in rows], "page_id long, url string, host string, rule string")
    rules = url_filter.RULES + [("org", "", "block"), ("b.net", "/fr", "allow"), ("net", "/es/", "allow")]

    def brute(url):
        h, p = url_filter.split_url(url)
        fits = [r for r in rules if (h == r[0] or h.endswith("." + r[0])) and p.startswith(r[1])] if h else []
        best = max(fits, key=lambda r: (r[0].count("."), len(r[1]), r[2] == "block"), default=None)
        return (h, p, best and best[0] + best[1], best[2] if best else "allow")

    want = sorted(repr((i, *brute(u))) for i, u in rows)
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")
    for out in (url_filter.judge_urls(pages, rules), url_filter.judge_urls_by_join(pages, table)):
        assert sorted(repr(tuple(r)) for r in out.collect()) == want
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


# 6: licences


def test_license_inheritance(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "code"), ("a/b/c/y.py", "# Licensed under the Apache License, Version 2.0.\n" + "code words here " * 20), ("d/z.py", "code"), ("a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("a/b/c/w.py", None), (None, "x"), ("top.py", ""), ("a/b/x.py", "code")]
    df = spark.createDataFrame([(*f, "clash") for f in files], "path string, text string, license string")
    got = Counter((r["path"], r["license"], r["origin"], r["from_dir"]) for r in license_scan.scan(df, F.col("path")).collect())
    assert got == Counter({
        ("a/LICENSE", "MIT", "own", None): 1, ("a/b/x.py", "MIT", "inherited", "a"): 2, ("a/b/c/y.py", "Apache-2.0", "own", None): 1, ("d/z.py", None, "none", None): 1,
        ("a/b/c/COPYING", "GPL-3.0-only", "own", None): 1, ("a/b/c/w.py", "GPL-3.0-only", "inherited", "a/b/c"): 1, (None, None, "none", None): 1, ("top.py", None, "none", None): 1,
    })
    assert license_scan.scan(df.limit(0), F.col("path")).count() == 0


# 7: exact copies


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_dedup(spark, digest):
    got = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.duplicate_groups(edge(spark), digest=digest).collect()), key=repr)
    norm, want = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or ""), []
    for i, t in EDGE:
        group = [(j, u) for j, u in EDGE if norm(u) == norm(t)]
        keep = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))[0]
        want.append((i, keep, len(group)))
    assert sorted((x[:3] for x in got), key=repr) == sorted(want, key=repr)
    assert sum(x[3] for x in got) == len({norm(t) for _, t in EDGE})
    assert exact_dedup.drop_duplicates(edge(spark)).columns == edge(spark).columns
    assert exact_dedup.duplicate_groups(edge(spark).limit(0)).count() == 0


def test_exact_dedup_goes_on(spark):
    state = common.shared_path(spark, "state")
    one = exact_dedup.saved(exact_dedup.with_row_key(edge(spark)).select("_mr_file", "_mr_row", F.col("doc_id").alias("id"), F.lit(1).alias("n_chars"), F.lit("x").alias("digest")), "a")
    exact_dedup.seen_state(one._millrace_path, one, state)
    one.limit(1).write.mode("append").parquet(one._millrace_path)
    assert [(r["digest"], r["n"]) for r in exact_dedup.seen_state(one._millrace_path, one, state).collect()] == [("x", len(EDGE) + 1)]


# 8: preferences


def test_preferences(spark):
    said = "pair_id long, turn long, role string, text string, part string"
    c = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "good", ""), (1, 1, "assistant", "good", ""), (2, 0, "user", "q", ""), (3, 0, None, None, ""), (None, 0, "user", "x", "")], said)
    r = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "bad", ""), (2, 0, "user", "q", "")], said)
    got = sorted(tuple(x) for x in chat_format.preference_rows(c, r).select("pair_id", "part", "turn", "rendered", "n_masked", "trained").collect())
    turn = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    q = turn("user", "q")
    assert got == [(1, "chosen", 1, turn("assistant", "good"), 14, True), (1, "prompt", 0, q, len(q), False), (1, "rejected", 1, turn("assistant", "bad"), 14, True), (2, "prompt", 0, q, len(q), False), (3, "chosen", 0, turn("", ""), len(turn("", "")), False)]
    assert chat_format.preference_rows(c.limit(0), r.limit(0)).count() == 0


# 9: benchmark passages


def test_contained_items(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = edge(spark, EDGE + [(20, "x " * 5000 + item.upper() + " y" * 5000), (21, " ".join(item.split()[:24])), (22, " ".join(item.split()[:26])), (None, item)])
    items = spark.createDataFrame([(1, item, "a"), (2, "A, b!", "a"), (3, None, "a"), (4, "...", "a"), (2, "zz", "a")], "item_id long, text string, doc_id string")
    got = sorted(((r["id"], r["item_id"]) for r in decontaminate.contained_items(docs, items).collect()), key=repr)
    assert got == sorted([(20, 1), (22, 1), (None, 1), (5, 2)], key=repr)  # 22 of 26 shingles are enough, 20 aren't
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0


# 10: near copies


def brute_components(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({65 + i: 97 + i for i in range(26)}))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and den * both >= num * len(sets[a] | sets[b]) and top(a) != top(b):
                up[max(top(a), top(b))] = min(top(a), top(b))
    groups = {}
    for a in range(len(rows)):
        groups.setdefault(top(a), []).append(a)
    return [(rows[a][0], len(sets[a]), min((rows[x][0] for x in groups[top(a)] if rows[x][0] is not None), default=None)) for a in range(len(rows))]


@pytest.mark.parametrize("k, num, den", [(3, 17, 20), (5, 4, 5)])
def test_near_duplicates(spark, k, num, den):
    rng = random.Random(5)
    rows, at = list(EDGE), 100
    for _ in range(25):  # chains of edits, and texts that share most but not enough
        words = [f"v{rng.randint(0, 5000)}" for _ in range(rng.choice((6, 20, 120)))]
        for _ in range(rng.randint(1, 8)):
            rows.append((at, " ".join(words)))
            at += 1
            for _ in range(max(1, int(len(words) * rng.choice((0.005, 0.02, 0.06))))):
                words[rng.randrange(len(words))] = f"v{rng.randint(0, 5000)}"
    got = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(edge(spark, rows), n_words=k, similarity=(num, den)).collect()), key=repr)
    assert got == sorted(brute_components(rows, k, num, den), key=repr)
    assert near_dup.near_duplicates(edge(spark).limit(0)).count() == 0


def test_chunk_keys_guarantee():
    rng, threshold = np.random.default_rng(1), near_dup.distance_threshold(0.85)
    a = rng.integers(0, 1 << 16, (200, near_dup.N_SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for r in b:
        r[rng.choice(near_dup.N_SYMBOLS, threshold, replace=False)] ^= 1
    x, y = near_dup.chunk_keys(a, threshold), near_dup.chunk_keys(b, threshold)
    assert all(np.intersect1d(p, q).size for p, q in zip(x, y, strict=True))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# the pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    docs, sf = common.documents(spark, SF), SF
    out = p.run(spark, sf).collect()
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(r["doc_id"], r["text"]) for r in toxicity.scored(docs, model).filter("score < 0.5").collect()]
    best = {}
    for i, t in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[n] = min(best.get(n, (0, i, "")), (-len(t or ""), i, t or ""))
    rows = sorted((i, t) for _, i, t in best.values())
    rows = [(i, t) for (i, t), (_, n, c) in zip(rows, brute_components(rows, 5, 4, 5), strict=True) if not n or i == c]
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    items = [grams(words(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(5 * len(g & grams(words(t))) >= 4 * len(g) for g in items)]
    assert sorted(r["doc_id"] for r in out) == [i for i, _ in rows]
    assert out[0].__fields__ == [*docs.columns, "piece_ids"]


def test_token_ids_are_written_to_their_shards_only(spark, monkeypatch):
    tags, saved = [], token_shards.saved
    monkeypatch.setattr(token_shards, "saved", lambda df, tag, **more: (tags.append(tag), saved(df, tag, **more))[1])
    folder = common.shared_path(spark, "shards")
    manifest = token_shards.write_shards(edge(spark), folder)
    assert tags == ["manifest"] and token_shards.read_shards(manifest, folder).count() == edge(spark).count()
