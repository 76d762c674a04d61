"""The two operators that decode lattices, against enumeration of all paths and against the library."""

import random
import struct
import time
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from millrace.llm import piece_fst, toxicity
from tests.helpers import SF
from tests.llm.test_llm import EDGE

PLAIN = "you asshole shit idiot stupid loser worthless moron the words of a plain text are here " * 50
N = toxicity.N_CLASSES


@pytest.fixture(scope="module")
def costs(spark):
    return toxicity.ngram_costs(toxicity.ngram_counts(spark.createDataFrame([(1, PLAIN)], "doc_id long, text string")))


def path_cost(letters, own, costs):
    total, state = own, 0
    for c in [*letters, " "]:
        total += costs[state * N + toxicity.letter_class(c)]
        state = (state * N + toxicity.letter_class(c)) % N**3
    return total


def test_ngram_counts(spark):
    texts = ["Été, ça!", "", None, "x" * 3, "日本 ab"]
    got = toxicity.ngram_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros(N**4, int)
    for t in texts:
        c = [0, 0, 0, *map(toxicity.letter_class, t or ""), 0, 0, 0]
        for k in range(len(c) - 3):
            want[((c[k] * N + c[k + 1]) * N + c[k + 2]) * N + c[k + 3]] += 1
    inside = np.arange(N**4) % N != 0  # how many follow a text's end depends on what stands between texts
    assert (got[inside] == want[inside]).all()


def test_viterbi_is_the_least_of_all_paths(costs):
    rng = random.Random(4)
    for _ in range(400):
        token = "".join(rng.choice("ai1!|$0.-éz%日") * rng.choice((1, 1, 1, 2, 3, 5)) for _ in range(rng.randint(1, 6)))
        steps = toxicity.lattice(token)
        least = min(path_cost("".join(x for x, _, _ in way), sum(c for _, _, c in way), costs) for way in product(*steps))
        found = toxicity.restored(token, costs)
        own = min(sum(c for _, _, c in way) for way in product(*steps) if "".join(x for x, _, _ in way) == found)
        assert path_cost(found, own, costs) == pytest.approx(least, abs=1e-4)


def test_heavy_disguises(costs):
    fix = toxicity.Restorer(costs)
    for hidden, word in (("455h0l3", "asshole"), ("5h17", "shit"), ("@$$h0l3", "asshole"), ("1d!07", "idiot"), ("1_d_1_0_t", "idiot"), ("1*d*1*0*t", "idiot"), ("....".join("worthless"), "worthless"), ("$h!t", "shit"), ("$tup!d", "stupid"), ("iiiidiooooot", "idiot")):
        assert word in fix.words(hidden), (hidden, fix.words(hidden))


@pytest.mark.parametrize("unit", ["a", "1", "a1", "12", ".", "1.", "漢", "a."])
def test_long_tokens_take_linear_time(costs, unit):
    took = []
    for n in (50_000, 200_000):
        began = time.process_time()
        toxicity.restored(unit * (n // len(unit)), costs)
        took.append(time.process_time() - began)
    assert took[1] < 12 and took[1] < 8 * max(took[0], 0.02)


def number(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes((*out, n))


def message(*fields):
    out = b""
    for k, v in fields:
        if isinstance(v, float):
            out += number(k << 3 | 5) + struct.pack("<f", v)
        elif isinstance(v, int):
            out += number(k << 3) + number(v)
        else:
            out += number(k << 3 | 2) + number(len(v)) + v
    return out


def written(kind, words, fallback, rules=b"", single=0):
    """A model file by hand; nothing is trained."""
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    listed += [(p, x, 1) for p, x in words.items()]
    pieces = [(1, message((1, p.encode()), (2, x), (3, t))) for p, x, t in listed]
    return message(*pieces, (2, message((3, kind), (35, int(fallback)))), (3, message((1, b"own"), (2, rules), (3, 1), (4, single), (5, 1))))


WORDS = {"▁": -2.5, "a": -3.25, "b": -3.5, "ab": -4.0, "▁a": -3.125, "▁ab": -5.75, "ba": -5.0, "abab": -7.5, "c": -6.0, "ca": -6.5, "▁▁": -4.25, "é": -9.0, "x": -4.125, "xx": -7.0, "xxx": -10.25}


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("rules", ["", "nfkc"])
def test_unigram_models_equal_the_library(fallback, rules):
    charsmap = b""
    if rules:
        spec = sentencepiece.SentencePieceNormalizer(rule_name=rules).serialized_model_proto()
        charsmap = dict(piece_fst._fields(dict(piece_fst._fields(spec))[3]))[2]
    raw = written(1, WORDS, fallback, charsmap, single=int(bool(rules)))
    library, own = sentencepiece.SentencePieceProcessor(model_proto=raw), piece_fst.Codec(piece_fst.compile_proto(raw))
    rng = random.Random(6)
    texts = ["".join(rng.choice("aabbcx  é漢\n" + "ａéﬁ①　 " * bool(rules)) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + [t for _, t in EDGE if t and len(t) < 99]
    for t in texts:
        assert np.frombuffer(own.encode(t), own.dtype).tolist() == library.encode(t), t


def test_shortest_path_is_the_least_of_all():
    own = piece_fst.Codec(piece_fst.compile_proto(written(1, WORDS, True)))
    rng = random.Random(7)

    def ways(text):
        if not text:
            yield 0.0, []
        for p, x in WORDS.items():
            if text.startswith(p):
                for rest, ids in ways(text[len(p) :]):
                    yield rest - x, [own.t.pieces.index(p), *ids]

    for _ in range(200):
        text = "▁" + "".join(rng.choice("abxc") for _ in range(rng.randint(1, 9)))
        ids = np.frombuffer(own.path(text), own.dtype).tolist()
        assert sum(own.t.weight[i] for i in ids) == pytest.approx(min(ways(text))[0])


def test_model_kinds_that_are_not_compiled():
    with pytest.raises(ValueError):
        piece_fst.compile_proto(written(3, WORDS, True))


MERGES = [["a", "b", "ab", "ba", "aa", "aab", "baba", "▁a"], ["b", "ab", "abab", "bb", "ba", "▁▁"], ["a", "aa", "aaa", "aaaa", "b", "aab"]]


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("ties", [1, 2, 9])
@pytest.mark.parametrize("pieces", MERGES)
def test_bpe_models_equal_the_library(pieces, ties, fallback):
    """Pieces of other orders, of one score, and of characters that are none."""
    rng = random.Random(8)
    for _ in range(6):
        raw = written(2, {p: -1.0 - k // ties for k, p in enumerate(pieces)}, fallback)
        library, own = sentencepiece.SentencePieceProcessor(model_proto=raw), piece_fst.Codec(piece_fst.compile_proto(raw))
        for _ in range(100):
            text = "".join(rng.choice("aaabbb c") for _ in range(rng.randint(0, 25)))
            assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(text), (text, pieces)
        rng.shuffle(pieces := list(pieces))


class Asked(dict):
    n = 0

    def __missing__(self, key):
        self.n += 1
        return self.of._adjacent(*key)


def test_few_states_of_the_lattice_are_met(spark):
    """CPU is spent by piece of the result, not by arc of the lattice."""
    own = piece_fst.Codec(piece_fst.compile_model(public_tokenizers.path(piece_fst.MODEL)))
    own.pairs = Asked()  # remembers nothing
    own.pairs.of = own
    words = {w for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for w in (r["text"] or "").split()}
    n = sum(len(own.path("▁" + w)) // own.dtype.itemsize for w in sorted(words))
    assert n > 5000 and own.pairs.n < 1.5 * n


@pytest.mark.parametrize("unit", ["a", "ab", "the", "thein", "漢", "é1", "\u0378"])
def test_long_words_take_linear_time(unit):
    own, took = piece_fst.Codec(piece_fst.compile_model(public_tokenizers.path(piece_fst.MODEL))), []
    for n in (50_000, 200_000):
        began = time.process_time()
        assert own.decode(own.encode(unit * n)) == unit * n
        took.append(time.process_time() - began)
    assert took[1] < 8 * max(took[0], 0.05)
