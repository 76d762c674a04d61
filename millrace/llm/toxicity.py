"""Toxicity: a noisy channel is undone by Viterbi decoding, and the restored text is scored.

1. Language model: counts of four characters in a row (26 letters, with or without a mark; any other letter;
   none) over all texts of the table, summed by Spark. A letter's cost after three others comes from these
   counts, smoothed by those of three, two and one.
2. Restoring: every token that holds a letter and anything else, or a letter three times in a row, becomes a
   lattice, whatever its length or share of letters: each character can stand for itself, for letters it looks
   like, or for nothing (a separator, a sign that looks like no letter); a run of three or more of one
   character stands for one or two of what it stands for. So do tokens of look-alikes without a letter if
   there is one among them that isn't a digit, and single characters apart by spaces. The path of least cost
   under channel and language model is the restored word. The lattice has one step per character or run and at
   most N_CLASSES ** 3 states a step, so that time is linear in the token's length.
3. Scoring: words and their first 4 to 7 letters are features, hashed to N_BUCKETS. Documents are counted by feature
   and class over all labelled rows that aren't held out; features whose log odds are more than MARGIN standard
   errors from 0, of either sign, take part in a logistic regression, fitted with a quadratic penalty on the driver, on
   at most FIT_ROWS of the labelled rows, drawn by a hash of their identifier. The score of a document is that of all its
   distinct features, in the restored text.

But for that fit nothing is sampled or cut: whole texts are read, in training and scoring. Weights are one number a bucket
at most: 16 MB in each worker, whatever the input; the fit takes the features of FIT_ROWS documents to the driver.

Null, empty and wordless texts have no features and get the regression's offset. Repeated documents get equal
scores. Several labels of one identifier count as toxic if any is; labels with null are left out. Without both classes
all scores are the share of toxic rows (0 without labels). An empty table gives an empty result. Other columns aren't
read, and columns of any name come back as they were. Of paths of equal cost the first listed is taken. A token of
digits alone is a number and isn't restored.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Budget, Memory, bounded_batches, documents, fresh_name, join_small, owned, saved

N_BUCKETS = 1 << 22
PREFIXES = (4, 5, 6, 7)
MARGIN = 2.0
FIT_ROWS = 20_000
PENALTY = 0.1
N_CLASSES = 28
_CUBE = N_CLASSES**3

#: What a character may stand for besides itself.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = set(".-_*~/\\,'`^")
STAND_IN, LEFT_OUT, REPEATED = 1.0, 0.7, 0.7

_WORDS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1\1")
_RUNS = re.compile(r"(.)\1*", re.DOTALL)
_SIGNS = set(LOOKS_LIKE) - set("0123456789")
_SPACED = re.compile(r"(?<!\S)[^\s,;:](?: [^\s,;:]){2,}(?=[.,;:!?]?(?:\s|$))")
_TAIL = re.compile(r"[^\w@$!|+(<€£¡*]{3,}$|([^\w\s])\1{2,}$")
_ENDS = ".,;:?\"'()[]{}|<>…«»“”"


def letter_class(c: str) -> int:
    """1 to 26 for a letter of a to z, with or without marks, 27 for another letter, 0 for none."""
    base = unicodedata.normalize("NFD", c)[0].lower()
    return ord(base) - 96 if "a" <= base <= "z" else 27 if c.isalpha() else 0


_CLASS = np.array([letter_class(chr(c)) for c in range(0x3000)], np.int32)


def _class_of(c: str) -> int:
    k = ord(c)
    return int(_CLASS[k]) if k < 0x3000 else 27 if c.isalpha() else 0


def classes_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(raw < 0x3000, _CLASS[np.minimum(raw, 0x2FFF)], 27)


def ngram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts by class of four characters in a row, over all texts; N_CLASSES ** 4 numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = owned("counts", lambda: np.zeros(N_CLASSES**4, np.int64))
        total[:] = 0
        for b in batches:
            joined = "\n\n\n".join((t.as_py() or "") for t in b.column(0))  # three that are no letters stand between texts
            for at in range(0, len(joined), 1 << 20):
                c = np.zeros(3, np.int64)
                c = np.concatenate([classes_of(joined[max(0, at - 3) : at]), classes_of(joined[at : at + (1 << 20)])] if at else [c, classes_of(joined[: 1 << 20])]).astype(np.int64)
                code = ((c[:-3] * N_CLASSES + c[1:-2]) * N_CLASSES + c[2:-1]) * N_CLASSES + c[3:]
                total += np.bincount(code, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # N_CLASSES ** 4 rows at most
    out = np.zeros(N_CLASSES**4, np.int64)
    out[rows["code"].to_numpy()] = rows["n"].to_numpy()
    return out


def ngram_costs(counts: np.ndarray) -> array:
    """-log probability of a class after three others, flat: each order is smoothed by the one below it."""
    n4 = counts.reshape([N_CLASSES] * 4).astype(float)
    below = np.full(N_CLASSES, 1 / N_CLASSES)
    for order in (1, 2, 3, 4):
        n = n4.sum(axis=tuple(range(4 - order)))
        below = (n + 4 * below) / (n.sum(axis=-1, keepdims=True) + 4)
    return array("f", -np.log(below).ravel())


def lattice(token: str) -> list[list[tuple[str, tuple[int, ...], float]]]:
    """For each character or run of three or more: what it may stand for (letters, their classes, cost)."""
    steps = []
    for m in _RUNS.finditer(token):
        c, n = m[1], len(m[0])
        one = [(c, 0.0)] if c.isalpha() else []
        one += [(x, STAND_IN) for x in LOOKS_LIKE.get(c, "")]
        gone = [("", LEFT_OUT)] if c in SEPARATORS or not one else []
        if n > 2:
            here = [(x * k, cost + REPEATED) for x, cost in one for k in (1, 2)] + gone
            n = 1
        else:
            here = one + gone
        options = [(x, tuple(map(_class_of, x)), cost) for x, cost in here]
        steps += [options] * n
    return steps


def restored(token: str, costs: array) -> str:
    """Viterbi: the letters of least cost through the token's lattice. States are the last three letters' classes."""
    states, back, done = {0: 0.0}, [], []
    for options in lattice(token):
        new, how = {}, {}
        for s, before in states.items():
            for letters, classes, own in options:
                x, c = s, before + own
                for z in classes:
                    x = x * N_CLASSES + z
                    c += costs[x]
                    x %= _CUBE
                if x not in new or c < new[x]:
                    new[x], how[x] = c, (s, letters)
        states = new
        back.append(how)
        if len(states) == 1 and len(back) > 256:  # all paths go through here
            done.append(_followed(back, next(iter(states))))
            back = []
    end = min(states, key=lambda s: states[s] + costs[s * N_CLASSES])
    done.append(_followed(back, end))
    return "".join(done)


def _followed(back: list[dict[int, tuple[int, str]]], state: int) -> str:
    out = []
    for how in reversed(back):
        state, letters = how[state]
        out.append(letters)
    return "".join(reversed(out))


def disguised(core: str) -> bool:
    """Whether there may be a word behind it: a letter, or a look-alike that is no digit among three."""
    return any(map(str.isalpha, core)) or (not _SIGNS.isdisjoint(core) and sum(map(LOOKS_LIKE.__contains__, core)) > 2)


class Restorer:
    """words(token): the words that a token between white space stands for."""

    def __init__(self, costs: array):
        self.costs = costs

    def words(self, token: str) -> list[str]:
        low = token.lower()  # of tokens() it is that already
        if low.isalpha() and not _RUN.search(low):
            return [low]
        found = _WORDS.findall(low)
        for core in dict.fromkeys((_TAIL.sub("", low).strip(_ENDS).rstrip("!"), low.strip(_ENDS))):
            if core.isalpha() and not _RUN.search(core):
                found.append(core)
            elif disguised(core):
                found.append(restored(core, self.costs))
        return list(dict.fromkeys(found))

    def spaced(self, text: str) -> list[str]:
        return [restored(m[0].lower().replace(" ", ""), self.costs) for m in _SPACED.finditer(text)]


def tokens(text: str) -> set[str]:
    """Distinct runs between white space, lower-cased; a comma or full stop that a space follows isn't part of them."""
    return set(text.lower().replace(", ", " ").replace(". ", " ").split())


def features(words: list[str]) -> list[int]:
    """Buckets of words and of their beginnings (in bytes)."""
    out, crc = [], zlib.crc32
    for word in words:
        raw = word.encode("utf-8", "surrogatepass")
        out.append(crc(raw) & N_BUCKETS - 1)
        for k in PREFIXES:
            if len(raw) <= k:
                break
            out.append(crc(raw[:k], 1) & N_BUCKETS - 1)
    return out


def feature_counts(rows: DataFrame, costs) -> DataFrame:
    """bucket, positive, negative: how many toxic and other documents have each feature. rows: text, toxic."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fix = Restorer(costs.value)
        of = Memory(lambda token: (array("i", features(fix.words(token))), True), Budget())
        found: list[list[np.ndarray]] = [[], []]

        def flush() -> pa.RecordBatch:
            got = [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]
            buckets, at = np.unique(np.concatenate(got), return_inverse=True)
            n = [np.bincount(i, minlength=len(buckets)) for i in np.split(at, [len(got[0])])]
            found[0], found[1] = [], []
            return pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(n[1]), pa.array(n[0])], ["bucket", "positive", "negative"])

        size = 0
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                text = text.as_py() or ""
                own: set[int] = set()
                for token in tokens(text):
                    own.update(of[token])
                own.update(features(fix.spaced(text)))
                found[toxic].append(np.fromiter(own, np.int64, len(own)))
                size += len(own)
                if size > 2_000_000:
                    yield flush()
                    size = 0
        yield flush()

    counted = rows.select("text", "toxic").mapInArrow(count, "bucket long, positive long, negative long")
    return counted.groupBy("bucket").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


class Evidence:
    """What a text says for being toxic: the sum of the weights of its distinct features. table: a weight a bucket."""

    def __init__(self, costs: array, table: array):
        self.fix, self.table = Restorer(costs), table
        self.of = Memory(lambda token: (self.told(self.fix.words(token)), True), Budget())
        self.shared: dict[int, int] = {}  # one object a bucket, however many tokens have it

    def told(self, words: list[str]) -> tuple[int, ...]:
        table, same = self.table, self.shared.setdefault
        return tuple([same(x, x) for x in features(words) if table[x]])

    def features(self, text: str | None) -> set[int]:
        """The buckets with a weight that the text has."""
        own: set[int] = set()
        if text:
            own.update(*map(self.of.__getitem__, tokens(text)))
            own.update(self.told(self.fix.spaced(text)))
        return own

    def __call__(self, text: str | None) -> float:
        return math.fsum(map(self.table.__getitem__, self.features(text)))


def fit(size: np.ndarray, column: np.ndarray, y: np.ndarray, n_columns: int, steps: int = 60, kept: int = 8) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression by limited-memory quasi-Newton steps. Row k has size[k] ones, at the next places of column."""
    ends = np.cumsum(size)
    cuts = np.unique(np.r_[0, np.searchsorted(ends, np.arange(1 << 20, ends[-1] if len(ends) else 0, 1 << 20)), len(y)])  # rows in blocks, so that little stands beside the places

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        grad, total = np.append(PENALTY * w[:-1], 0.0), PENALTY / 2 * float(w[:-1] @ w[:-1])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = column[ends[a] - size[a] : ends[b - 1]]
            row = np.repeat(np.arange(b - a), size[a:b])
            m = np.bincount(row, w[:-1][at], minlength=b - a) + w[-1]
            off = 1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[a:b]
            grad[:-1] += np.bincount(at, off[row], minlength=n_columns)
            grad[-1] += off.sum()
            total += float(np.logaddexp(0, np.where(y[a:b] == 1, -m, m)).sum())
        return total, grad

    w, past = np.zeros(n_columns + 1), []
    now, grad = loss(w)
    for _ in range(steps):
        way, shares = grad.copy(), []
        for d, g in reversed(past):
            shares.append(d @ way / (g @ d))
            way -= shares[-1] * g
        way *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, float(np.linalg.norm(grad)))
        for (d, g), share in zip(past, reversed(shares), strict=True):
            way += d * (share - g @ way / (g @ d))
        length, slope = 1.0, grad @ way
        for _ in range(30):
            there, its = loss(w - length * way)
            if there <= now - 1e-4 * length * slope:
                break
            length /= 2
        d, g = -length * way, its - grad
        if d @ g > 1e-12:
            past = [*past, (d, g)][-kept:]
        done = abs(now - there) < 1e-6 * max(1.0, abs(now))
        w, now, grad = w + d, there, its
        if done:
            break
    return w[:-1], float(w[-1])


class Model:
    """costs: of the language model; buckets, weight, offset: of the regression, or the share of toxic rows where one class has none."""

    def __init__(self, costs: array, buckets: np.ndarray, weight: np.ndarray, offset: float, share: float | None = None):
        self.costs, self.buckets, self.weight, self.offset, self.share = costs, buckets, weight, offset, share

    def evidence(self) -> Evidence:
        table = np.zeros(N_BUCKETS, np.float32)
        table[self.buckets] = self.weight
        return Evidence(self.costs, array("f", table.tobytes()))

    def score(self, evidence: float) -> float:
        if self.share is not None:
            return self.share
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, evidence + self.offset))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """Language model from all of docs, telling features from all labelled rows that aren't held out, weights from fit_rows of these."""
    spark = docs.sparkSession
    bounded_batches(spark)
    costs = spark.sparkContext.broadcast(ngram_costs(ngram_counts(docs, text_col)))  # N_CLASSES ** 4 numbers of 4 bytes
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).filter("_id is not null and _y is not null").groupBy("_id").agg(F.max(F.col("_y").cast("int")).alias("_y"))
    known = saved(known.filter(~held_out(F.col("_id"))), "labels")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    rows = join_small(rows, known, "_id", "inner", known.count(), 40).select("_id", "text", (F.col("_y") > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return Model(costs.value, np.empty(0, np.int64), np.empty(0, np.float32), 0.0, pos / max(1, pos + neg))
    p, q = F.col("positive") + 0.5, F.col("negative") + 0.5
    telling = F.abs(F.log(p / q) + math.log((neg + 1) / (pos + 1))) > MARGIN * F.sqrt(1 / p + 1 / q)
    buckets = np.sort(feature_counts(rows, costs).filter(telling).select("bucket").toArrow()["bucket"].to_numpy())  # N_BUCKETS numbers at most
    shared = spark.sparkContext.broadcast(Model(costs.value, buckets, np.ones(len(buckets), np.float32), 0.0))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.evidence()
        for b in batches:
            own = [np.fromiter(of.features(t.as_py()), np.int32).tobytes() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), b.column(1)], ["own", "toxic"])

    drawn = rows.filter((F.xxhash64("_id") / F.lit(2.0**64) + 0.5) * (pos + neg) < 0.95 * fit_rows) if pos + neg > fit_rows else rows  # 5 % below, so that chance doesn't carry it above
    found = drawn.select("text", "toxic").mapInArrow(told, "own binary, toxic int").toArrow()  # fit_rows at most
    y, size = found["toxic"].to_numpy(), np.array([len(x.as_buffer()) // 4 for x in found["own"]], np.int32)
    column = np.concatenate([np.searchsorted(buckets, np.frombuffer(x.as_buffer(), np.int32)).astype(np.int32) for x in found["own"]] or [np.empty(0, np.int32)])
    del found
    weight, offset = fit(size, column, y, len(buckets))
    return Model(costs.value, buckets, weight.astype(np.float32), offset)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


def scored(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs and a score; a column of that name that was there before is replaced."""
    bounded_batches(docs.sparkSession)
    shared, name = docs.sparkSession.sparkContext.broadcast(model), "toxicity-" + uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            evidence = owned(name, m.evidence)
            yield pd.Series([m.score(evidence(x)) for x in texts], dtype="float64")

    return docs.withColumn(out_col, score(F.col(f"`{text_col}`").cast("string")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs without the rows that score as toxic; its columns as they are."""
    names, score = docs.columns, fresh_name(docs, "score")
    return scored(docs, train(docs, labels), out_col=score).filter(F.col(score) < threshold).select(*[F.col(f"`{c}`") for c in names])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
