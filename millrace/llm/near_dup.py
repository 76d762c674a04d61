"""Near-duplicate documents: multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

1. Each document's set of word shingles (as 64-bit hashes) gives a signature of N_SYMBOLS symbols of
   16 bits, one per random order of the hashes. Documents of the same set are one class from here on.
2. Of two sets of similarity t, a symbol differs with probability 1 - t. MAX_SIGMA standard deviations
   above the mean of differing symbols is the distance threshold T.
3. The signature is cut into C chunks with T < C * (errors + 1), so that of any two signatures within T
   at least one chunk differs in at most `errors` symbols. A class is filed under each chunk with each
   choice of that many symbols left out: all pairs within T share a key.
4. Under each key every class could meet the least one only (its hub), not all. A class is compared with
   one hub, that of most of its keys: distances are tested, then links confirmed on the full sets. In up to
   HUB_TURNS more turns, each key whose classes lie in several components has N_HUBS of them as hubs, others in
   each turn; of the hubs of all its keys that lie in other components, a class is compared with the one whose
   signature is nearest.
5. What the hubs don't settle: keys whose classes still lie in more than one component. Their classes are
   joined exactly, by the prefixes of their sets in order of rarity (two sets of similarity t share one
   of the rarest n - ceil(t n) + 1 shingles), between components only.

So no pair within T that is similar enough ends in two components, and no group is expanded into all
its pairs. Components are found over links between classes, each round a table in the shared folder.

Words are runs of [^\\x20\\x09-\\x0D], A-Z lower-cased. A text of fewer words than a shingle has one, all
of it; without words (or null) it has none and is linked with nothing. Repeated rows are in one class.
A null id can't name a component; a component of null ids only has a null id. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_BYTES, ROW_FILE, ROW_INDEX, ROW_KEY, documents, dropped, join_small, owned, row_columns, saved, scratch, with_row_key
from millrace.llm.components import components

N_SYMBOLS = 64
MAX_SIGMA = 4.5
ERRORS = 1
HUB_TURNS = 3  # turns of comparing with hubs of other components; what they leave is joined exactly
N_HUBS = 16  # of each key, in each turn
SHORT = ["q0", "q1", "q2", "q3"]  # the lowest four bits of each symbol, packed

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=_U)
_BASE = int(_rng.integers(0, 1 << 63)) * 2 + 1
_SEEDS = _rng.integers(0, 1 << 64, 64, dtype=_U)
_MUL = (_rng.integers(0, 1 << 31, N_SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_XOR = _rng.integers(0, 1 << 32, N_SYMBOLS, dtype=np.uint32)[:, None]
_SYMBOL = _rng.integers(0, 1 << 64, N_SYMBOLS, dtype=_U)
_BLOCK = 1 << 18
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)  # bytes.lower() changes A-Z only
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = np.empty(len(starts), _U), 0
    while at < len(starts):  # by blocks, so that the tables of powers stay small
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK)))
        base, stop = starts[at], ends[to - 1]
        power, inverse = _power_tables(int(stop - base) + 1)
        sums = np.zeros(stop - base + 1, _U)
        np.cumsum(_BYTE[raw[base:stop]] * power[: stop - base], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = _mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U))
        at = to
    return out


def shingle_set(text: str | None, n_words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    w = word_hashes(text) if text else np.empty(0, _U)
    k = min(n_words, len(w))
    if not k:
        return w
    h = np.full(len(w) - k + 1, _SEEDS[k % 64] + _U(k // 64), _U)
    for j in range(k):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + w[j : len(w) - k + 1 + j])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    h, least = (shingles >> _U(32)).astype(np.uint32), np.full(N_SYMBOLS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 4096):
        np.minimum(least, ((h[at : at + 4096] ^ _XOR) * _MUL).min(axis=1), out=least)
    return ((least * np.uint32(2654435761)) >> np.uint32(16)).astype("<u2")


def distance_threshold(similarity: float) -> int:
    return math.ceil(N_SYMBOLS * (1 - similarity) + MAX_SIGMA * math.sqrt(N_SYMBOLS * similarity * (1 - similarity)))


def chunk_keys(signatures: np.ndarray, threshold: int, errors: int = ERRORS) -> np.ndarray:
    """Keys of each signature (a row): per chunk and choice of symbols left out, a hash of those that stay."""
    n_chunks = threshold // (errors + 1) + 1
    each = _mix(signatures.astype(_U) + _SYMBOL)
    keys = []
    for k, chunk in enumerate(np.array_split(np.arange(N_SYMBOLS), n_chunks)):
        total = each[:, chunk].sum(axis=1, dtype=_U)
        for left in combinations(chunk.tolist(), min(errors, len(chunk) - 1)):
            rest = total - each[:, list(left)].sum(axis=1, dtype=_U)
            keys.append(_mix(rest + _U(k * 1_000_003 + sum(x * 131**i for i, x in enumerate(left)) + 1)))
    return np.stack(keys, axis=1)


def short_signature(sig: np.ndarray) -> np.ndarray:
    """The lowest four bits of each symbol, sixteen symbols in a 64-bit integer."""
    return ((sig.astype(_U) & _U(15)).reshape(-1, 16) << np.arange(0, 64, 4, dtype=_U)).sum(axis=1, dtype=_U).view(np.int64)


def _signed(rows: DataFrame, n_words: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = owned("signatures", lambda: np.zeros(len(SHORT), np.int64))  # what another operator kept goes
        for b in batches:
            n, sets, sigs, short = [], [], [], []
            for text in b.column(3):
                s = shingle_set(text.as_py(), n_words)
                sig = signature(s) if len(s) else None
                n.append(len(s))
                sets.append(np.array([_mix(s).sum(dtype=_U), _mix(s ^ _SEEDS[63]).sum(dtype=_U)], "<u8").tobytes() if len(s) else None)
                sigs.append(sig.tobytes() if len(s) else None)
                short.append(short_signature(sig) if len(s) else none)
            packed = np.array(short, np.int64).reshape(-1, len(SHORT))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary()), *[pa.array(packed[:, k]) for k in range(len(SHORT))]], [*ROW_KEY, "id", "n", "set_id", "sig", *SHORT])

    return rows.mapInArrow(sign, f"{ROW_FILE} long, {ROW_INDEX} long, id long, n long, set_id binary, sig binary, " + ", ".join(f"{c} long" for c in SHORT))


def _keyed(classes: DataFrame, threshold: int) -> DataFrame:
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                nodes = b.column(0)[at : at + 1000].to_numpy()
                sigs = np.frombuffer(b"".join(b.column(1)[at : at + 1000].to_pylist()), "<u2").reshape(len(nodes), N_SYMBOLS)
                keys = chunk_keys(sigs, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(nodes, keys.shape[1]))], ["key", "node"])

    return classes.select("node", "sig").mapInArrow(file, "key long, node long")


def _if_small(rows: DataFrame, n: int, row_bytes: int) -> DataFrame:
    """rows for the right side of a join: broadcast if n of them are small, else left to Spark, which splits a hot key's rows."""
    return F.broadcast(rows) if n * row_bytes <= BROADCAST_BYTES else rows


def _within(pairs: DataFrame, classes: DataFrame, similarity: tuple[int, int], threshold: int) -> DataFrame:
    """Of pairs a, b those whose sizes allow the similarity and whose signatures are within the threshold."""
    num, den = similarity
    a, b = (classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    n = pairs.count()
    half = a.join(_if_small(pairs, n, 40), "a")
    sized = b.join(_if_small(half, n, 400), "b").filter(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            if r.num_rows:
                x, y = (np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(-1, N_SYMBOLS) for c in r.columns[2:4])
                ok = pa.array((x != y).sum(axis=1) <= threshold)
                yield pa.RecordBatch.from_arrays([r.column(0).filter(ok), r.column(1).filter(ok)], ["a", "b"])

    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(near, "a long, b long")


def _set_rows(rows: DataFrame, classes: DataFrame, nodes: DataFrame, n_nodes: int, n_words: int) -> DataFrame:
    """node, n, set (sorted uint64, packed) of the given nodes, n_nodes rows, from the text of one row of each."""
    wanted = saved(classes.join(_if_small(nodes, n_nodes, 40), "node", "left_semi").select("rep.*", "node"), "wanted")
    texts = join_small(rows, wanted, ROW_KEY, "inner", wanted.count(), 80).select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                found = [shingle_set(t.as_py(), n_words) for t in b.column(1)[at : at + 500]]
                cols = [b.column(0)[at : at + 500], pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["node", "n", "set"])

    return texts.mapInArrow(sets, "node long, n long, set binary")


def _confirmed(pairs: DataFrame, n_pairs: int, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    num, den = similarity
    a, b = (sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            ok = []
            for x, y in zip(r.column(2), r.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([r.column(0).filter(ok), r.column(1).filter(ok)], ["a", "b"])

    half = a.join(_if_small(pairs, n_pairs, 40), "a")
    return half.join(b, "b").select("a", "b", "set_a", "set_b").mapInArrow(test, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    known = labels.select(F.col("node").alias(node), F.col("label").alias(label))
    return rows.join(_if_small(known, labels.count(), 40), node, "left").withColumn(label, F.coalesce(label, node))


def _rest_pairs(sets: DataFrame, labels: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """All pairs of different components that may be similar enough, by prefixes in order of rarity."""
    num, den = similarity

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, n, s in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, node)), pa.array(np.full(n, n)), pa.array(np.frombuffer(s, np.int64))], ["node", "n", "h"])

    each = sets.select("node", "n", "set").mapInArrow(spread, "node long, n long, h long")
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    rows = each.join(shared, "h")
    by_node = W.partitionBy("node")
    rank = F.col("n") - F.count(F.lit(1)).over(by_node) + F.row_number().over(by_node.orderBy("freq", "h"))  # those of one set only come first
    prefix = rows.withColumn("rank", rank).filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * num / F.lit(den)) + 1)
    prefix = saved(_labelled(prefix.select("h", "node", "n", "rank"), labels, "node", "label"), "prefixes")
    # of each shingle the component with most rows, and all others: rows of one component never meet
    top = prefix.groupBy("h", "label").count().groupBy("h").agg(F.max_by("label", F.struct("count", "label")).alias("top"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    rows = saved(prefix.join(top, "h"), "mixed")
    most = rows.filter("label = top").select("h", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("rank").alias("r_a"), F.col("label").alias("l_a"))
    other = rows.filter("label <> top")
    a, b = (other.select("h", F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("rank").alias(f"r_{x}"), F.col("label").alias(f"l_{x}")) for x in "ab")
    # of sets similar enough, the first shared shingle leaves as many places in both as they must share
    fits = (F.least(F.col("n_a") - F.col("r_a"), F.col("n_b") - F.col("r_b")) + 1) * (num + den) >= (F.col("n_a") + F.col("n_b")) * num
    met = most.join(b, "h").filter(fits).select("a", "b").unionByName(a.join(b, "h").filter(fits & (F.col("l_a") < F.col("l_b"))).select("a", "b"))
    return met.distinct()


def _nearest_hub(filed: DataFrame) -> DataFrame:
    """a, b: for each node the hub, other than itself, that it meets under most keys."""
    return filed.filter("node <> hub").groupBy(F.col("node").alias("a")).agg(F.mode("hub", True).alias("b"))


def _open_rows(filed: DataFrame, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """The rows (key, node) of keys whose nodes lie in more than one component, with each node's label, size and short signature."""
    labelled = filed.select("key", "node").join(_if_small(nodes, n_nodes, 100), "node")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    mixed = saved(mixed, "open-keys")
    return saved(join_small(labelled, mixed, "key", "inner", mixed.count(), 40), "open", keep=True)


def _nearest_of_hubs(rows: DataFrame, similarity: tuple[int, int], threshold: int, turn: int) -> DataFrame:
    """a, b: for each node, of the hubs of all its keys that lie in other components, the one at the least distance.

    Each key has up to N_HUBS of its nodes as hubs, drawn by a hash that each turn has its own of. Distances are of short
    signatures, within the row, so that no pairs are made but the one of each node.
    """
    num, den = similarity
    told = ["node", "label", "n", *SHORT]
    mixed = F.xxhash64("node", F.lit(turn))
    some = rows.groupBy("key", F.pmod(mixed, F.lit(N_HUBS)).alias("part")).agg(F.max_by(F.struct(*told), mixed).alias("hub"))
    hubs = some.groupBy("key").agg(F.collect_list("hub").alias("hubs"))  # N_HUBS of them at most
    hubs = saved(hubs, "hubs-of-keys")
    met = join_small(rows, hubs, "key", "inner", hubs.count(), 60 * N_HUBS)
    fits = lambda h: (h["label"] != F.col("label")) & (F.least(h["n"], "n") * den >= F.greatest(h["n"], "n") * num)
    near = F.array_min(F.transform(F.filter("hubs", fits), lambda h: F.struct(_short_distance(h).alias("d"), h["node"].alias("b"))))
    best = met.groupBy(F.col("node").alias("a")).agg(F.min(near).alias("near"))
    return best.filter(F.col("near.d") <= threshold).select("a", "near.b")


def _short_distance(h) -> Column:
    """Symbols whose lowest four bits differ between a struct's short signature and the row's."""
    out = F.lit(0)
    for c in SHORT:
        x = h[c].bitwiseXOR(F.col(c))
        for k in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        out = out + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per row of docs: row key, id, n_shingles, component_id (least id), stays (one row of each component)."""
    keyed = with_row_key(docs)
    with scratch(docs.sparkSession):
        return _near_duplicates(keyed, id_col, text_col, n_words, similarity)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, n_words: int, similarity: tuple[int, int]) -> DataFrame:
    rows = with_row_key(docs).select(*ROW_KEY, F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    threshold = distance_threshold(similarity[0] / similarity[1])
    signed = saved(_signed(rows, n_words), "signed")
    first = signed.filter("n > 0").groupBy("set_id", "n").agg(F.first("sig").alias("sig"), *[F.first(c).alias(c) for c in SHORT], F.min(F.struct(*ROW_KEY)).alias("rep"))
    classes = saved(first.withColumn("node", F.monotonically_increasing_id()), "classes")
    n_classes = classes.count()

    keyed = _keyed(classes, threshold)
    hubs = saved(keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("key", "hub"), "hubs")
    n_hubs = hubs.count()
    filed = saved(join_small(keyed, hubs, "key", "inner", n_hubs, 40), "filed")  # the keys that more than one class has
    dropped(hubs)
    spark = docs.sparkSession

    def linked(pairs: DataFrame) -> DataFrame:
        with scratch(spark):
            near = saved(_within(pairs, classes, similarity, threshold), "pairs")
            n = near.count()
            nodes = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node")))
            sets = saved(_set_rows(rows, classes, nodes, 2 * n, n_words), "sets")
            return saved(_confirmed(near, n, sets, similarity), "links", keep=True)

    def named_components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """Labels of the nodes of links; what is known before is links of nodes with their labels."""
        with scratch(spark):
            known = [] if before is None else [before.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))]
            return saved(components(reduce(DataFrame.unionByName, known, links)), "labels", keep=True)

    tried = saved(_nearest_hub(filed), "tried")
    labels = named_components(linked(tried))
    rest = filed
    for turn in range(HUB_TURNS + 1):
        with scratch(spark):
            now = _open_rows(rest, _labelled(classes.select("node", "n", *SHORT), labels, "node", "label"), n_classes)  # a key without different components stays so
        dropped(rest)
        rest = now
        if turn == HUB_TURNS:
            break
        with scratch(spark):
            others = _nearest_of_hubs(rest, similarity, threshold, turn).join(_if_small(tried, tried.count(), 50), ["a", "b"], "left_anti")
            others = saved(others, "tried", keep=True)
        more = linked(others)
        if more.isEmpty():
            break
        tried = tried.unionByName(others)
        labels = named_components(more, labels)

    nodes = saved(rest.select("node").distinct(), "rest")
    n_rest = nodes.count()
    if n_rest:
        sets = saved(_set_rows(rows, classes, nodes, n_rest, n_words), "sets")
        pairs = saved(_rest_pairs(sets, labels, similarity), "rest-pairs")
        found = saved(_confirmed(pairs, pairs.count(), sets, similarity), "links")
        dropped(sets)
        if not found.isEmpty():
            labels = named_components(found, labels)

    named = _labelled(classes.select("set_id", "node"), labels, "node", "label").select("set_id", "label")
    placed = saved(signed.select(*ROW_KEY, "id", "n", "set_id").join(saved(named, "named"), "set_id", "left"), "placed", keep=True)
    best = placed.filter("label is not null").groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", *ROW_KEY)).alias("best"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    best = saved(best.drop("rows"), "best", keep=True)  # a hot label's rows can be split: nothing is gathered on this side of the join
    out = join_small(placed, best, "label", "left", best.count(), 60)
    alone = F.col("best").isNull()
    stays = alone | ((F.col(f"best.{ROW_FILE}") == F.col(ROW_FILE)) & (F.col(f"best.{ROW_INDEX}") == F.col(ROW_INDEX)))
    return out.select(*ROW_KEY, "id", F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("component_id"), stays.alias("stays"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """docs with one row of each component; its columns as they are."""
    keyed = with_row_key(docs)
    with scratch(docs.sparkSession):
        gone = saved(near_duplicates(keyed, id_col, text_col, n_words, similarity).filter("not stays").select(*ROW_KEY), "gone", keep=True)
    return join_small(keyed, gone, ROW_KEY, "left_anti", gone.count(), 64).select(*row_columns(keyed, docs))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), n_words=3, similarity=(17, 20))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
