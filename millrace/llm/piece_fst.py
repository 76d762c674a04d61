"""SentencePiece encoding and decoding as a weighted finite-state transducer.

compile_model() reads a model file, of the BPE or the Unigram kind, and builds three transducers:

* Normaliser: from a text to the text as the model sees it; its arcs are the model's character rules (longest
  match first), a space before the text, spaces as U+2581, and the removal of extra spaces, as the model says.
* Lexicon: a trie whose states are beginnings of pieces; a path from the root to a final state reads a piece,
  writes its id and weighs minus its score.
* Byte fallback: a character that is no piece goes to the ids of its UTF-8 bytes (to the unknown id in a model
  without), at a weight above that of any piece.

Composed with an input they are a lattice whose states are (place, last piece); encode() takes its shortest path in the
tropical semiring (sums along a path, the least of paths). For a Unigram model that is the library's result. A BPE
model's result is the least fixed point of merges by rank, not the path of least sum; but a path is that result
exactly if each two adjacent pieces are what the merges make of their joint text. So there one piece after another
weighs 0 if they are, else infinity, and one path has a finite weight. Whether two pieces may be adjacent is found by
undoing their merges at their border, or by merging anew where a piece ranks before one it is made of or has
another's score; of equal merges the leftmost goes first. With such weights at most one path of finite weight leads to
a place, so the path is searched depth first, longer pieces before shorter ones: it meets few states of the lattice,
each once at most.

Where no piece goes on from a non-space into a space, the lattice has one state at that place and is cut; cut parts are
remembered in a worker while its bytes last.

Null text counts as empty, and an empty text has no ids. Repeated rows and ties are encoded row by row; of paths of
equal weight the one whose last piece starts first is taken, as the library does. Very long texts without a space are one
lattice, whose memory and time are linear in their length. Other columns aren't read. An empty table gives an empty
result. Decoding gives the normalised text: U+2581 in a text comes back as a space.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WORKER_BYTES, Budget, Memory, bounded_batches, documents, owned

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: how far below the least score an unknown character is


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message: numbers, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            x = raw[at]
            at += 1
            n |= (x & 127) << shift
            if x < 128:
                return n
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at : at + size]
            at += size


class Normaliser:
    """Character rules as a double-array trie over UTF-8 bytes (of the model file), and what is done with spaces."""

    def __init__(self, charsmap: bytes, prefix: bool, single: bool, escape: bool):
        self.prefix, self.single, self.space = prefix, single, SPACE if escape else " "
        self.units: list[int] = []
        if charsmap:
            size = struct.unpack_from("<I", charsmap)[0]
            self.units, self.made = list(struct.unpack_from(f"<{size // 4}I", charsmap, 4)), charsmap[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest rule that reads raw from a place, and what it writes."""
        found, node = None, self._offset(self.units[0])
        for end in range(at, len(raw)):
            node ^= raw[end]
            if node >= len(self.units) or self.units[node] & 0x800000FF != raw[end]:
                break
            unit = self.units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = end - at + 1, self.made[start : self.made.index(b"\0", start)]
        return found

    def __call__(self, text: str) -> str:
        if self.units:
            raw, out, at = text.encode("utf-8", "replace"), [], 0
            while at < len(raw):
                size, said = self._longest(raw, at) or (n := 1 + (raw[at] > 191) + (raw[at] > 223) + (raw[at] > 239), raw[at : at + n])
                out.append(said)
                at += size
            text = b"".join(out).decode("utf-8", "replace")
        if self.single:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (self.space if self.prefix else "") + (text.replace(" ", self.space) if self.space != " " else text)


@dataclass
class Transducer:
    """arcs: of the lexicon's states, by character; final: the id that a state writes, or -1; weight: by id."""

    normal: Normaliser
    pieces: list[str]
    weight: list[float]
    byte_ids: list[int] | None
    unknown: int
    is_bpe: bool
    arcs: list[dict[str, int]] = field(default_factory=lambda: [{}])
    final: list[int] = field(default_factory=lambda: [-1])
    longest: list[int] = field(default_factory=list)  # by state: the longest piece on the way to it; without one, the unknown id
    shorter: list[int] = field(default_factory=list)  # by id: the next shorter piece on the way to it; the unknown id if a piece's first character is none; -1
    rank: dict[str, int] = field(default_factory=dict)  # BPE: order of merges, by piece
    halves: dict[str, tuple[str, str]] = field(default_factory=dict)  # the two pieces last merged into one
    uneven: set[str] = field(default_factory=set)  # pieces that rank before a piece they are made of or have another's score, and pieces made of them
    score: dict[str, float] = field(default_factory=dict)
    surface: list[bytes] = field(default_factory=list)
    most: int = 1  # characters of the longest piece
    cut_at_spaces: bool = False
    cut_at_line_ends: bool = False

    def add(self, piece: str, i: int) -> None:
        state, self.most = 0, max(self.most, len(piece))
        for c in piece:
            if c not in self.arcs[state]:
                self.arcs[state][c] = len(self.arcs)
                self.arcs.append({})
                self.final.append(-1)
            state = self.arcs[state][c]
        self.final[state] = i

    def link(self) -> None:
        """Once all pieces are added: longest and shorter. A state comes after the one before it."""
        self.longest, self.shorter = [self.unknown] * len(self.arcs), [-1] * len(self.pieces)
        for state, arcs in enumerate(self.arcs):
            for after in arcs.values():
                i, before = self.final[after], self.longest[state]
                self.longest[after] = i if i >= 0 else before
                if i >= 0 and (state or before != self.unknown):
                    self.shorter[i] = before


def _merged(text: str, score: dict[str, float]) -> list[tuple[str, tuple[str, str] | None]]:
    """What merging by score gives, best first, leftmost of equals; each piece with the two it was made of."""
    parts: list = [(c, None) for c in text]
    before, after = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
    todo: list = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (both := parts[a][0] + parts[b][0]) in score:
            heapq.heappush(todo, (-score[both], a, b, both))

    for k in range(len(text) - 1):
        offer(k, k + 1)
    while todo:
        _, a, b, both = heapq.heappop(todo)
        if parts[a] is None or parts[b] is None or parts[a][0] + parts[b][0] != both or after[a] != b:
            continue
        parts[a], parts[b] = (both, (parts[a][0], parts[b][0])), None
        after[a] = after[b]
        if after[b] >= 0:
            before[after[b]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [p for p in parts if p is not None]


def compile_model(path: str) -> Transducer:
    with open(path, "rb") as f:
        return compile_proto(f.read())


def compile_proto(raw: bytes) -> Transducer:
    """raw: a model file. Fields, fixed by the format: 1 pieces (1 text, 2 score, 3 kind), 2 trainer (3 kind of model,
    24 spaces as suffix, 35 byte fallback), 3 normaliser (2 rules, 3 space before, 4 single spaces, 5 spaces as U+2581)."""
    normaliser, trainer, listed = {}, {}, []
    for k, v in _fields(raw):
        if k == 1:
            d = dict(_fields(v))
            listed.append((d[1].decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, 1)))
        elif k == 2:
            trainer = dict(_fields(v))
        elif k == 3:
            normaliser = dict(_fields(v))
    kind = trainer.get(3, 1)
    if kind not in (1, 2) or trainer.get(24) or any(x[2] == 4 for x in listed):
        raise ValueError("only Unigram and BPE models are compiled, without pieces of the user's and without spaces as suffixes")
    normal = {p: i for i, (p, _, kind) in enumerate(listed) if kind == 1}
    score = {p: listed[i][1] for p, i in normal.items()}
    at = {p: i for i, (p, _, kind) in enumerate(listed) if kind == 6}
    byte_ids = [at[f"<0x{b:02X}>"] for b in range(256)] if trainer.get(35) else None
    rules = Normaliser(normaliser.get(2, b""), bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)), bool(normaliser.get(5, 1)))
    t = Transducer(rules, [p for p, _, _ in listed], [-x for _, x, _ in listed], byte_ids, next(i for i, x in enumerate(listed) if x[2] == 2), kind == 2)
    t.weight[t.unknown] = UNKNOWN_PENALTY - min(score.values(), default=0.0)
    if t.is_bpe:
        for k, p in enumerate(sorted(normal, key=lambda p: -score[p])):
            if len(p) == 1:
                t.rank[p] = -1
            elif len(m := _merged(p, score)) == 1:  # a piece that merging doesn't reach is on no path
                t.rank[p], t.halves[p] = k, m[0][1]
        t.score = score
        alike = Counter(x for p, x in score.items() if len(p) > 1)
        for p, made in t.halves.items():
            if alike[score[p]] > 1 or t.rank[p] < max(t.rank.get(x, -1) for x in made) or not t.uneven.isdisjoint(made):
                t.uneven.add(p)
    for p in t.rank if t.is_bpe else normal:
        t.add(p, normal[p])
    t.link()
    t.cut_at_spaces = not any(SPACE in p.lstrip(SPACE) for p in normal)
    t.cut_at_line_ends = not any("\n" in p for p in normal)
    for p, _, kind in listed:
        t.surface.append(bytes([int(p[3:5], 16)]) if kind == 6 else p.replace(SPACE, " ").encode() if kind == 1 else " ⁇ ".encode() if kind == 2 else b"")
    return t


class Codec:
    """Composes the transducer with texts. encode(text) -> packed little-endian ids."""

    def __init__(self, t: Transducer, memory: int = WORKER_BYTES):
        self.t = t
        self.code = "H" if len(t.surface) <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        budget = Budget(memory)
        self.parts = Memory(lambda part: (self.path(part), True), budget)
        self.after_space = Memory(self._after_space, budget)
        self.pairs = Memory(lambda pair: (self._adjacent(*pair), True), budget)
        self.split = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if t.cut_at_line_ends else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def _adjacent(self, a: str, b: str) -> bool:
        """Whether b after a weighs 0: no merge of lower rank crosses their border."""
        if a in self.t.uneven or b in self.t.uneven:
            return [p for p, _ in _merged(a + b, self.t.score)] == [a, b]
        rank, halves, x, y, limit = self.t.rank, self.t.halves, a, b, float("inf")
        while True:
            both = rank.get(x + y)
            if both is not None and both < limit:
                return False
            if len(x) == 1 and len(y) == 1:
                return True
            rx, ry = rank.get(x, -1), rank.get(y, -1)  # a character that is no piece is never merged
            if rx > ry:
                limit, x = rx, halves[x][1]
            else:  # of equal merges the left one goes first
                limit, y = ry + 1, halves[y][0]

    def _pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def path(self, text: str) -> bytes:
        """Ids along the shortest path of a normalised text."""
        t, (found, pieces) = self.t, self._finite(text) if self.t.is_bpe else self._shortest(text)
        if t.unknown not in found:
            return self._pack(found)
        ids: list[int] = []
        for i, said in zip(found, pieces, strict=True):
            if i != t.unknown:
                ids.append(i)
            elif t.byte_ids:
                ids += [t.byte_ids[x] for x in said.encode("utf-8", "replace")]
            elif not ids or ids[-1] != i:  # unknown characters that follow one another have one id
                ids.append(i)
        return self._pack(ids)

    def _finite(self, text: str) -> tuple[list[int], list[str]]:
        """Ids and pieces along the one path of finite weight (BPE)."""
        t, n, pairs = self.t, len(text), self.pairs
        arcs, longest, shorter, pieces, unknown, most = t.arcs, t.longest, t.shorter, t.pieces, t.unknown, t.most
        ids: list[int] = []
        said: list[str] = []
        at, before, left = 0, "", set()  # left: places from which no path goes on
        while at < n:
            state = 0
            for c in text[at : at + most]:
                if (after := arcs[state].get(c)) is None:
                    break
                state = after
            i = longest[state]
            while True:
                piece = pieces[i] if i != unknown else text[at]  # a character that is no piece
                if (not before or pairs[before, piece]) and (not left or at + len(piece) not in left):
                    break
                while (i := shorter[i]) < 0:
                    if not ids:
                        raise ValueError(f"no path through {text[:80]!r}")
                    left.add(at)
                    i = ids.pop()
                    at -= len(said.pop())
                    before = said[-1] if said else ""
            ids.append(i)
            said.append(piece)
            at, before = at + len(piece), piece
        return ids, said

    def _shortest(self, text: str) -> tuple[list[int], list[str]]:
        """Ids and pieces along the path of the least sum (Unigram)."""
        t, n = self.t, len(text)
        arcs, final, weight, pieces = t.arcs, t.final, t.weight, t.pieces
        far = float("inf")
        cost, last, by = [0.0] + [far] * n, [""] * (n + 1), [-1] * (n + 1)
        for start in range(n):
            if (here := cost[start]) == far:
                continue
            state, single = 0, False
            for end in range(start, n):
                state = arcs[state].get(text[end])
                if state is None:
                    break
                i = final[state]
                if i < 0:
                    continue
                if end == start:
                    single = True
                if here + weight[i] < cost[end + 1]:
                    cost[end + 1], last[end + 1], by[end + 1] = here + weight[i], pieces[i], i
            if not single and here + weight[t.unknown] < cost[start + 1]:  # a character that is no piece
                cost[start + 1], last[start + 1], by[start + 1] = here + weight[t.unknown], text[start], t.unknown
        if cost[n] == far:
            raise ValueError(f"no path through {text[:80]!r}")
        ids, said, end = [], [], n
        while end:
            ids.append(by[end])
            said.append(last[end])
            end -= len(last[end])
        return ids[::-1], said[::-1]

    def _after_space(self, part: str) -> tuple[bytes, bool]:
        """Ids of a part and the space before it (of one that starts with a line end, without a space; see encode())."""
        if part[0] == "\n":
            return self.parts["\n"] + (self.parts[part[1:]] if len(part) > 1 else b""), False
        return self.path(SPACE + part), True

    def encode(self, text: str) -> bytes:
        t = self.t
        text = t.normal(text)
        if not text:
            return b""
        if not t.cut_at_spaces or not t.byte_ids:
            return self.path(text)
        if text[0] != SPACE or text[-1] == SPACE or SPACE * 2 in text or "\n" in text and (not t.cut_at_line_ends or text[-1] == "\n" or _EDGES.search(text)):
            return b"".join(map(self.parts.__getitem__, self.split.findall(text)))
        return b"".join(map(self.after_space.__getitem__, text[1:].replace("\n", SPACE + "\n").split(SPACE)))

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.t.surface.__getitem__, np.frombuffer(ids, self.dtype).tolist()))
        text = raw.decode("utf-8", "replace")
        return text.removeprefix(" ") if self.t.normal.prefix else text

    def plain(self, text: str) -> str:
        """The normalised text, which decoding gives back."""
        text = self.t.normal(text).replace(SPACE, " ")
        return text.removeprefix(" ") if self.t.normal.prefix else text


_EDGES = re.compile(rf"\n[\n{SPACE}]|{SPACE}\n")


def codec(model: str, compiled, memory: int = WORKER_BYTES) -> Codec:
    """The codec of a model in this Python process; the transducer was compiled once, on the driver."""
    return owned(f"pieces-{model}-{memory}", lambda: Codec(compiled.value, memory))


def _compiled(spark: SparkSession, model: str):
    bounded_batches(spark)
    return spark.sparkContext.broadcast(compile_model(public_tokenizers.path(model) if "/" not in model else model))  # a vocabulary: its size doesn't depend on the data


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "piece_ids", model: str = MODEL, memory: int = WORKER_BYTES) -> DataFrame:
    """docs and a column of ids; a column of that name that was there before is replaced. memory: bytes that a worker may remember; less costs time, not results."""
    compiled = _compiled(docs.sparkSession, model)

    @F.pandas_udf("array<int>")
    def to_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            c = codec(model, compiled, memory)
            yield pd.Series([np.frombuffer(c.encode(x or ""), c.dtype).astype(np.int32) for x in texts])

    return docs.withColumn(out_col, to_ids(F.col(f"`{text_col}`").cast("string")))


def decode(rows: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """rows and a column of texts; null ids give null."""
    compiled = _compiled(rows.sparkSession, model)

    @F.pandas_udf("string")
    def to_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            c = codec(model, compiled)
            yield pd.Series([None if x is None else c.decode(np.asarray(x).astype(c.dtype).tobytes()) for x in ids], dtype=object)

    return rows.withColumn(out_col, to_text(F.col(f"`{ids_col}`")))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per row of docs: id, n_pieces, n_bytes (ids by byte fallback), ids_crc32 (of uint32 ids), round_trip."""
    compiled = _compiled(docs.sparkSession, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, rows = codec(model, compiled), []
            low, high = min(c.t.byte_ids), max(c.t.byte_ids)
            for text in b.column(1):
                text = text.as_py() or ""
                raw = c.encode(text)
                ids = np.frombuffer(raw, c.dtype)
                rows.append((len(ids), int(((ids >= low) & (ids <= high)).sum()), zlib.crc32(ids.astype("<u4")), c.decode(raw) == c.plain(text)))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, k) for x, k in zip(cols, kinds, strict=True)]], ["id", "n_pieces", "n_bytes", "ids_crc32", "round_trip"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(measure, "id long, n_pieces long, n_bytes long, ids_crc32 long, round_trip boolean")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
