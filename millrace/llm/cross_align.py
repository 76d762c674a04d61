"""Alignment of two tokenizers over whole texts by a dictionary of groups.

A is a byte-level BPE over space + text, B a model of pieces, which adds that space itself. Where a token of both ends at
one byte, their tokens are cut into groups; a group is the ids of A and of B between two cuts, written `a1,a2|b1`. Which
tokens are linked (their bytes overlap) depends on a group's ids alone, so:

1. Texts are read in blocks. A block interns its groups: a document becomes a list of numbers, and the block has a dictionary
   of number, group and frequency, of bounded size.
2. The dictionaries are summed by group. Each distinct group is expanded into links once, and its links are multiplied by its
   frequency; so the corpus-wide count of an id pair comes from distinct groups, not from documents.
3. What the counts say of each group is joined back to the dictionaries by group key. A group is in a block's dictionary once
   however often it occurs, so the commonest group has as many rows as there are blocks, a small share of all. Each block's
   documents then add up the numbers they hold.

A long text is encoded in segments, cut at a single space between other characters, where both tokenizers always have a border.
Borders, groups and their names are found by arrays over all tokens of a segment.

Null and empty texts, and texts whose tokens of A or of B don't join to space + text (such as one with U+2581), have no tokens:
zeros, and an empty digest. Bytes that are no UTF-8 are read as U+FFFD. Rows are told apart by their place in the input, so
identifiers may be null or repeated; ties for the highest count all count as best. Very long texts go over several blocks. Other
columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import VOCAB, _byte_alphabet
from millrace.llm.common import ROW_KEY, bounded_batches, documents, join_small, owned, saved, with_row_key
from millrace.llm.piece_fst import MODEL, SPACE

#: A block is closed when it has so many occurrences of groups or so many distinct ones.
BLOCK_GROUPS, BLOCK_DISTINCT = 1 << 20, 50_000
#: Characters of a segment, at least.
SEGMENT = 1 << 20
_CUT = re.compile(r"[^\s](?= [^\s])")


class Surfaces:
    """The bytes of each id of A and of B."""

    def __init__(self, vocab: str = VOCAB, model: str = MODEL):
        import sentencepiece

        with open(_path(vocab), encoding="utf-8") as f:
            said = json.load(f)
        alphabet = {c: b for b, c in _byte_alphabet().items()}
        #: A's ids in the order of its merges, which is all that encoding needs; special tokens are no part of it.
        self.ranks = {bytes(alphabet[c] for c in token): i for token, i in said["model"]["vocab"].items() if all(c in alphabet for c in token)}
        special = {t["content"] for t in said["added_tokens"]}
        for token in special:
            self.ranks.pop(token.encode(), None)
        made = [said["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in said["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("A's ids aren't in the order of its merges")
        self.a = [b""] * (max(self.ranks.values()) + 1)
        for raw, i in self.ranks.items():
            self.a[i] = raw
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=_path(model))
        said = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(said)]
        #: Whether B has a border before a space that follows another character.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in said)


def _path(name: str) -> str:
    return name if "/" in name else public_tokenizers.path(name)


def links(group: str, a_bytes: list[bytes], b_bytes: list[bytes]) -> Counter:
    """How often a group links each id pair."""
    a, b = ([int(x) for x in side.split(",")] for side in group.split("|"))
    found, i, j, end_a, end_b = Counter(), 0, 0, len(a_bytes[a[0]]), len(b_bytes[b[0]])
    while True:
        found[a[i], b[j]] += 1
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            i += 1
            if i == len(a):
                return found
            end_a += len(a_bytes[a[i]])
        if step_b:
            j += 1
            end_b += len(b_bytes[b[j]])


class Aligner:
    """Groups of texts."""

    def __init__(self, vocab: str = VOCAB, model: str = MODEL):
        import tiktoken

        s = self.surfaces = Surfaces(vocab, model)
        self.library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=s.ranks, special_tokens={})
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (s.a, s.b))
        # an id as written within a group; its second half, as the last of A or of B
        self.a_said, self.b_said = (np.array([f"{i}{c}" for c in (",", last) for i in range(len(side))], object) for side, last in ((s.a, "|"), (s.b, ";")))

    def pieces(self, rest: str) -> list[int] | None:
        """B's ids of a space and the rest; None if they don't join to it."""
        ids = self.surfaces.pieces.encode(rest)
        return ids if b"".join(map(self.surfaces.b.__getitem__, ids)) == b" " + rest.encode() else None

    def groups(self, rest: str, b_ids: list[int]) -> str:
        """The groups of a space and the rest, joined."""
        a, b = np.array(self.library.encode_ordinary(" " + rest), np.int64), np.array(b_ids, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.zeros((2, a_end[-1] + 1), bool)
        at[0, a_end] = at[1, b_end] = True
        a_last, b_last = at[1, a_end], at[0, b_end]  # of their group
        a_stop, b_stop = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1  # of each group
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        said = np.empty(len(a) + len(b), object)
        said[np.arange(len(a)) + np.concatenate([[0], b_stop])[a_group]] = self.a_said[a + a_last * len(self.a_size)]
        said[np.arange(len(b)) + a_stop[b_group]] = self.b_said[b + b_last * len(self.b_size)]
        return "".join(said.tolist())[:-1]

    def segments(self, text: str) -> list[str]:
        """The text in segments, each without the space before it."""
        out, start = [], 0
        while self.surfaces.cuts and len(text) - start > SEGMENT and (m := _CUT.search(text, start + SEGMENT)):
            out.append(text[start : m.end()])
            start = m.end() + 1
        return [*out, text[start:]]

    def read(self, text: str) -> Iterator[str]:
        """The groups of each segment; none if B's tokens don't join to space + text."""
        parts = self.segments(text) if text else []
        if len(parts) > 1 and any(self.pieces(x) is None for x in parts):
            return
        for x in parts:
            if (b := self.pieces(x)) is not None:
                yield self.groups(x, b)


class Numbers(dict):
    """Each key's number, in the order in which they come."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


class Block:
    """Groups of some documents, interned."""

    def __init__(self):
        self.number, self.docs, self.n = Numbers(), [], 0

    def add(self, key: tuple, digest: str | None, found: list[str]) -> None:
        numbers = np.fromiter(map(self.number.__getitem__, found), "<u4", len(found))
        self.docs.append((*key, digest, numbers))
        self.n += len(found)

    def full(self) -> bool:
        return self.n >= BLOCK_GROUPS or len(self.number) >= BLOCK_DISTINCT

    def rows(self, name: int) -> Iterator[pa.RecordBatch]:
        """A row for each document's part, then one for each group."""
        kind = np.dtype("<u2" if len(self.number) <= 1 << 16 else "<u4")
        for at in range(0, len(self.docs), 2000):
            file, row, i, digest, numbers = zip(*self.docs[at : at + 2000], strict=True)
            yield _batch(len(file), name, {ROW_KEY[0]: file, ROW_KEY[1]: row, "id": i, "groups_sha256": digest, "width": [kind.itemsize] * len(file), "numbers": [x.astype(kind).tobytes() for x in numbers]})
        freq, said = np.zeros(len(self.number), np.int64), list(self.number)
        for at in range(0, len(self.docs), 2000):
            freq += np.bincount(np.concatenate([x[4] for x in self.docs[at : at + 2000]]), minlength=len(said))
        for at in range(0, len(said), 20_000):
            part = said[at : at + 20_000]
            yield _batch(len(part), name, {"number": range(at, at + len(part)), "said": part, "freq": freq[at : at + len(part)]})


KINDS = {"block": pa.int64(), ROW_KEY[0]: pa.int64(), ROW_KEY[1]: pa.int64(), "id": pa.int64(), "groups_sha256": pa.string(), "width": pa.int32(), "numbers": pa.binary(), "number": pa.int32(), "said": pa.string(), "freq": pa.int64()}
SCHEMA = ", ".join(f"{k} {({pa.int64(): 'long', pa.int32(): 'int', pa.string(): 'string', pa.binary(): 'binary'})[t]}" for k, t in KINDS.items())


def _batch(n: int, block: int, cols: dict) -> pa.RecordBatch:
    cols = {"block": [block] * n} | cols
    return pa.RecordBatch.from_arrays([pa.array(cols[k], t) if k in cols else pa.nulls(n, t) for k, t in KINDS.items()], list(KINDS))


def interned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB, model: str = MODEL) -> DataFrame:
    """Blocks: documents as numbers of groups, and each block's dictionary (rows with a group). Save it before use: names of blocks are those of one run."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n_blocks, block = TaskContext.get().partitionId(), 0, Block()
        for batch in batches:
            of = owned(f"align-{vocab}-{model}", lambda: Aligner(vocab, model))
            for file, row, i, raw in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
                digest, some = hashlib.sha256(), False
                for said in of.read((raw.as_py() or b"").decode("utf-8", "replace")):
                    digest.update(f"{';' * some}{said}".encode())
                    block.add((file, row, i), None, said.split(";"))
                    some = True
                    if block.full():
                        yield from block.rows(task << 32 | n_blocks)
                        n_blocks, block = n_blocks + 1, Block()
                block.add((file, row, i), digest.hexdigest() if some else "", [])
        if block.docs:
            yield from block.rows(task << 32 | n_blocks)

    bounded_batches(docs.sparkSession)
    rows = with_row_key(docs).select(*ROW_KEY, F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(read, SCHEMA)


def dictionary(blocks: DataFrame) -> DataFrame:
    """said, freq: each distinct group once."""
    return blocks.filter("said is not null").groupBy("said").agg(F.sum("freq").alias("freq"))


def expanded(distinct: DataFrame, vocab: str = VOCAB, model: str = MODEL) -> DataFrame:
    """said, freq, a, b, n: the links of each distinct group."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = owned(f"surfaces-{vocab}-{model}", lambda: Surfaces(vocab, model))
            for at in range(0, batch.num_rows, 5000):
                rows = [(g, freq, a, b, n) for g, freq in zip(*(c[at : at + 5000].to_pylist() for c in batch.columns), strict=True) for (a, b), n in links(g, of.a, of.b).items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["said", "freq", "a", "b", "n"])

    return distinct.select("said", "freq").mapInArrow(expand, "said string, freq long, a int, b int, n long")


def pair_counts(linked: DataFrame, n_pieces: int) -> DataFrame:
    """a, b, links, best: of how many links each id pair is, and whether none of b's has more. linked: of expanded()."""
    pairs = linked.groupBy("a", "b").agg(F.sum(F.col("freq") * F.col("n")).alias("links"))
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))  # a row an id of B at most
    return join_small(pairs, most, "b", "inner", n_pieces, 16).select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB, model: str = MODEL) -> DataFrame:
    """One row per row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = saved(interned(docs, id_col, text_col, vocab, model), "blocks")
    linked = saved(expanded(dictionary(blocks), vocab, model), "links")
    met = linked.join(pair_counts(linked, Surfaces(vocab, model).pieces.get_piece_size()), ["a", "b"])
    size = lambda side: F.size(F.split(F.substring_index("said", "|", side), ",")).cast("long")
    said = met.groupBy("said").agg(F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("links")).alias("count_sum"))
    said = said.withColumns({"n_a": size(1), "n_b": size(-1)})
    sums = ["n_a", "n_b", "n_links", "n_best", "count_sum"]
    back = blocks.filter("said is not null").select("block", "number", "said").join(said, "said").select("block", "number", *sums)
    parts = blocks.filter("said is null").select(F.col("block").alias("of_block"), *ROW_KEY, "id", "groups_sha256", "width", "numbers")

    def add_up(parts: pa.Table, known: pa.Table) -> pa.Table:
        at = known.column("number").to_numpy()
        of = np.zeros((at.max(initial=-1) + 1, len(sums)), np.int64)
        for k, c in enumerate(sums):
            of[at, k] = known.column(c).to_numpy()
        said = [np.frombuffer(x.as_py(), f"<u{w}") for x, w in zip(parts.column("numbers"), parts.column("width").to_pylist(), strict=True)]
        total = np.array([of[x].sum(axis=0) for x in said], np.int64).reshape(len(said), len(sums))
        cols = [*(parts.column(c) for c in (*ROW_KEY, "id", "groups_sha256")), pa.array([len(x) for x in said], pa.int64()), *(pa.array(total[:, k]) for k in range(len(sums)))]
        return pa.Table.from_arrays(cols, [*ROW_KEY, "id", "groups_sha256", "n_groups", *sums])

    schema = f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id long, groups_sha256 string, n_groups long, " + ", ".join(f"{c} long" for c in sums)
    added = parts.groupBy("of_block").cogroup(back.groupBy("block")).applyInArrow(add_up, schema)
    out = added.groupBy(*ROW_KEY).agg(F.first("id").alias("id"), *[F.sum(c).alias(c) for c in ("n_groups", *sums)], F.max("groups_sha256").alias("groups_sha256"))
    return out.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op11_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
