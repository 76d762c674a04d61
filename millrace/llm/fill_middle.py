"""Fill-in-middle transformation by a table-driven automaton over bytes.

A unit is a run of non-space with the white space before it; white space that ends a text is a unit too. One
automaton reads UTF-8 continuation, borders of units and the sentinels in a single scan: its transitions carry what
they emit (a unit ended, a code point began, a sentinel was completed), and a scan counts them. Texts are cut into
blocks that are scanned side by side. A block's entry state is that after the few bytes before it, since the state
after SYNC bytes doesn't depend on the state before them (compile_table() proves that for its table). From the counts
of the blocks follow the number of units, and the blocks that hold the cuts; a second pass reads only those again and
finds the bytes.

A text is left as it is (plain) if it is empty, holds a sentinel, or is not drawn; else its prefix, middle and suffix
are rearranged. The draws are digests of the seed and the identifier, so a document is always cut alike, on any cluster.

Null text counts as empty. A null identifier is drawn as an empty string is. Rows are independent: repeated rows and ties
give equal rows. Bytes that are no UTF-8 count as one code point each and come back as they were. Very long texts are
scanned a bounded number of blocks at a time. An empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, documents

#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of a block, and blocks that are scanned at once.
BLOCK, LANES = 512, 2048

PAD, SPACE, OPEN, LETTER, CLOSE, PLAIN, MORE, LEAD2, LEAD3, LEAD4 = range(10)
START, WHITE, WORD, OPENED, LETTERED, WANT1, WANT2, WANT3 = range(8)
#: What a transition emits, so that the counts of a block fit into one number.
UNIT, POINT, SENTINEL = 1, 1 << 10, 1 << 20


def byte_classes() -> np.ndarray:
    c = np.full(256, PLAIN, np.uint8)
    c[[0x20, *range(0x09, 0x0E)]] = SPACE
    c[PREFIX[0]], c[PREFIX[2]] = OPEN, CLOSE
    c[[s[1] for s in (PREFIX, SUFFIX, MIDDLE)]] = LETTER
    c[0x80:0xC0], c[0xC2:0xE0], c[0xE0:0xF0], c[0xF0:0xF5] = MORE, LEAD2, LEAD3, LEAD4
    return c


@cache
def compile_table() -> tuple[np.ndarray, np.ndarray, int]:
    """By state * 10 + class: the next state, and what the transition emits; then SYNC."""
    to, said = np.zeros((8, 10), np.uint8), np.zeros((8, 10), np.uint32)
    for state in range(8):
        to[state, PAD] = state
        for c in range(SPACE, 10):
            if c == MORE and state >= WANT1:
                to[state, c] = WORD if state == WANT1 else state - 1
                continue
            said[state, c] = POINT
            if c == SPACE:
                to[state, c] = WHITE
                said[state, c] += UNIT * (state >= WORD)
            elif c == OPEN:
                to[state, c] = OPENED
            elif c == LETTER and state == OPENED:
                to[state, c] = LETTERED
            else:
                to[state, c] = {LEAD2: WANT1, LEAD3: WANT2, LEAD4: WANT3}.get(c, WORD)
                said[state, c] += SENTINEL * (c == CLOSE and state == LETTERED)
    images, n = {frozenset(range(8))}, 0
    while any(len(x) > 1 for x in images):
        images, n = {frozenset(int(to[s, c]) for s in x) for x in images for c in range(SPACE, 10)}, n + 1
        if n > 64:
            raise ValueError("the automaton's state may depend on bytes far back")
    return to.ravel(), said.ravel(), n


class Scan:
    """The texts of a batch, cut into blocks, and what the first pass counted in each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """Text k is data[offsets[k] : offsets[k + 1]]."""
        self.to, self.said, self.sync = compile_table()
        self.data, self.classes = data, byte_classes()
        self.low, self.high = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
        n_blocks = -(-(self.high - self.low) // BLOCK)
        self.text = np.repeat(np.arange(len(n_blocks)), n_blocks)  # of each block
        self.first = np.concatenate([[0], np.cumsum(n_blocks)])  # block of each text
        self.at = self.low[self.text] + (np.arange(len(self.text)) - self.first[self.text]) * BLOCK
        counted = [self._counts(np.arange(k, min(k + LANES, len(self.at)))) for k in range(0, len(self.at), LANES)]
        total = np.concatenate([[0], *counted]).astype(np.int64)
        #: Units ended, code points begun and sentinels completed before each block, over the whole batch.
        self.units, self.points, self.sentinels = (np.cumsum(total // w % POINT) for w in (UNIT, POINT, SENTINEL))

    def _symbols(self, blocks: np.ndarray) -> np.ndarray:
        """One row a step, one column a block; SYNC bytes before each block come first."""
        of, at = self.text[blocks], self.at[blocks]
        place = np.arange(-self.sync, BLOCK)[:, None] + at
        inside = (place >= self.low[of]) & (place < self.high[of])
        return np.where(inside, self.classes[self.data[np.where(inside, place, 0)]], PAD)

    def _steps(self, blocks: np.ndarray) -> Iterator[np.ndarray]:
        """What the transitions emit at each byte of the blocks."""
        state = np.full(len(blocks), START, np.intp)
        for k, row in enumerate(self._symbols(blocks)):
            move = state * 10 + row
            state = self.to[move].astype(np.intp)
            if k >= self.sync:
                yield self.said[move]

    def _counts(self, blocks: np.ndarray) -> np.ndarray:
        total = np.zeros(len(blocks), np.uint32)
        for said in self._steps(blocks):
            total += said
        return total

    def per_text(self, counted: np.ndarray) -> np.ndarray:
        return counted[self.first[1:]] - counted[self.first[:-1]]

    def cuts(self, texts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of texts, where its unit number ends[i] (from 1, not its last) ends: byte of the text, code points before it."""
        rank = self.units[self.first[texts]] + ends
        block = np.searchsorted(self.units, rank, "left") - 1
        byte, point = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for k in range(0, len(block), LANES):
            part = slice(k, k + LANES)
            left = rank[part] - self.units[block[part]]
            seen = np.zeros(len(left), np.int64)
            for step, said in enumerate(self._steps(block[part])):
                open_ = seen < left
                seen += said & UNIT
                byte[part] += open_ & (seen < left)  # the unit ends before the byte that ends it
                point[part] += open_ & (seen < left) & (said & POINT > 0)
        return byte + self.at[block] - self.low[texts], point + self.points[block] - self.points[self.first[texts]]


def _arranged(text: bytes, form: str, a: int, b: int) -> bytes:
    if form == "psm":
        return PREFIX + text[:a] + SUFFIX + text[b:] + MIDDLE + text[a:b]
    return SUFFIX + text[b:] + PREFIX + text[:a] + MIDDLE + text[a:b]


def _draws(id_col: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 50, spm: int = 80, seed: int = 42) -> DataFrame:
    """id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output.

    share: per cent of texts that are rearranged; spm: per cent of those whose suffix comes first.
    """
    schema = "id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [x.as_py() or b"" for x in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)])
            scan = Scan(np.frombuffer(b"".join(texts) or b"\0", np.uint8), offsets)
            filled = offsets[1:] > offsets[:-1]
            n = scan.per_text(scan.units) + filled
            h1, h2, h3, h4 = (batch.column(2 + k).to_numpy() for k in range(4))
            low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
            form = np.where(~filled | (scan.per_text(scan.sentinels) > 0) | (h3 % 100 >= share), "plain", np.where(h4 % 100 < spm, "spm", "psm"))
            size, length = offsets[1:] - offsets[:-1], scan.per_text(scan.points)
            byte, char = [np.zeros(len(n), np.int64) for _ in "ab"], [np.zeros(len(n), np.int64) for _ in "ab"]
            for k, end in enumerate((low, high)):
                byte[k], char[k] = np.where(end == n, size, 0), np.where(end == n, length, 0)
                inner = np.flatnonzero((form != "plain") & (end > 0) & (end < n))
                byte[k][inner], char[k][inner] = scan.cuts(inner, end[inner])
            plain = form == "plain"
            for at in range(0, len(texts), 500):
                p = slice(at, at + 500)
                out = [t if f == "plain" else _arranged(t, f, a, b) for t, f, a, b in zip(texts[p], form[p].tolist(), byte[0][p].tolist(), byte[1][p].tolist(), strict=True)]
                cols = [batch.column(0)[p], pa.array(n[p], pa.int64()), pa.array(form[p].tolist(), pa.string()), pa.array(char[0][p], pa.int64(), mask=plain[p]), pa.array((char[1] - char[0])[p], pa.int64(), mask=plain[p]), pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names)

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"), *_draws(f"`{id_col}`", seed))
    return rows.mapInArrow(transform, schema).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The first of each sentinel is the one that was put there: the text holds none."""
    p, s, m = (F.instr(output, x.decode()) for x in (PREFIX, SUFFIX, MIDDLE))
    between = lambda a, b: F.substr(output, a + 3, b - a - 3)
    middle = F.substr(output, m + 3)
    return F.when(form == "psm", F.concat(between(p, s), middle, between(s, m))).when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle(documents(spark, sf_dir))
    text = restored(F.col("output"), F.col("form"))
    return out.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
