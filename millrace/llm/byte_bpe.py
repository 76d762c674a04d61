"""Byte-level BPE ids of whole texts by the tokenizers library, with a memory of what it has encoded.

The library splits a text by a pattern before it merges, and no part that the pattern makes goes on
after a change from non-space to white space. So a text may be cut there, each cut piece encoded by
itself, and the ids joined: the same ids as for the whole text. Pieces repeat, so their ids are kept
(packed as little-endian integers) in each Python worker while its bytes last.

A text that holds a special token's string, or white space other than space, tab and line ends, is
encoded whole by the library.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import public_tokenizers
import regex

from millrace.llm.common import Budget, Memory, owned

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCAB = "byte_bpe_50k.json"

_IRREGULAR = re.compile(r"[ \n]{2}|[\t\r\x0b\x0c]|^[\n]|[ \n]$")
_RUNS = re.compile(r"\s*\S+|\s+")
_ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0 ᠎ -     　]")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class ByteBpe:
    """ids(text) -> packed little-endian ids; the integer type is the least that holds the vocabulary."""

    def __init__(self, vocab: str = VOCAB):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(vocab) if os.sep not in vocab else vocab)
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.alphabet = _byte_alphabet()
        self.space = self.alphabet[32]
        self.tokenize = self.library.model.tokenize
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        budget = Budget()
        self.parts = Memory(lambda part: (self._merge(part), True), budget)
        self.after_space = Memory(self._after_space, budget)
        self.runs = Memory(lambda run: (self._whole(run), True), budget)

    def _merge(self, part: str) -> bytes:
        """Ids of one part of the pattern, straight from the library's merges."""
        return self._packed(self.tokenize(part.encode().decode("latin-1").translate(self.alphabet)))

    def _packed(self, tokens) -> bytes:
        out = array(self.code, [t.id for t in tokens])
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _whole(self, run: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.pattern.findall(run)))

    def _after_space(self, piece: str) -> tuple[bytes, bool]:
        """Ids of a piece and the space before it (of one that starts with a line end, without a space; see ids())."""
        if piece.isalpha():
            return self._packed(self.tokenize(self.space + piece)) if piece.isascii() else self._merge(" " + piece), True
        word, end = piece[:-1], piece[-1:]
        if end in ".,;:!?" and word.isalpha():  # of words with a mark, only those whose word was known are kept
            known = word in self.after_space
            return self.after_space[word] + self.parts[end], known
        if piece[0] == "\n":
            word = piece[1:]
            return (self.parts["\n"] + self.parts[word], False) if word.isalpha() else (self._whole(piece), False)
        return self._whole(" " + piece), True

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD_SPACE.search(text) or self.special and self.special.search(text):
            return self._packed_ids(self.library.encode(text, add_special_tokens=False).ids)
        if _IRREGULAR.search(text):
            return b"".join(map(self.runs.__getitem__, _RUNS.findall(text)))
        # single spaces and line ends between words: cut at spaces, and before line ends
        pieces = text.replace("\n", " \n").split(" ")
        first = self.runs[pieces[0]] if pieces[0] else b""
        return first + b"".join(map(self.after_space.__getitem__, pieces[1:]))

    def _packed_ids(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()


def encoder(vocab: str = VOCAB) -> ByteBpe:
    """The encoder of a vocabulary in this Python process."""
    return owned(f"bytes-{vocab}", lambda: ByteBpe(vocab))
