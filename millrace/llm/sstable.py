"""Sorted-string table: immutable file of (key, value) in key order, with lookup by binary search.

Layout: data blocks, Bloom filter, index block, footer.

* Block: entries (varint shared, varint rest, varint value size, rest of key, value); a key shares a
  prefix with the one before it, but for every 16th (a restart point); then the restart points
  (uint32 each), their number (uint32) and the crc32 of all before it (uint32).
* Index block: the same, with each data block's last key and, as value, its offset and size.
* Footer, 64 bytes: offsets and sizes of filter and index, number of entries, total of ids, bytes per
  id, number of filter hashes, crc32, magic.

Keys may repeat; get() returns each value of a key in file order.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np

MAGIC = b"MRSST001"
FOOTER = struct.Struct("<QQQQQQHHI8s")
RESTART_EVERY = 16
BLOCK_BYTES = 64 << 10
BITS_PER_KEY = 10
N_HASHES = 7


def key_of(doc_id: int | None) -> bytes:
    """Bytes that sort as the integers do; null before all."""
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    if n < 128:
        return bytes((n,))
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        x = b[at]
        at += 1
        n |= (x & 127) << shift
        if x < 128:
            return n, at
        shift += 7


class _Block:
    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.size, self.n, self.last, self.restarts = 0, 0, b"", []

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.n % RESTART_EVERY:
            for a, b in zip(key, self.last, strict=False):
                if a != b:
                    break
                shared += 1
        else:
            self.restarts.append(self.size)
        head = _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:]
        self.parts += (head, value)
        self.size += len(head) + len(value)
        self.n, self.last = self.n + 1, key

    def done(self) -> bytes:
        body = b"".join(self.parts) + struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
        return body + struct.pack("<I", zlib.crc32(body))


def _checked(raw: bytes) -> tuple[memoryview, list[int]]:
    if zlib.crc32(memoryview(raw)[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise ValueError("damaged block")
    (n,) = struct.unpack("<I", raw[-8:-4])
    end = len(raw) - 8 - 4 * n
    return memoryview(raw)[:end], list(struct.unpack(f"<{n}I", raw[end:-8]))


def _entries(body: memoryview, at: int = 0) -> Iterator[tuple[bytes, memoryview]]:
    key = b""
    while at < len(body):
        shared, at = _read_varint(body, at)
        rest, at = _read_varint(body, at)
        size, at = _read_varint(body, at)
        key = key[:shared] + bytes(body[at : at + rest])
        at += rest
        yield key, body[at : at + size]
        at += size


def _find(raw: bytes, key: bytes) -> Iterator[tuple[bytes, memoryview]]:
    """Entries from the first whose key isn't below the given one: binary search over the restart points, then a scan."""
    body, restarts = _checked(raw)
    lo, hi = 0, len(restarts) - 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if next(_entries(body, restarts[mid]))[0] < key:
            lo = mid
        else:
            hi = mid - 1
    for k, v in _entries(body, restarts[lo]) if restarts else ():
        if k >= key:
            yield k, v


def _hashes(keys: list[bytes], n_bits: int, n_hashes: int) -> np.ndarray:
    two = np.array([(zlib.crc32(k), zlib.crc32(k, 0x9E3779B9)) for k in keys], np.uint64).reshape(-1, 2)
    return (two[:, :1] + np.arange(n_hashes, dtype=np.uint64) * (two[:, 1:] | np.uint64(1))) % np.uint64(n_bits)


class Writer:
    """add() keys in order to an open binary stream, then close()."""

    def __init__(self, out, id_bytes: int, block_bytes: int = BLOCK_BYTES):
        self.out, self.id_bytes, self.block_bytes = out, id_bytes, block_bytes
        self.block, self.index, self.at = _Block(), _Block(), 0
        self.keys: list[bytes] = []
        self.first: bytes | None = None
        self.last, self.n, self.n_ids = b"", 0, 0

    def add(self, key: bytes, value: bytes) -> None:
        if self.n and key < self.last:
            raise ValueError("keys must not decrease")
        if self.first is None:
            self.first = key
        self.block.add(key, value)
        self.keys.append(key)
        self.last, self.n, self.n_ids = key, self.n + 1, self.n_ids + len(value) // self.id_bytes
        if self.block.size >= self.block_bytes:
            self._flush()

    def _write(self, raw: bytes) -> tuple[int, int]:
        self.out.write(raw)
        self.at += len(raw)
        return self.at - len(raw), len(raw)

    def _flush(self) -> None:
        if self.block.n:
            self.index.add(self.last, struct.pack("<QQ", *self._write(self.block.done())))
            self.block = _Block()

    def close(self) -> None:
        self._flush()
        n_bits = max(64, BITS_PER_KEY * len(self.keys))
        bits = np.zeros((n_bits + 7) // 8 * 8, np.uint8)
        bits[_hashes(self.keys, n_bits, N_HASHES).ravel().astype(np.int64)] = 1
        bloom = self._write(struct.pack("<Q", n_bits) + np.packbits(bits, bitorder="little").tobytes())
        index = self._write(self.index.done())
        head = FOOTER.pack(*bloom, *index, self.n, self.n_ids, self.id_bytes, N_HASHES, 0, MAGIC)
        self._write(FOOTER.pack(*bloom, *index, self.n, self.n_ids, self.id_bytes, N_HASHES, zlib.crc32(head), MAGIC))


class Reader:
    """Reads an open random-access file (size(), read_at(n, offset)) block by block."""

    def __init__(self, file):
        self.file = file
        raw = file.read_at(FOOTER.size, file.size() - FOOTER.size)
        *parts, self.n, self.n_ids, self.id_bytes, self.n_hashes, crc, magic = FOOTER.unpack(raw)
        if magic != MAGIC or zlib.crc32(FOOTER.pack(*parts, self.n, self.n_ids, self.id_bytes, self.n_hashes, 0, MAGIC)) != crc:
            raise ValueError("not a whole table")
        self.bloom_at, self.index_at = parts[:2], parts[2:]
        self._bloom: bytes | None = None
        self._index: bytes | None = None

    def _read(self, at: int, size: int) -> bytes:
        return bytes(self.file.read_at(size, at))

    @property
    def index(self) -> bytes:
        if self._index is None:
            self._index = self._read(*self.index_at)
        return self._index

    def may_have(self, key: bytes) -> bool:
        if self._bloom is None:
            self._bloom = self._read(*self.bloom_at)
        (n_bits,) = struct.unpack("<Q", self._bloom[:8])
        return all(self._bloom[8 + int(h) // 8] >> (int(h) % 8) & 1 for h in _hashes([key], n_bits, self.n_hashes)[0])

    def get(self, key: bytes) -> list[bytes]:
        found: list[bytes] = []
        if not self.may_have(key):
            return found
        for _, where in _find(self.index, key):
            for k, v in _find(self._read(*struct.unpack("<QQ", where)), key):
                if k != key:
                    return found
                found.append(bytes(v))
        return found

    def __iter__(self) -> Iterator[tuple[bytes, memoryview]]:
        for _, where in _entries(_checked(self.index)[0]):
            yield from _entries(_checked(self._read(*struct.unpack("<QQ", where)))[0])


def shard_of(firsts: list[bytes], lasts: list[bytes], key: bytes) -> range:
    """The shards, in key order, whose range of keys holds key."""
    lo = bisect_left(lasts, key)
    hi = lo
    while hi < len(firsts) and firsts[hi] <= key:
        hi += 1
    return range(lo, hi)
