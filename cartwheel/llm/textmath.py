"""Vectorised text work inside tasks: words of many documents at once, their 64-bit hashes, rolling
windows, and compact packing of sorted integers. Everything takes bounded pieces of text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers of the rolling and mixing hashes (fixed values: golden-ratio and splitmix constants).
MIX1, MIX2, MIX3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)  # a random code for each byte value
BYTE_STEP, STEP_A, STEP_B = (U(int(x) | 1) for x in _RNG.integers(0, 2**64, 3, dtype=np.uint64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> U(30))) * MIX2
    x = (x ^ (x >> U(27))) * MIX3
    return x ^ (x >> U(31))


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a list of documents (UTF-8 bytes).

    ``start``, ``end``: byte ranges in ``buf``; ``doc``: index of the document; ``hash``: 64 bits;
    ``first``: index of each document's first word, with one more entry at the end."""

    def __init__(self, docs: list[bytes], lower: bool = False):
        raw = np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)
        self.buf = LOWER[raw] if lower else raw
        ends = np.cumsum(np.fromiter((len(d) + 1 for d in docs), np.int64, len(docs)))
        space = IS_SPACE[self.buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(docs) + 1))
        self._space = space

    def __len__(self) -> int:
        return len(self.start)

    @property
    def hash(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        step = np.multiply.accumulate(np.concatenate([[U(1)], np.full(int(size.max()) - 1, BYTE_STEP, np.uint64)]))
        where = np.flatnonzero(~self._space)
        word_at = np.concatenate([[0], np.cumsum(size)])[:-1]
        code = BYTE_CODE[self.buf[where]] * step[np.arange(len(where)) - np.repeat(word_at, size)]
        return mix(np.add.reduceat(code, word_at) ^ (size.astype(np.uint64) * MIX1))


def rolling(h: np.ndarray, width: int, step: np.uint64) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values (windows over document ends included)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= step
        out += h[k:k + n]
    return mix(out)


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Positions at which a window of ``width`` words lies inside one document."""
    n = np.maximum(np.diff(first) - width + 1, 0)
    return np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """floor(h * buckets / 2^64): ascending hashes are in ascending buckets."""
    n = U(buckets)
    return ((h >> U(32)) * n + (((h & U(0xFFFFFFFF)) * n) >> U(32))) >> U(32)


def rest_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """h * buckets mod 2^64: with the bucket it tells the hash, and it ascends with the hash inside a bucket."""
    return h * U(buckets)


def slices(h: np.ndarray, buckets: int):
    """(bucket, from, to) of the runs of ascending hashes that share a bucket."""
    b = bucket_of(h, buckets)
    at = np.flatnonzero(np.diff(b, prepend=U(buckets)))
    for lo, hi in zip(at, [*at[1:], len(h)]):
        yield int(b[lo]), int(lo), int(hi)


_ZSTD = pa.Codec("zstd", compression_level=1)


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def expand(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return _ZSTD.decompress(blob[8:], size, asbytes=True) if size else b""


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed; ascending values should be passed as differences."""
    return squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()) if len(values) else squeeze(b"")


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(expand(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(blob, dtype), dtype=dtype)
