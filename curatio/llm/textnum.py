"""Whole-batch text arithmetic on Arrow string buffers (numpy, in tasks).

A batch of texts is one byte buffer with row offsets. Words, lines and their
64-bit hashes are found for all rows of a chunk at once, so the cost per byte
is a few vector operations and the memory is bounded by the chunk size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BLOCK = 1 << 19
U = np.uint64


def _splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _tables(n: int):
    """Byte values, powers of an odd base and of its inverse (mod 2**64)."""
    with np.errstate(over="ignore"):
        byte = _splitmix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
        base = 0xD1342543DE82EF95
        inv = pow(base, -1, 1 << 64)
        power = np.full(n + 1, base, dtype=U)
        inverse = np.full(n + 1, inv, dtype=U)
        power[0] = inverse[0] = 1
        return byte, np.cumprod(power), np.cumprod(inverse)


class Hasher:
    """64-bit hashes of byte ranges, by prefix sums over blocks."""

    def __init__(self):
        self.byte, self.power, self.inverse = _tables(BLOCK)

    def ranges(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``buf[start:end]`` for sorted, disjoint ranges."""
        out = np.empty(len(start), dtype=U)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(start):
                a = int(start[i])
                j = max(i + 1, int(np.searchsorted(end, a + BLOCK, "right")))
                b = int(end[j - 1])
                if b - a > BLOCK:           # one range longer than a block
                    if b - a >= len(self.power):
                        self.byte, self.power, self.inverse = _tables(b - a)
                sums = np.zeros(b - a + 1, dtype=U)
                np.cumsum(self.byte[buf[a:b]] * self.power[:b - a], out=sums[1:])
                s, e = start[i:j] - a, end[i:j] - a
                out[i:j] = _splitmix((sums[e] - sums[s]) * self.inverse[s]
                                     + (e - s).astype(U) * U(0x2545F4914F6CDD1D))
                i = j
        return out


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Slices of a batch with about ``limit`` text bytes (one row at least)."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths.astype(np.int64))
    i = 0
    while i < batch.num_rows:
        before = int(total[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(i, j - i)
        i = j


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return t


#: Word bytes of ``[^\x20\x09-\x0D]+`` (UTF-8 lead and trail bytes are words).
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else as it is."""
    up = (buf >= 65) & (buf <= 90)
    return buf + (up.astype(np.uint8) << 5)


def runs(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """Maximal runs of member bytes inside each row: (start, end, row)."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = member[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(buf)]
    before[cut] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets[1:], start, "right")


def lines(buf: np.ndarray, offsets: np.ndarray):
    """``\\n``-split lines of each row: (start, end, row); every row has one."""
    n = len(offsets) - 1
    nl = np.flatnonzero(buf == 10)
    row = np.searchsorted(offsets[1:], nl, "right")
    start = np.concatenate([offsets[:-1], nl + 1])
    rows = np.concatenate([np.arange(n), row])
    order = np.lexsort((start, rows))
    start, rows = start[order], rows[order]
    end = np.empty_like(start)
    end[:-1] = np.where(rows[1:] == rows[:-1], start[1:] - 1, offsets[rows[:-1] + 1])
    if len(end):
        end[-1] = offsets[rows[-1] + 1]
    return start, end, rows


def windows(words: np.ndarray, row: np.ndarray, k: int):
    """Hashes of k consecutive words of one row: (hash, index of first word)."""
    if len(words) < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    n = len(words) - k + 1
    ok = np.flatnonzero(row[:n] == row[k - 1:])
    with np.errstate(over="ignore"):
        h = np.zeros(n, dtype=U)
        for j in range(k):
            h = h * U(0x9E3779B97F4A7C15) + words[j:j + n]
        return _splitmix(h[ok]), ok


def sequence_hash(words: np.ndarray) -> int:
    """Hash of one short word sequence (with its length)."""
    h = len(words)
    for w in words:
        h = (h * 0xC2B2AE3D27D4EB4F + int(w)) & 0xFFFFFFFFFFFFFFFF
    return int(_splitmix(np.array([h], dtype=U))[0])
