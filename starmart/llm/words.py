"""Words and word windows of whole Arrow string columns, found with array operations inside tasks.

A column is taken apart in slices of about SLICE_BYTES of text, so that memory depends on the slice and on
the longest single text, never on the number of rows in a batch. Words are runs of bytes that no separator
table lists; UTF-8 needs no decoding for that, as every separator is ASCII. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000

#: The separators of `[^\x20\x09-\x0D]+`.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: The separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, applied after lower-casing A-Z.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[0x00:0x30] = NON_ALNUM[0x3A:0x61] = NON_ALNUM[0x7B:0x80] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n; base is odd, so it has an inverse."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = _POWERS[base] = np.cumprod(up), np.cumprod(down)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: byte ranges `start:end` in `data`; text i has the words `first[i]:first[i + 1]`."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        left, right = inside.copy(), inside.copy()
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        left[1:] &= ~inside[:-1] | cut[1:-1]
        right[:-1] &= ~inside[1:] | cut[1:-1]
        self.start = np.flatnonzero(left)
        self.end = np.flatnonzero(right) + 1
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        up, down = _powers(int(_BASE), n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[self.data] * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def windows(self, hashes: np.ndarray, size: int, base: int = 0xD1342543DE82EF95) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all windows of `size` words inside one text, and the windows' 64-bit hashes."""
        counts = np.maximum(self.counts - (size - 1), 0)
        start = np.repeat(self.first[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return start, self.window_at(hashes, start, size, base)

    def window_at(self, hashes: np.ndarray, start: np.ndarray, size: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
        n = len(hashes)
        up, down = _powers(base, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=total[1:])
        return mix((total[start + size] - total[start]) * down[start])

    def text_of(self, word: np.ndarray) -> np.ndarray:
        """The text that each word belongs to."""
        return np.searchsorted(self.first, word, "right") - 1

    def covered(self, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Words that lie in any of the windows."""
        edge = np.zeros(len(self) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + size, -1)
        return np.cumsum(edge[:-1]) > 0

    def joined(self, i: int, j: int) -> bytes:
        """Words i to j - 1, joined by one space."""
        raw = self.data[self.start[i] : self.end[j - 1]].tobytes() if j > i else b""
        base = int(self.start[i]) if j > i else 0
        return b" ".join(raw[a - base : b - base] for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True))

    def kept(self, i: int, keep: np.ndarray) -> bytes:
        """The words of text i that `keep` (over all words) marks, joined by one space."""
        a, b = int(self.first[i]), int(self.first[i + 1])
        if a == b:
            return b""
        base = int(self.start[a])
        raw = self.data[base : self.end[b - 1]].tobytes()
        word = np.flatnonzero(keep[a:b]) + a
        return b" ".join(raw[s - base : e - base] for s, e in zip(self.start[word].tolist(), self.end[word].tolist(), strict=True))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive slices with about `limit` bytes each; a longer text stands alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS, lower: bool = False) -> Words:
    return Words(_LOWER[data] if lower else data, offsets, separators)


def pack(x: np.ndarray) -> bytes:
    """Sorted unsigned integers as one byte of width, the first value, and the differences in that width."""
    if not len(x):
        return b""
    steps = np.diff(x)
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    return bytes([width]) + int(x[0]).to_bytes(8, "little") + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    width = raw[0]
    steps = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(steps) + 1, 8), np.uint8)
    wide[1:, :width] = steps
    out = wide.view("<u8").ravel()
    out[0] = int.from_bytes(raw[1:9], "little")
    return np.cumsum(out, dtype=np.uint64)


def pack_bits(x: np.ndarray) -> bytes:
    """Sorted unsigned integers below 2**63 as Rice codes of their differences: the bits left to the differences' remainders, how many they
    are, the first value, the quotients in unary, the remainders."""
    if not len(x):
        return b""
    steps = np.diff(x).astype(np.int64)
    low = max(0, int(steps.mean()).bit_length() - 1) if len(steps) else 0
    head = bytes([low]) + len(steps).to_bytes(8, "little") + int(x[0]).to_bytes(8, "little")
    ends = np.cumsum((steps >> low) + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    unary[ends - 1] = True
    rest = (steps[:, None] >> np.arange(low)) & 1
    return head + np.packbits(unary).tobytes() + np.packbits(rest.astype(bool)).tobytes()


def unpack_bits(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    low, n = raw[0], int.from_bytes(raw[1:9], "little")
    size = -(-n * low // 8)
    unary = np.unpackbits(np.frombuffer(raw, np.uint8, len(raw) - 17 - size, 17))
    rest = np.unpackbits(np.frombuffer(raw, np.uint8, size, len(raw) - size))[: n * low].reshape(n, low)
    out = np.zeros(n + 1, np.int64)
    out[0] = int.from_bytes(raw[9:17], "little")
    out[1:] = (np.diff(np.flatnonzero(unary), prepend=-1) - 1 << low) + (rest.astype(np.int64) << np.arange(low)).sum(axis=1)
    return np.cumsum(out).astype(np.uint64)
