"""Vectorised text primitives over Arrow buffers.

All word and window arithmetic works on the UTF-8 bytes of a record batch at once:
words are found with byte masks and hashed with prefix sums of a polynomial modulo
2**64, so no Python string exists per word. Slices keep the memory of a task bounded
whatever the size of a batch; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C55)
_BASE2 = U64(0xD1342543DE82EF95)
_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: One slice holds at most this many bytes of text, or a single longer text.
SLICE_BYTES = 2 << 20


def _table(keep) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], dtype=bool)


#: Bytes of a word: everything but the six ASCII white-space characters.
NON_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of a word after lower-casing: ASCII letters and digits, and all non-ASCII.
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
#: ASCII lower-casing.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if col.null_count:
        empty = b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else ""
        col = col.fill_null(empty)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Re-cut record batches so that each holds about `size` bytes of `column`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def powers(n: int, base: np.uint64 = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _CACHE.get(int(base))
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = U64(pow(int(base), -1, 1 << 64))
        grow = []
        for b in (base, inverse):
            x = np.full(size, b, U64)
            x[0] = 1
            grow.append(np.multiply.accumulate(x))
        have = (grow[0], grow[1])
        if size <= 1 << 23:
            _CACHE[int(base)] = have
    return have[0][:n], have[1][:n]


def prefix(values: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Prefix sums S of values[i] * base**i, S[0] = 0."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values.astype(U64, copy=False) * powers(len(values), base)[0], out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Position-independent hash of every [start, end) from its prefix sums."""
    return (sums[end] - sums[start]) * powers(len(sums), base)[1][start]


def rolling(values: np.ndarray, k: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of every k consecutive values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    s = prefix(values, base)
    return (s[k:] - s[:n]) * powers(len(s), base)[1][:n]


class Words:
    """The words of a slice: byte spans, owning text and a 64-bit hash each.

    `apart` are two more byte tables; words are also cut where bytes of both meet.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, table: np.ndarray, hashes: bool = True, apart: tuple[np.ndarray, np.ndarray] | None = None):
        member = table[data]
        before = np.zeros(len(data), bool)
        before[1:] = member[:-1]
        cuts = off[:-1][off[:-1] < len(data)]
        before[cuts] = False
        after = np.zeros(len(data), bool)
        after[:-1] = member[1:]
        ends = off[1:-1]
        after[ends[(ends > 0) & (ends <= len(data))] - 1] = False
        if apart is not None:
            one, two = apart[0][data], apart[1][data]
            cut = np.flatnonzero((one[:-1] & two[1:]) | (two[:-1] & one[1:]))
            before[cut + 1] = False
            after[cut] = False
        self.start = np.flatnonzero(member & ~before)
        self.end = np.flatnonzero(member & ~after) + 1
        self.off = np.searchsorted(self.start, off)  # first word of each text
        self.count = np.diff(self.off)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        if hashes:
            self.hash_of(data)

    def hash_of(self, data: np.ndarray) -> None:
        self.hash = mix(ranges(prefix(data.astype(U64) + U64(1)), self.start, self.end))


def windows(off: np.ndarray, k: int) -> np.ndarray:
    """Mask over the start of each k-window of the concatenated items: inside one text."""
    n = int(off[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    left = np.repeat(off[1:], np.diff(off))[:n]
    return left - np.arange(n) >= k


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
