"""Vectorised text primitives for Arrow batches: word spans, rolling hashes, word shingles.

Everything works on the UTF-8 bytes of a whole Arrow string column at once, so no per-word Python
code runs. A word is a maximal run of bytes outside space and ``\\t \\n \\v \\f \\r`` (the pattern
``[^\\x20\\x09-\\x0D]+``); no character's UTF-8 form holds those bytes elsewhere, so byte runs and
character runs agree. Null texts count as empty.

Hashes are 64-bit polynomial hashes (odd base, arithmetic modulo 2**64) finished with a bit mixer;
they do not depend on the process, the batch or the position of the text in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
SHINGLE_MUL = np.uint64(0xC2B2AE3D27D4EB4F)
CHUNK_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x80:] = True
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _ALNUM[_lo : _hi + 1] = True

_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        table = np.full(size, np.uint64(base), dtype=np.uint64)
        table[0] = 1
        have = _powers[name] = np.multiply.accumulate(table)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column of a batch, null as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def chunks(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) covering the array, each of about ``limit`` bytes of text (one row at least)."""
    off = np.frombuffer(arr.buffers()[1], dtype=np.int32)[arr.offset : arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int32)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(off, int(off[i]) + limit, side="right")) - 1)
        yield i, min(j, len(arr))
        i = j


class Text:
    """The bytes of a slice of a string column: ``data`` and the rows' byte ``offsets``."""

    def __init__(self, arr: pa.Array, lower: bool = False):
        arr = arr if isinstance(arr, pa.Array) else pa.array(arr, type=pa.string())
        if arr.null_count:
            arr = pc.fill_null(arr, "")
        if lower:
            arr = pc.utf8_lower(arr)
        self.n, self._sum = len(arr), None
        if self.n == 0:
            self.offsets, self.data = np.zeros(1, np.int64), np.zeros(0, np.uint8)
            return
        off = np.frombuffer(arr.buffers()[1], dtype=np.int32)[arr.offset : arr.offset + self.n + 1].astype(np.int64)
        raw = arr.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.data = data[off[0] : off[-1]]
        self.offsets = off - off[0]

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes marked ``inside``, never across rows: starts, ends, row of each."""
        n = len(self.data)
        if n == 0:
            z = np.zeros(0, np.int64)
            return z, z, z
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = self.offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1

    def words(self):
        return self.spans(~_SPACE[self.data])

    def alnum_words(self):
        return self.spans(_ALNUM[self.data])

    def hash(self, starts: np.ndarray, ends: np.ndarray, mixed: bool = True) -> np.ndarray:
        """Position-independent 64-bit hashes of byte spans."""
        n = len(self.data)
        if self._sum is None:
            acc = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power_table("fwd", BASE, n) if n else acc[1:], out=acc[1:])
            self._sum = acc
        h = (self._sum[ends] - self._sum[starts]) * _power_table("inv", BASE_INV, n + 1)[starts]
        return mix(h) if mixed else h


def shingles(word_hash: np.ndarray, row: np.ndarray, n_rows: int, width: int = 5):
    """Hashes of every ``width`` consecutive words of a row, and each shingle's row. A row with fewer
    words (one at least) has one shingle over all its words; a row without words has none."""
    m = len(word_hash)
    counts = np.bincount(row, minlength=n_rows) if m else np.zeros(n_rows, np.int64)
    if m == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    take = np.minimum(counts, width)
    first = np.cumsum(counts) - counts
    n_sh = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    total = int(n_sh.sum())
    sh_row = np.repeat(np.arange(n_rows), n_sh)
    pos = np.arange(total) - np.repeat(np.cumsum(n_sh) - n_sh, n_sh) + np.repeat(first, n_sh)
    acc = np.zeros(total, np.uint64)
    width_of = take[sh_row]
    for k in range(width):
        idx = np.minimum(pos + k, m - 1)
        acc = np.where(k < width_of, acc * SHINGLE_MUL + word_hash[idx], acc)
    return mix(acc), sh_row


def segment_starts(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Start of each row's items in an array sorted by row; the last entry is the length."""
    return np.searchsorted(row, np.arange(n_rows + 1))
