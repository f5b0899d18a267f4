"""Vectorised work on the bytes of an Arrow text column.

A batch is cut into blocks of rows with a bounded number of bytes, and each block is handled as one byte array:
words, hashes and sliding minima are array operations over the whole block, whatever the rows' lengths. Only a
single row that is larger than the bound makes a larger block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20
# spans up to so many bytes are hashed side by side, longer ones each on their own
SHORT_SPAN = 64
# The multipliers of the splitmix64 finaliser, and an odd base for sequences of hashes
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0x5851F42D4C957F2D
_U64 = (1 << 64) - 1

def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit over the output."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX_1
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX_2
    return values ^ (values >> np.uint64(31))


_BYTE_CODES = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_GOLDEN))
# the first n of eight bytes, by n
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Block:
    """Some consecutive rows as one byte array: row ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, first_row: int, data: np.ndarray, offsets: np.ndarray):
        self.first_row, self.data, self.offsets = first_row, data, offsets
        self.rows = len(offsets) - 1
        self._eights: np.ndarray | None = None

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans, equal for equal bytes wherever they stand.

        Eight bytes at a time go into two sums, which are stirred in different ways and joined at the end, so that no
        pattern of the bytes makes two spans equal, as it does for polynomials modulo a power of two.
        """
        if self._eights is None:
            padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
            self._eights = np.ndarray(len(self.data) + 1, dtype="<u8", buffer=padded, strides=(1,))
        sizes = ends - starts
        one = mix(sizes.astype(np.uint64) + np.uint64(_GOLDEN))
        two = mix(one + np.uint64(_GOLDEN))
        left = np.flatnonzero((sizes > 0) & (sizes <= SHORT_SPAN))
        for done in range(0, SHORT_SPAN, 8):
            left = left[sizes[left] > done]
            if not len(left):
                break
            eight = self._eights[starts[left] + done] & _FIRST_BYTES[np.minimum(sizes[left] - done, 8)]
            one[left] = mix(one[left] ^ eight)
            two[left] = mix(two[left] * _MIX_1 + eight)
        for k in np.flatnonzero(sizes > SHORT_SPAN).tolist():
            whole = self.data[starts[k] : ends[k]].tobytes()
            one[k], two[k] = xxhash.xxh3_64_intdigest(whole), xxhash.xxh64_intdigest(whole)
        return mix(one ^ ((two << np.uint64(29)) | (two >> np.uint64(35))))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words (runs without white space), and the first word of each row."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(self.rows + 1, np.int64)
        black = ~WHITE[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], black[:-1]))
        after = np.concatenate((black[1:], [False]))
        starts = np.flatnonzero(black & (~before | edge[:-1]))
        ends = np.flatnonzero(black & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)


def blocks(column: pa.Array, lower: bool = False, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's rows in blocks of about ``limit`` bytes; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    all_offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    body = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(all_offsets, all_offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        offsets = all_offsets[row : end + 1]
        data = body[offsets[0] : offsets[-1]]
        yield Block(row, LOWER[data] if lower else data, offsets - offsets[0])
        row = end


def sequence_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes, at the place of the first; shorter than ``words`` by size - 1."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = np.uint64(_BASE)
    out = words[:count].copy()
    for step in range(1, size):
        out = out * base + words[step : step + count]
    return mix(out)


def row_of(positions: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The row of each position, where ``firsts`` has the first position of every row and the end."""
    return np.searchsorted(firsts, positions, side="right") - 1


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
