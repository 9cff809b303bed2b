"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

Both word classes used here are decided byte by byte (every byte of a non-ASCII character is a word
byte), so word borders and hashes need no Python strings. Memory is a small multiple of the batch,
and of the longest single text: byte-sized work is done in pieces of PIECE bytes cut between words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
CHUNK = 4 << 20

#: Runs of ASCII digits, lower-case ASCII letters and non-ASCII characters.
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Runs of anything but blank, tab, newline, vertical tab, form feed, carriage return.
SOLID = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut batches so that their `text` column holds about `limit` bytes, at least one row each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > start and total + size > limit:
                yield batch.slice(start, row - start)
                total, start = 0, row
            total += size
        yield batch.slice(start)


@dataclass
class Words:
    """Words of the texts of one chunk; `row` is the text of each word, `first` the first word of
    each text (one entry more than there are texts)."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def slice(self, a: int, b: int) -> bytes:
        """Bytes from the start of word a to the end of word b - 1."""
        return self.buffer[self.starts[a] : self.ends[b - 1]].tobytes()


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts of a column, each followed by one blank, and where each begins
    (one entry more than there are texts). Null is empty."""
    joined = pc.binary_join_element_wise(
        pc.fill_null(column, "").cast(pa.large_string()),
        pa.scalar("", pa.large_string()),
        pa.scalar(" ", pa.large_string()),
    )
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][: len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(column: pa.Array, word_bytes: np.ndarray, lower: bool = False) -> Words:
    """Words of a string column; null is empty."""
    data, offsets = spaced(column)
    buffer = LOWER[data] if lower else data
    inside = np.zeros(len(buffer) + 2, dtype=np.int8)
    inside[1:-1] = word_bytes[buffer]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    return Words(buffer, starts, ends, row, first)


def mix(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit of a 64-bit value over the whole."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers.get(0)
    if known is None or len(known[0]) < size:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[0] = known = (np.cumprod(up), np.cumprod(down))
    return known


def hash_words(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, equal for equal words whatever text or task they come from."""
    out = np.empty(len(words.starts), np.uint64)
    a, n = 0, len(out)
    while a < n:
        begin = words.starts[a]
        b = max(a + 1, int(np.searchsorted(words.ends, begin + PIECE, "right")))
        piece = words.buffer[begin : words.ends[b - 1]].astype(np.uint64) + np.uint64(1)
        up, down = _power_tables(max(PIECE, len(piece)))
        prefix = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * up[: len(piece)], out=prefix[1:])
        starts, ends = words.starts[a:b] - begin, words.ends[a:b] - begin
        sums = (prefix[ends] - prefix[starts]) * down[starts]
        out[a:b] = mix(sums + (ends - starts).astype(np.uint64))
        a = b
    return out


def roll(hashes: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every run of `size` neighbours, in time that grows with log2(size) only.

    Empty if there are fewer. Runs that cross texts are for the caller to leave out.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # out holds runs of `done` values; span holds runs of a power of two.
    span, width, power, done, out = hashes, 1, base, 0, None
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, done = span, width
            else:
                shifted = span[done : done + n]
                out = out[:n] + shifted * np.uint64(pow(base, done, 1 << 64))
                done += width
        rest >>= 1
        if rest:
            span = span[: len(span) - width] + span[width:] * np.uint64(power)
            power = power * power % (1 << 64)
            width *= 2
    return mix(out[:n])


def rightmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the rightmost smallest value of every window of `width` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)

    def better(pv, pi, qv, qi):
        take = qv <= pv
        return np.where(take, qv, pv), np.where(take, qi, pi)

    val, idx, done = values, np.arange(len(values)), 1
    while done * 2 <= width:
        val, idx = better(val[:-done], idx[:-done], val[done:], idx[done:])
        done *= 2
    if done < width:
        gap = width - done
        val, idx = better(val[:n], idx[:n], val[gap : gap + n], idx[gap : gap + n])
    return idx[:n]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
