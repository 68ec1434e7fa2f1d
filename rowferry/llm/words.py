"""Words of a whole Arrow batch as 64-bit hashes, made with numpy.

A word is a run of bytes other than space and 0x09 to 0x0D, with A to Z lower
cased. All words of a batch are hashed together, eight bytes at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORDS = np.ones(256, np.uint8)
_WORDS[[9, 10, 11, 12, 13, 32]] = 0

# Kinds of bytes for tokens: letters, digits, and each mark on its own. All
# digits count as one, and case is kept.
_DIGITS = np.arange(256, dtype=np.uint8)
_DIGITS[48:58] = 48
_TOKENS = np.arange(256, dtype=np.uint8)
_TOKENS[[9, 10, 11, 12, 13, 32]] = 0
_TOKENS[65:91] = _TOKENS[97:123] = _TOKENS[128:] = 1
_TOKENS[48:58] = 2
# Low bytes kept of a block that ends after 0 to 7 bytes.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)], np.uint64)

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_MANY = np.uint64(0xD6E8FEB86659FD93)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scramble of 64-bit values, another for each seed."""
    x = values + np.uint64((seed + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the row bounds in them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8, int(bounds[-1]))[int(bounds[0]):], bounds - bounds[0]


class Words:
    """Hashes of all words of a batch; row ``i`` has those from ``rows[i]`` to ``rows[i + 1]``.

    ``starts`` and ``ends`` are byte positions in ``data``, row ``i`` of which
    begins at ``bounds[i]``.
    """

    kinds, letters = _WORDS, _LOWER

    def __init__(self, column: pa.Array):
        self.data, self.bounds = byte_rows(column)
        size = self.data.size
        kinds = self.kinds[self.data]
        inside = kinds > 0
        begins, ends = inside.copy(), inside.copy()
        change = kinds[1:] != kinds[:-1]
        begins[1:] &= change
        ends[:-1] &= change
        edges = self.bounds[(self.bounds > 0) & (self.bounds < size)]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.rows = np.searchsorted(self.starts, self.bounds)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        padded = np.zeros(self.data.size + 8, np.uint8)
        np.take(self.letters, self.data, out=padded[:self.data.size])
        blocks = np.ndarray(self.data.size + 1, "<u8", padded, strides=(1,))
        left = self.ends - self.starts
        found = left.astype(np.uint64) * _MANY
        live, at = None, self.starts
        while True:
            part = blocks[at]
            short = left < 8
            part[short] &= _KEEP[left[short]]
            if live is None:
                found = mixed(found ^ part)
                live = np.flatnonzero(left > 8)
                at, left = at[live] + 8, left[live] - 8
            else:
                found[live] = mixed(found[live] ^ part)
                more = left > 8
                live, at, left = live[more], at[more] + 8, left[more] - 8
            if not live.size:
                return found


class Tokens(Words):
    """The same for runs of letters, of digits, and of one mark, with their case."""

    kinds, letters = _TOKENS, _DIGITS


def runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words, and the bounds of rows in them.

    A row with fewer words, but at least one, gives one hash of them all.
    """
    hashes, rows = words.hashes, words.rows
    counts = np.diff(rows)
    many = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(many)))
    found = np.empty(int(bounds[-1]), np.uint64)
    if hashes.size >= length:
        rolled = np.zeros(hashes.size - length + 1, np.uint64)
        for step in range(length):
            rolled *= _MANY
            rolled += hashes[step:step + rolled.size]
        rolled = mixed(rolled, length)
    for row in range(counts.size):
        if counts[row] >= length:
            found[bounds[row]:bounds[row + 1]] = rolled[rows[row]:rows[row] + many[row]]
        elif counts[row]:
            own = np.zeros(1, np.uint64)
            for value in hashes[rows[row]:rows[row + 1]]:
                own = own * _MANY + value
            found[bounds[row]] = mixed(own, int(counts[row]))[0]
    return found, bounds


def distinct_runs(words: Words, length: int) -> list[np.ndarray]:
    """The ascending distinct run hashes of each row."""
    found, bounds = runs(words, length)
    return [np.unique(found[bounds[i]:bounds[i + 1]]) for i in range(bounds.size - 1)]
