"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays.

The texts of a batch are laid end to end as UTF-8 bytes with a separator between them; word borders,
word hashes and hashes of word sequences are then computed for all of them together, without a Python
object per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mix

# Odd multipliers (and their inverses modulo 2^64) of the polynomial hashes; any odd number will do.
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_ONE = np.uint64(1)

#: White space: the space and the bytes 09 to 0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class _Powers:
    """Growing tables of the powers of a base and of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            step = np.uint64(pow(self.base, size, 1 << 64)), np.uint64(pow(self.inverse, size, 1 << 64))
            self.up = np.concatenate((self.up, self.up * step[0]))
            self.down = np.concatenate((self.down, self.down * step[1]))
        return self.up[:n], self.down[:n]


_POWERS = {base: _Powers(base) for base in (*BYTE_BASES, *_WORD_BASES)}


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[s:e]`` for every (s, e), whatever its place; ranges may overlap: one running
    sum."""
    up, down = _POWERS[base].of(len(values) + 1)
    run = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=run[1:])
    return (run[ends] - run[starts]) * down[starts]


def block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, block: int = 1 << 16) -> np.ndarray:
    """:func:`range_hashes` of the bytes ``data[s:e]`` of disjoint ascending ranges, taken in blocks of ranges of about
    ``block`` bytes: power tables and running sums stay small, whatever the length of the data (a longer range is a
    block of its own)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + block, side="right")))
        values = data[a : int(ends[j - 1])].astype(np.uint64)
        values += _ONE
        out[i:j] = range_hashes(values, starts[i:j] - a, ends[i:j] - a, base)
        i = j
    return out


@dataclass
class Words:
    """Words of ``n_docs`` texts: the bytes, each word's borders in them, its hash and its text; words of text ``i``
    are ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    doc_starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, i: int) -> bytes:
        return self.data[self.doc_starts[i] : self.doc_starts[i + 1] - 1].tobytes()


def split_words(texts: list[str | None], separators: np.ndarray = SPACES, fold: np.ndarray | None = None) -> Words:
    """Cut texts (None: empty) into the maximal runs of bytes that are no separators.  ``fold`` maps
    bytes before hashing (lower case, say).  The byte 0A must be a separator."""
    raw = [b"" if t is None else t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    doc_starts = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=doc_starts[1:])
    if not raw:
        data = data[:0]
    word = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(separators[data], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[0::2], edge[1::2]
    hashes = mix(block_hashes(data if fold is None else fold[data], starts, ends, BYTE_BASES[0]) ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    first = np.searchsorted(starts, doc_starts)
    return Words(data, starts, ends, hashes, first.astype(np.int64), doc_starts)


def sequence_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0,
                    skip: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the word sequences ``starts[i]:ends[i]``, without word ``skip[i]`` if given; ``which``
    (0 or 1) picks one of two independent ones, together 128 bits."""
    length = (ends - starts).astype(np.uint64)
    values, base = hashes ^ (hashes >> np.uint64(7 + 22 * which)), _WORD_BASES[which]
    if skip is None:
        found = range_hashes(values, starts, ends, base)
    else:
        found = range_hashes(values, starts, skip, base) \
            + _POWERS[base].of(len(values) + 1)[0][skip - starts] * range_hashes(values, skip + 1, ends, base)
        length = length - _ONE
    return mix(found + length * np.uint64(0x2545F4914F6CDD1D))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
