"""Words of whole texts as numpy arrays, many texts at a time.

A batch of texts is one run of bytes with offsets, as Arrow has it.  Work goes
over slices of a few megabytes, and within them over chunks cut where no word is,
so memory follows the slice and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20
CHUNK = 1 << 16  # bytes that words are cut from at a time, so that all steps stay in cache
EVEN = 64  # hashes that may share their leading bits
GAP = r"[\x20\x09-\x0D]+"  # between words, in Spark's regular expressions

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
CASED = np.arange(256, dtype=np.uint8)
# All ASCII characters that are neither letters nor digits.
NOT_LETTERS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Words(NamedTuple):
    hash: np.ndarray  # uint64, of the bytes, by default with A-Z lower-cased
    row: np.ndarray  # which text
    start: np.ndarray  # first byte, in the slice's data
    length: np.ndarray


def lower_ascii(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def held_out(doc_id: Column, folds: int, fold: int = 0) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id is in none."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(rest == fold, F.lit(False))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(
    column: pa.Array, size: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` bytes, at least one row each."""
    data, offsets = texts(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """BASE, or another number, to the powers 0 to n, modulo 2**64."""
    out = np.full(n + 1, base)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _common_powers() -> tuple[np.ndarray, np.ndarray]:
    return powers(CHUNK), powers(CHUNK, INVERSE)


def _chunk_words(
    data: np.ndarray, text_starts: np.ndarray, separator: np.ndarray, value: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A byte counts with the power of its place in the chunk, and the word's sum is
    divided by the power of its first place."""
    gap = separator.take(data)
    begin, last = ~gap, ~gap
    begin[1:] &= gap[:-1]
    begin[text_starts] = ~gap[text_starts]
    start = np.flatnonzero(begin)
    if not len(start):
        return np.zeros(0, np.uint64), start, start
    last[:-1] &= gap[1:]
    inner = text_starts[text_starts > 0]
    last[inner - 1] |= ~gap[inner - 1]
    length = np.flatnonzero(last) - start + 1
    total = value.take(data)
    up, down = _common_powers()
    if len(data) > len(up):  # a long word
        total *= powers(len(data))[:-1]
        down = powers(int(start[-1]), INVERSE)
    else:
        total *= up[: len(data)]
    return mix(np.add.reduceat(total, start) * down[start]), start, length


def _cut(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, separator: np.ndarray) -> int:
    """The last place in (lo, hi] where no word is cut, or the first one after."""
    text = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
    if text > lo:
        return text
    spaces = np.flatnonzero(separator[data[lo + 1 : hi]])
    if len(spaces):
        return lo + 1 + int(spaces[-1])
    end = int(offsets[np.searchsorted(offsets, lo, "right")])
    for at in range(hi, end, CHUNK):
        spaces = np.flatnonzero(separator[data[at : min(at + CHUNK, end)]])
        if len(spaces):
            return at + int(spaces[0])
    return end


def split(
    data: np.ndarray,
    offsets: np.ndarray,
    separator: np.ndarray = SPACE,
    case: np.ndarray = LOWER,
) -> Words:
    """The words of a slice, in order; texts are apart even without white space."""
    found = []
    value = case.astype(np.uint64) + np.uint64(1)
    value[separator] = 0
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + CHUNK, n)
        if hi < n:
            hi = _cut(data, offsets, lo, hi, separator)
        first, end = np.searchsorted(offsets, [lo, hi])
        inside = offsets[first:end] - lo
        hashes, start, length = _chunk_words(data[lo:hi], inside, separator, value)
        found.append((hashes, start + lo, length))
        lo = hi
    if not found:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none)
    hashes, start, length = (np.concatenate(x) for x in zip(*found, strict=True))
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(hashes, row, start, length)


class Places:
    """``np.searchsorted`` in ascending hashes.  As hashes are spread evenly, their leading
    bits nearly say the place; where they are not, it is searched for."""

    def __init__(self, known: np.ndarray):
        bits = len(known).bit_length() + 2  # several runs of leading bits a hash
        self.known = np.append(known, np.uint64((1 << 64) - 1))  # which no hash is above
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.even = np.diff(self.first, append=len(known)).max() <= EVEN

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not self.even:
            return np.searchsorted(self.known[:-1], hashes)
        at = self.first.take((hashes >> self.shift).astype(np.intp))
        below = np.flatnonzero(self.known.take(at) < hashes)
        while len(below):
            at[below] += 1
            below = below[self.known.take(at[below]) < hashes[below]]
        return at


def bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's entries begin in a sorted row column; one more for the end."""
    return np.searchsorted(row, np.arange(rows + 1))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k consecutive words from each place on, over the row's end too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = powers(k)[1:]
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += hashes[j : j + n] * odd[j]
    return mix(out)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct shingles of one text; fewer than k words make one shingle, none makes none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(shingles(hashes, min(k, len(hashes))))
