"""Word and byte hashes of many texts at once, as numpy arrays over Arrow buffers.

Tasks receive Arrow batches of texts; the helpers here look at all bytes of some texts together, so
nothing is done per word in Python.  Texts are cut into words, never into prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Base of the polynomial hashes; any odd number with well-spread bits serves.
BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes of text that are looked at together; a longer single text is taken alone.
PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words that are letters, digits or outside ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[ord("0") : ord("9") + 1] = True
ALPHANUMERIC[ord("a") : ord("z") + 1] = True
ALPHANUMERIC[128:] = True

#: Bytes of words that are anything but ASCII white space.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    y = x >> U64(30)
    y ^= x
    y *= U64(0xBF58476D1CE4E5B9)
    y ^= y >> U64(27)
    y *= U64(0x94D049BB133111EB)
    y ^= y >> U64(31)
    return y


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), PIECE + 65_536)
            inverse = pow(BASE, -1, 1 << 64)
            for name, base in (("up", BASE), ("down", inverse)):
                values = np.full(n, base, dtype=U64)
                values[0] = 1
                setattr(self, name, np.multiply.accumulate(values))
        return self.up, self.down


POWERS = _Powers()


class Texts(NamedTuple):
    """Some texts as one run of bytes; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray


def text_pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, Texts]]:
    """``column`` in runs of rows [first, last) with about ``limit`` bytes; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, Texts(values[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


class Words(NamedTuple):
    """The words of some texts: where each starts and ends, its text's number and its hash."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power before each position; differences give hashes of any span."""
    up, _ = POWERS.get(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    return sums


def words_of(texts: Texts, inside: np.ndarray, lower: bool = True) -> Words:
    """All words, which are the longest runs of bytes that ``inside`` marks, lower-cased before if wanted."""
    data, offsets = LOWER[texts.data] if lower else texts.data, texts.offsets
    n = len(data)
    word = np.zeros(n + 2, dtype=bool)
    word[1:-1] = inside[data]
    edge_before = word[1:-1] & ~word[:-2]
    edge_after = word[1:-1] & ~word[2:]
    inner = offsets[1:-1]
    at = inner[inner < n]
    edge_before[at] = word[1:-1][at]
    before = inner[inner > 0] - 1
    edge_after[before] = word[1:-1][before]
    starts, ends = np.flatnonzero(edge_before), np.flatnonzero(edge_after) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    sums = prefix_hashes(data)
    _, down = POWERS.get(n + 1)
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    counts = np.bincount(text, minlength=len(offsets) - 1)
    return Words(starts, ends, text, hashes, counts)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbours; the run may cross from one text to the next."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    total = np.full(n, U64(size), dtype=U64)
    for j in range(size):
        total = total * U64(BASE) + hashes[j : j + n]
    return mixed(total)


def set_bits(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether ``bitmap`` (64-bit words, a power of two of them) has the bit of each hash."""
    word = (hashes >> U64(6)) & U64(len(bitmap) - 1)
    return (bitmap[word.astype(np.int64)] >> (hashes & U64(63))) & U64(1) == U64(1)
