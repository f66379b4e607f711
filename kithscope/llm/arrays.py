"""Whole-batch arithmetic on text: words, lines and their hashes as numpy arrays over Arrow string buffers.

A batch of texts is one byte buffer with document offsets. Separators of words are ASCII bytes everywhere in this
subpackage, so UTF-8 can be cut byte by byte. Nulls are empty texts. Nothing here knows Spark; the operators call it
inside ``mapInArrow``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
"""Texts are worked off in slices of about this size (one longer text is a slice of its own)."""

_MASK = (1 << 64) - 1


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(chars, dtype=np.uint8)] = True
    return table


#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = separators(b" \t\n\x0b\x0c\r")
#: Every ASCII character but digits and letters (texts are lower-cased first).
NOT_ALNUM = separators(bytes(b for b in range(128) if not (chr(b).isdigit() or chr(b).islower())))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Texts(NamedTuple):
    """Bytes of consecutive documents; document i is buf[offs[i]:offs[i + 1]]."""

    buf: np.ndarray
    offs: np.ndarray


class Words(NamedTuple):
    """Byte ranges of words; the words of document i are first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(column: pa.Array, chunk: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(from row, to row, texts) over one Arrow string column."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + chunk, side="right")) - 1)
        yield lo, hi, Texts(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


def find_words(texts: Texts, table: np.ndarray) -> Words:
    buf, offs = texts
    n = len(buf)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~table[buf]
    border = np.zeros(n + 1, dtype=bool)
    border[offs] = True
    body = inside[1:-1]
    start = np.flatnonzero(body & (~inside[:-2] | border[:-1]))
    end = np.flatnonzero(body & (~inside[2:] | border[1:])) + 1
    return Words(start, end, np.searchsorted(start, offs))


def find_lines(texts: Texts) -> Words:
    """Ranges between line feeds; a text without any has one line, also when it is empty."""
    buf, offs = texts
    feeds = np.flatnonzero(buf == 10)
    docs = np.searchsorted(offs, feeds, side="right") - 1
    n = len(offs) - 1
    doc = np.concatenate([np.arange(n), docs])
    start = np.concatenate([offs[:-1], feeds + 1])
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    first = np.searchsorted(doc, np.arange(n + 1))
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[first[1:] - 1] = offs[1:]
    return Words(start, end, first)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, so that sums of products spread over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _stream(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 0xD1342543DE82EF95 + 1) & _MASK))


class SpanHash:
    """64-bit hashes of any ranges of a sequence, from prefix sums of value x multiplier^place (modulo 2^64).

    Two objects with different seeds hash independently of each other.
    """

    def __init__(self, seed: int) -> None:
        self.table = _stream(seed, 256)
        self.factor = int(_stream(seed + 101, 1)[0]) | 5
        self.inverse = pow(self.factor, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, factor in (("up", self.factor), ("down", self.inverse)):
                steps = np.full(n, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])

    def of_bytes(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.ranges(self.prefix(self.table[buf]), start, end)


HASH, SECOND = SpanHash(1), SpanHash(2)


def per_document(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of flags over each document's words."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def windows(words: Words, size: int) -> np.ndarray:
    """First words of all windows of ``size`` words that lie within one document."""
    n = int(words.first[-1])
    if n < size:
        return np.zeros(0, dtype=np.int64)
    stop = np.repeat(words.first[1:], np.diff(words.first))
    places = np.arange(n)
    return places[places + size <= stop]


def covered(starts: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in start:start + size of any start."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + size, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def code_points(buf: np.ndarray) -> np.ndarray:
    """Number of code points before each byte (one entry more than bytes)."""
    sums = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=sums[1:])
    return sums


def signed(x: np.ndarray) -> pa.Array:
    """Hashes as Spark's signed longs."""
    return pa.array(x.view(np.int64))
