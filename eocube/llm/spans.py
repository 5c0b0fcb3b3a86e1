"""Numpy helpers over the UTF-8 bytes of a batch of texts: words, units and their hashes.

Texts of a batch lie in one byte buffer with offsets, as Arrow holds them. Ranges of any
length are hashed eight bytes at a time, each step a bijection of the 64 bits before it
(:func:`range_hashes`). :class:`Hasher` gives the hashes of all windows of one length from
running sums: byte ``i`` adds ``table[byte] * base**i`` modulo 2**64, so the difference at
the two ends of a range, divided by ``base**start``, depends on the bytes of the range alone.
Such sums are linear: texts of 1,024 bytes and more can be built that collide whatever the
base, so they serve short windows only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
PIECE_BYTES = 2 << 20
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
IS_GRAPHIC = np.zeros(256, bool)
IS_GRAPHIC[0x21:0x7F] = True


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a bijection of 64-bit values."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


BYTE_VALUE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` for ``i < n``; kept between calls up to the piece size."""
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        made = []
        for b in (BASE, pow(BASE, -1, 2**64)):
            p = np.full(size, U(b), U)
            p[0] = 1
            made.append(np.cumprod(p, dtype=U))
        if size > PIECE_BYTES + 1:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


LANES = 32
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], U)


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of a buffer as one number, zeros behind its end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of ranges of a buffer; those beyond ``LANES`` numbers go through blake2b."""
    view, left = lanes(buf), end - start
    h = mix((left.astype(U) + U(seed << 40)) * U(0xA24BAED4963EE407) + U(1))
    at = np.flatnonzero((left > 0) & (left <= 8 * LANES))
    place, left = start[at], left[at]
    while len(at):
        h[at] = mix(h[at] ^ (view[place] & _KEEP[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        at, place, left = at[more], place[more] + 8, left[more] - 8
    for i in np.flatnonzero(end - start > 8 * LANES).tolist():
        digest = hashlib.blake2b(buf[start[i] : end[i]], digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def same_ranges(
    a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray
) -> bool:
    """Whether all ranges of one buffer equal those of the other, byte by byte."""
    size = a_end - a_start
    if not (size == b_end - b_start).all():
        return False
    one, two = lanes(a), lanes(b)
    at = np.flatnonzero((size > 0) & (size <= 8 * LANES))
    p, q, left = a_start[at], b_start[at], size[at]
    while len(p):
        if ((one[p] ^ two[q]) & _KEEP[np.minimum(left, 8)]).any():
            return False
        more = left > 8
        p, q, left = p[more] + 8, q[more] + 8, left[more] - 8
    long = np.flatnonzero(size > 8 * LANES).tolist()
    return all(np.array_equal(a[a_start[i] : a_end[i]], b[b_start[i] : b_end[i]]) for i in long)


class Hasher:
    """Hashes of short ranges of one byte buffer."""

    def __init__(self, buf: np.ndarray):
        up, self.down = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U)
        np.cumsum(BYTE_VALUE[buf] * up[: len(buf)], out=self.sums[1:], dtype=U)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(U) * U(0xA24BAED4963EE407))

    def windows(self, length: int) -> np.ndarray:
        """The hash of the ``length`` bytes at each position that has them."""
        n = len(self.sums) - 1
        if n < length:
            return np.zeros(0, U)
        return mix((self.sums[length:] - self.sums[: n - length + 1]) * self.down[: n - length + 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    arr = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: first row, end row, bytes, offsets from 0."""
    buf, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j, buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space, and per row the index of its first."""
    ink = ~IS_SPACE[buf]
    before = np.empty(len(buf), bool)
    before[:1] = False
    before[1:] = ink[:-1]
    edge = offsets[:-1][offsets[:-1] < len(buf)]
    before[edge] = False
    start = np.flatnonzero(ink & ~before)
    after = np.empty(len(buf), bool)
    after[-1:] = False
    after[:-1] = ink[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    end = np.flatnonzero(ink & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def units(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut every text before white space that follows a printable character.

    No token of a byte-level pre-tokenizer spans such a place and no rule looks
    back over it, so a text encodes as its units do one after the other. A cut
    needs an ASCII printable byte or a two-byte Latin letter before it; elsewhere
    the unit just goes on.
    """
    n = len(buf)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        solid = IS_GRAPHIC[buf]
        solid[1:] |= (buf[:-1] == 0xC3) & (buf[1:] >= 0x80)
        cut[1:n] = IS_SPACE[buf[1:]] & solid[:-1]
    nonempty = offsets[:-1] < offsets[1:]
    cut[offsets[:-1][nonempty]] = True
    cut[n] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    return start, end[: len(start)], np.searchsorted(start, offsets)
