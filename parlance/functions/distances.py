"""Edit distances of long sequences: bit-parallel rows, in a band that doubles until the distance fits.

A row of the table of distances is two whole numbers of one bit a row (up and down steps), so a step costs as many
machine words as the band is wide, divided by 64. Nothing but one row is kept. Sequences with few edits never see more
than a narrow band around the diagonal: an hour's transcript against its correction takes a second.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_BAND = 64


def edits(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """Insertions, deletions and substitutions that turn a into b, at least."""
    head, most = 0, min(len(a), len(b))
    while head < most and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    where: dict[Hashable, int] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    rows = {x: _bits(at, len(a)) for x, at in where.items()}
    band = max(FIRST_BAND, 2 * (len(a) - len(b)))
    while 2 * band + 1 < len(a):
        found = _in_band(rows, len(a), b, band)
        if found <= band:
            return found
        band *= 2
    return _in_full(rows, len(a), b)


def _bits(at: list[int], size: int) -> int:
    held = bytearray(size // 8 + 1)
    for i in at:
        held[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(held, "little")


def _in_full(rows: dict[Hashable, int], size: int, b: Sequence[Hashable]) -> int:
    """The exact distance, from all rows of the table."""
    full, last = (1 << size) - 1, 1 << (size - 1)
    up, down, distance = full, 0, size
    for x in b:
        same = rows.get(x, 0)
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right, left = down | (full ^ (diagonal | up)), diagonal & up
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right, left = (right << 1 | 1) & full, (left << 1) & full
        up, down = left | (full ^ (diagonal | right)), diagonal & right
    return distance


def _in_band(rows: dict[Hashable, int], size: int, b: Sequence[Hashable], band: int) -> int:
    """The distance if it is at most band, else a larger number: the window of rows moves down by one with every column."""
    width = 2 * band + 1
    full, bottom = (1 << width) - 1, 1 << (width - 1)
    up, down, distance = full ^ ((1 << band) - 1), 0, band
    first = -band  # the row at the window's top
    last = bottom >> 1  # the last row, once the window's bottom has left it behind
    for column, x in enumerate(b):
        same = rows.get(x, 0)
        same = (same >> first if first >= 0 else same << -first) & full
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right, left = down | (full ^ (diagonal | up)), diagonal & up
        if column < size - band:
            distance += not diagonal & bottom
        else:
            distance += bool(right & last) - bool(left & last)
            last >>= 1
        diagonal >>= 1
        up, down = left | (full ^ (diagonal | right)), diagonal & right
        first += 1
    return distance


@F.arrow_udf(T.LongType())
def text_edits(a: pa.Array, b: pa.Array) -> pa.Array:
    """Of two columns of texts, in code points; null if one is."""
    return pa.array([None if x is None or y is None else edits(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int64())


@F.arrow_udf(T.LongType())
def list_edits(a: pa.Array, b: pa.Array) -> pa.Array:
    """Of two columns of arrays of strings; null if one is."""
    codes = pa.concat_arrays([a.flatten(), b.flatten()]).dictionary_encode().indices.to_pylist()
    found, at, of_b = [], 0, len(a.flatten())
    for x, y in zip(a, b, strict=True):
        n, m = len(x) if x.is_valid else 0, len(y) if y.is_valid else 0
        found.append(edits(codes[at : at + n], codes[of_b : of_b + m]) if x.is_valid and y.is_valid else None)
        at, of_b = at + n, of_b + m
    return pa.array(found, pa.int64())
