"""Longest common subsequences by bit-parallel rows."""

from __future__ import annotations

from collections.abc import Hashable, Sequence

import numpy as np


def common_places(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[int]:
    """Places in a of one longest common subsequence of a and b. What only one side has is left out first."""
    both = set(a) & set(b)
    places = [i for i, x in enumerate(a) if x in both]
    return [places[i] for i in _align([a[i] for i in places], [x for x in b if x in both])]


def common_length(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    both = set(a) & set(b)
    b = [x for x in b if x in both]
    return len(b) - _rows([x for x in a if x in both], b, False)[0].bit_count() if b else 0


def _rows(a: Sequence[Hashable], b: Sequence[Hashable], keep: bool) -> list[int]:
    """Bit j of row i is 0 where the longest common subsequence of a[:i] and b grows at b[j]; keep=False: the last row."""
    where: dict[Hashable, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, out = full, [full]
    for x in a:
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
        if keep:
            out.append(row)
        else:
            out[0] = row
    return out


def _align(a: Sequence[Hashable], b: Sequence[Hashable], most: int = 200_000_000) -> list[int]:
    """Halves a while all rows would take more than `most` bits, else keeps them and walks back."""
    if not a or not b:
        return []
    if len(a) * len(b) > most and len(a) > 1:
        half = len(a) // 2
        up, down = (_rows(x, y, False)[0] for x, y in ((a[:half], b), (a[half:][::-1], b[::-1])))
        grown = lambda row: np.concatenate([[0], np.cumsum([c == "0" for c in f"{row:0{len(b)}b}"[::-1]])])
        cut = int(np.argmax(grown(up) + grown(down)[::-1]))
        return _align(a[:half], b[:cut], most) + [half + i for i in _align(a[half:], b[cut:], most)]
    rows, i, j, out = _rows(a, b, True), len(a), len(b), []
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif (rows[i - 1] & (1 << j) - 1).bit_count() == (rows[i] & (1 << j) - 1).bit_count():
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]
