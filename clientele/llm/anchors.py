"""Anchors: content-defined positions that equal windows share.

Every window of ``width`` tokens picks, of the grams of ``gram`` tokens inside
it, the one with the smallest hash (the leftmost of equals).  The choice depends
on the window's content only, so two equal windows, wherever they are, pick the
same gram at the same offset.  Successive windows mostly share their anchor: a
text has about ``2 / (width - gram)`` anchors per token, and each stands for a
run of windows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from clientele.llm.setsketch import mixed

# Windows looked at together; positions inside fit the low bits of a packed key.
PIECE = 1 << 18
_LOW = np.uint64((1 << 22) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class RollingHash:
    """64-bit hashes of all runs of a fixed length, from running sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def __call__(self, tokens: np.ndarray, length: int) -> np.ndarray:
        """Hash of ``tokens[i:i + length]`` for every ``i``; tokens are well-mixed 64-bit values."""
        n = len(tokens)
        if n < length:
            return np.empty(0, dtype=np.uint64)
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, n + n // 8), _powers(self.inverse, n + n // 8)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(tokens * self.up[:n], out=sums[1:])
        return mixed((sums[length:] - sums[:-length]) * self.down[: n - length + 1])


class Runs(NamedTuple):
    """Runs of windows with one anchor: text number, first and last window start
    and anchor position within the text, and the anchor gram's hash."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray


def distinct_in_text(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the first of equal values of a text, in order of text and value, and
    how many there are of each.

    What a text repeats, even all along, is sent once.
    """
    order = np.lexsort((value, text))
    if not len(order):
        return order, order
    fresh = np.r_[True, (np.diff(text[order]) != 0) | (np.diff(value[order]) != 0)]
    heads = np.flatnonzero(fresh)
    return order[heads], np.diff(np.r_[heads, len(order)])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchored_runs(tokens: np.ndarray, lengths: np.ndarray, width: int, gram: int, hashes: RollingHash) -> Runs:
    """Runs of all windows of texts that lie one behind the other in ``tokens``."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    parts = []
    for start in range(0, max(0, len(tokens) - width + 1), PIECE):
        piece = tokens[start:start + PIECE + width - 1]
        grams = hashes(piece, gram)
        packed = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_minimum(packed, width - gram + 1) & _LOW).astype(np.int64)
        window = np.arange(start, start + len(anchor))
        text = np.searchsorted(ends, window, side="right")
        inside = window + width <= ends[np.minimum(text, len(ends) - 1)]
        window, text, anchor = window[inside], text[inside], anchor[inside]
        if not len(window):
            continue
        heads = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(text) != 0)])
        tails = np.r_[heads[1:], len(window)] - 1
        of = text[heads]
        parts.append((of, window[heads] - begins[of], window[tails] - begins[of],
                      anchor[heads] + start - begins[of], grams[anchor[heads]].view(np.int64)))
    if not parts:
        return Runs(*(np.empty(0, dtype=np.int64) for _ in Runs._fields))
    return Runs(*map(np.concatenate, zip(*parts, strict=True)))
