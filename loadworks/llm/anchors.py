"""Anchors: the positions at which equal windows of different texts meet.

A text is an array of elements (bytes, or hashes of words).  Every window of
``window`` elements picks one of its k-grams, the one of least rank; equal
windows pick the same one at the same place.  Consecutive windows mostly share
their pick, so a text has about one anchor in (window - k) / 2 elements.  The
stretch of an anchor is the union of the windows that picked it.

Ranks are hashes of the k-grams; k-grams known to be frequent rank behind all
others.  Which k-grams are frequent only steers how many anchors are shared,
never which repeats are found.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from loadworks.llm.columns import mix, powers

PIECE = 1 << 20      # windows ranked at a time
_POSITION = np.uint64(24)
_HOT_BITS = 22


class Frequent:
    """A bit table of frequent k-grams; others that share a bit are treated alike everywhere."""

    def __init__(self, grams: np.ndarray):
        self.table = np.zeros(1 << _HOT_BITS, bool)
        self.table[(grams >> np.uint64(64 - _HOT_BITS)).astype(np.int64)] = True
        self.any = bool(len(grams))

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        return self.table[(grams >> np.uint64(64 - _HOT_BITS)).astype(np.int64)]


class Ranges:
    """Hashes of ranges of a run of elements, all from one running sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sum = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n), out=self.sum[1:])
        self.back = powers(n + 1, True)

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k elements from each position on."""
        n = len(self.sum) - k
        return mix((self.sum[k:] - self.sum[:n]) * self.back[:n]) if n > 0 else np.zeros(0, np.uint64)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(((self.sum[end] - self.sum[start]) * self.back[start]) ^ size)


class Anchors(NamedTuple):
    """Columns of the anchors of some texts.

    ``side`` hashes tell whether two anchors of equal grams can share a window:
    a window reaches half of its other elements to the gram's left or right, so
    the gram with that many elements on one side must be equal as well (0: the
    text ends before).
    """

    text: np.ndarray      # index of the text
    gram: np.ndarray      # hash of the gram
    stretch: np.ndarray   # hash of the stretch and of the gram's place in it
    left: np.ndarray
    right: np.ndarray
    start: np.ndarray     # of the stretch, in ``values``
    end: np.ndarray


_KINDS = Anchors(np.int64, np.uint64, np.uint64, np.uint64, np.uint64, np.int64, np.int64)


def anchors(values: np.ndarray, offsets: np.ndarray, window: int, k: int, frequent: Frequent) -> Anchors:
    """The anchors of texts; stretches lie inside their text."""
    out = [[] for _ in Anchors._fields]
    w, reach = window - k + 1, (window - k + 1) // 2
    lengths = np.diff(offsets)
    for text, start, end in _pieces(offsets, lengths, window):
        ranges = Ranges(values[start:end])
        grams = ranges.grams(k)
        if len(grams) < w:
            continue
        key = grams >> np.uint64(1)
        if frequent.any:
            key |= frequent(grams).astype(np.uint64) << np.uint64(63)
        key = (key >> _POSITION << _POSITION) | np.arange(len(key), dtype=np.uint64)
        span = 1
        while span < w:  # least key of each run of w grams, by doubling
            step = min(span, w - span)
            key = np.minimum(key[:-step], key[step:])
            span += step
        at = (key & np.uint64((1 << 24) - 1)).astype(np.int64)
        # windows that lie in one text
        bounds = np.clip(offsets[text[0]:text[1] + 1] - start, 0, end - start)
        size = np.diff(bounds)
        of = np.repeat(np.arange(len(size)), size)[:len(at)]
        inside = np.arange(len(at)) + window <= np.repeat(bounds[1:], size)[:len(at)]
        first = np.flatnonzero(inside)
        if not len(first):
            continue
        at, of = at[first], of[first]
        new = np.ones(len(first), bool)
        new[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1])
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(first)) - 1
        at, of, begin, stop = at[heads], of[heads], first[heads], first[tails] + window
        stretch = mix(ranges(begin, stop) ^ ((at - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        low, high = at - reach, at + k + reach
        left = np.where(low >= bounds[of], ranges(np.maximum(low, 0), at + k) | np.uint64(1 << 63), np.uint64(0))
        right = np.where(high <= bounds[of + 1], ranges(at, np.minimum(high, end - start)) | np.uint64(1 << 63),
                         np.uint64(0))
        for col, x in zip(out, (of + text[0], grams[at], stretch, left, right, begin + start, stop + start)):
            col.append(x)
    return Anchors(*[np.concatenate(c) if c else np.zeros(0, kind) for c, kind in zip(out, _KINDS)])


def _pieces(offsets, lengths, window):
    """((first text, last text), start, end): runs of whole short texts, overlapping parts of long ones."""
    i, n = 0, len(lengths)
    while i < n:
        if lengths[i] > PIECE:
            for s in range(0, int(lengths[i]) - window + 1, PIECE):
                yield (i, i + 1), int(offsets[i]) + s, int(min(offsets[i + 1], offsets[i] + s + PIECE + window - 1))
            i += 1
            continue
        j = int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield (i, j), int(offsets[i]), int(offsets[j])
        i = j
