"""Substring dedup over bytes with the interval tree of an enhanced suffix array.

A byte goes if some window of ``WINDOW`` bytes that covers it also starts in a
document with a smaller id.  ``repeats.covered`` settles equal stretches and
deals the others to shards.  In a shard the suffixes are sorted, the lengths
of the common prefixes of neighbours form the enhanced array, and a scan with
a stack visits its interval tree.  An interval whose suffixes are preceded by
different bytes is a maximal repeat with all its occurrences; every occurrence
outside its smallest document is covered.

Defined results: null and empty texts lose nothing; texts shorter than the
window lose nothing; documents with equal ids do not remove from each other;
rows without an id lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.columns import range_hash, utf8, with_columns
from loadworks.llm.repeats import covered, runs, with_ranges

WINDOW = 50
GRAM = 16


def byte_elements(data: np.ndarray, offsets: np.ndarray):
    return data, offsets


def maximal_repeats(text: np.ndarray, room: np.ndarray, before: np.ndarray, window: int):
    """Yields (length, occurrences) of the maximal repeats of at least ``window`` bytes.

    ``room[i]`` bytes may be used from position i on; ``before[i]`` is the byte
    before it, or a negative number of its own if there is none.
    """
    at = np.flatnonzero(room >= window)
    if len(at) < 2:
        return
    # a suffix whose first window is unique is in no interval
    _, index, count = np.unique(range_hash(text, at, at + window), return_inverse=True, return_counts=True)
    at = at[count[index] > 1]
    if len(at) < 2:
        return
    at = at[np.argsort(-room[at], kind="stable")]  # of equal padded suffixes the longer first
    deep = int(room[at].max())
    padded = np.concatenate([text, np.zeros(deep, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, deep)[at].copy()
    rows[np.arange(deep) >= room[at][:, None]] = 0
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{deep}").ravel(), kind="stable")
    at, rows = at[order], rows[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(1), differ.argmax(1), deep)
    common = np.minimum(common, np.minimum(room[at[1:]], room[at[:-1]])).tolist()
    left = before[at].tolist()
    mixed = -1  # left contexts differ
    stack: list[list[int]] = []  # open intervals: length, first suffix, left byte
    for i, length in enumerate([*common, 0]):
        begin, own = i, left[i] if left[i] >= 0 else mixed
        while stack and stack[-1][0] > length:
            depth, begin, byte = stack.pop()
            byte = byte if byte == own else mixed
            if byte == mixed:
                yield depth, at[begin:i + 1]
            own = byte
        if length < window:
            stack.clear()
        elif stack and stack[-1][0] == length:
            stack[-1][2] = stack[-1][2] if stack[-1][2] == own else mixed
        else:
            stack.append([length, begin, own])


def _shard(window: int):
    def task(shard: pa.Table) -> pa.Table:
        ids, keys, starts = (shard[c].to_numpy() for c in ("id", "key", "at"))
        text, offsets = utf8(shard["body"].combine_chunks())
        size = np.diff(offsets)
        of = np.repeat(np.arange(len(size)), size)
        room = offsets[1:][of] - np.arange(len(text))
        before = np.full(len(text), -2, np.int64)
        before[1:] = text[:-1]
        before[offsets[:-1][size > 0]] = -2
        rows, begins, ends = [], [], []
        for length, places in maximal_repeats(text, room, before, window):
            segment = of[places]
            doc = ids[segment]
            late = doc > doc.min()
            if late.any():
                rows.append(segment[late])
                begins.append(starts[segment[late]] + places[late] - offsets[segment[late]])
                ends.append(begins[-1] + length)
        if not rows:
            return pa.table({"id": pa.array([], pa.int64()), "key": pa.array([], pa.int64()),
                             "body": pa.array([], pa.binary())})
        return ranges_by_row(np.concatenate(rows), np.concatenate(begins), np.concatenate(ends), ids, keys)

    return task


def ranges_by_row(segment, begin, end, ids, keys) -> pa.Table:
    """(id, key, body) of each document with covered ranges."""
    order = np.lexsort((keys[segment], ids[segment]))
    segment, begin, end = segment[order], begin[order], end[order]
    doc, key = ids[segment], keys[segment]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc))
    return pa.table({"id": pa.array(doc[heads]), "key": pa.array(key[heads]),
                     "body": pa.array([runs(begin[a:b], end[a:b]).tobytes() for a, b in zip(heads, tails)],
                                      pa.binary())})


def merged(blobs) -> np.ndarray:
    """The disjoint ranges of a row's blobs."""
    ranges = np.frombuffer(b"".join(blobs or []), np.int64).reshape(-1, 2)
    return runs(ranges[:, 0], ranges[:, 1])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = WINDOW) -> DataFrame:
    """``docs`` without its text, with n_bytes, spans (the removed ranges) and kept (the bytes left)."""
    ranges = covered(docs, id_col, text_col, byte_elements, window, min(GRAM, window), _shard(window),
                     False)
    marked = with_ranges(docs, ranges, id_col, text_col)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def make(texts: pa.Array, blobs: pa.Array):
        spans, kept = [], []
        data, offsets = utf8(texts)
        for r in range(len(texts)):
            body = data[offsets[r]:offsets[r + 1]]
            ranges = merged(blobs[r].as_py())
            if len(ranges):
                gone = np.zeros(len(body) + 1, np.int64)
                np.add.at(gone, ranges[:, 0], 1)
                np.add.at(gone, ranges[:, 1], -1)
                body = body[np.cumsum(gone[:-1]) == 0]
            spans.append([{"start": a, "end": b} for a, b in ranges.tolist()])
            kept.append(body.tobytes())
        return pa.array(np.diff(offsets)), pa.array(spans, span), pa.array(kept, pa.binary())

    text = f"c{docs.columns.index(text_col)}"
    fields = "n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    made = with_columns(marked, [text, "ranges"], fields, make, drop=(text, "ranges"))
    new = ["n_bytes", "spans", "kept"]
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)
                         if c != text_col and c not in new], *new)
