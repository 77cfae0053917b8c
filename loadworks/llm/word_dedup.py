"""Substring dedup over words with a compressed FM-index per shard.

A word goes if some window of ``WINDOW`` words that covers it also starts
earlier: in a document with a smaller id, or in the same document at an
earlier word.  ``repeats.covered`` settles equal stretches and deals the
others to shards.  A shard holds its word sequences as a compressed FM-index:
the Burrows-Wheeler transform in a wavelet tree whose levels are bit-packed
vectors with rank blocks (1.3 bits a word and level).  The sequences are
streamed against the index by backward search, which gives the matching
statistics of their places; where these reach the window, the interval of the
window names all its occurrences, whose earliest stays.

Defined results: null and empty texts have no words; documents with fewer
words than the window lose nothing; rows with equal ids and different texts do
not remove from each other, equal rows lose the same words; rows without an id
lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.byte_dedup import merged, ranges_by_row
from loadworks.llm.columns import NOT_BLANK, range_hash, utf8, with_columns, word_ranges
from loadworks.llm.repeats import covered, with_ranges

WINDOW = 20
GRAM = 8
STREAM = 1 << 20   # windows that are searched in step


def word_elements(data: np.ndarray, offsets: np.ndarray):
    """32-bit word hashes and each text's first word."""
    starts, ends, first = word_ranges(data, offsets, NOT_BLANK)
    return (range_hash(data, starts, ends) >> np.uint64(32)).astype(np.uint32), first


class BitVector:
    """Bits packed into 64-bit words; ones are counted at every 512 bits and, within these, at every 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits.astype(bool), bitorder="little")
        blocks = (len(bits) >> 9) + 1  # the last word lies beyond the bits: a rank at the end finds one
        self.words = np.concatenate([packed, np.zeros(64 * blocks - len(packed), np.uint8)]).view("<u8")
        counts = np.bitwise_count(self.words).reshape(-1, 8).astype(np.int64)
        upto = np.cumsum(counts, axis=1)
        self.inside = (upto - counts).astype(np.uint16).ravel()
        self.before = np.cumsum(upto[:, -1]) - upto[:, -1]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word >> 3] + self.inside[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """Ranks of symbols in a sequence, a bit vector a level, zeros first at each level."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            one = (symbols >> level) & 1 == 1
            self.bits.append(BitVector(one))
            self.zeros.append(len(symbols) - int(one.sum()))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position (begin: see ``begins``)."""
        for level, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            one = (symbol >> (self.levels - 1 - level)) & 1 == 1
            upto = bits.rank(at)
            at = np.where(one, zeros + upto, at - upto)
        return at - begin

    def begins(self, size: int) -> np.ndarray:
        """Where each symbol's run begins at the last level."""
        symbol = np.arange(size)
        return self.rank(symbol, np.zeros(size, np.int64), np.zeros(size, np.int64))


class FMIndex:
    """Backward search over the concatenation of a shard's sequences.

    Symbol 0 ends every sequence; matches never hold it.  Only the wavelet tree
    of the transform and the counts of its symbols are kept.
    """

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        n = len(symbols)
        rank, step = symbols.astype(np.int64), 1
        while True:  # suffixes ordered by their first `depth` symbols, by doubling
            after = np.zeros(n, np.int64)
            after[:max(0, n - step)] = rank[step:] + 1
            order = np.lexsort((after, rank))
            new = np.zeros(n, np.int64)
            new[1:] = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
            fresh = np.empty(n, np.int64)
            fresh[order] = np.cumsum(new)
            rank, step = fresh, 2 * step
            if step >= depth or rank.max() == n - 1:
                break
        self.tree = WaveletTree(symbols[order - 1].astype(np.int64), size)  # BWT, cyclic
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.run = self.tree.begins(size)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals after one more symbol in front."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]),
                              np.tile(self.run[symbol], 2))
        return self.first[symbol] + both[:len(symbol)], self.first[symbol] + both[len(symbol):]

    def matching_statistics(self, symbols: np.ndarray, ends: np.ndarray, room: np.ndarray):
        """(length, low, high): the longest run of symbols before each end that the index holds at
        least twice, of at most ``room`` symbols, and the interval of its occurrences.

        All ends are extended in step; one leaves when its next symbol would leave a single occurrence.
        """
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.first[-1])
        live = np.flatnonzero(room > 0)
        while len(live):
            begin, end = self.extend(symbols[ends[live] - length[live] - 1], low[live], high[live])
            again = end - begin > 1
            live, begin, end = live[again], begin[again], end[again]
            low[live], high[live] = begin, end
            length[live] += 1
            live = live[length[live] < room[live]]
        return length, low, high


def parts(counts: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers in consecutive parts of about ``most`` counted things, at least one part."""
    return np.split(np.arange(len(counts)), np.flatnonzero(np.diff(np.cumsum(counts) // most)) + 1)


def _shard(window: int):
    def task(shard: pa.Table) -> pa.Table:
        ids, keys, at = (shard[c].to_numpy() for c in ("id", "key", "at"))
        data, offsets = utf8(shard["body"].combine_chunks())
        words, bounds = np.ascontiguousarray(data).view(np.uint32), offsets // 4
        known, symbols = np.unique(words, return_inverse=True)
        n = len(ids)
        joined = np.zeros(len(words) + n, np.int64)  # a 0 behind every sequence
        joined[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(bounds))] = symbols + 1
        index = FMIndex(joined, len(known) + 1, 2 * window)
        begin = bounds[:-1] + np.arange(n)
        count = np.maximum(0, np.diff(bounds) - window + 1)
        found = []
        for rows in parts(count, STREAM):  # sequences are streamed against the index
            segment = np.repeat(rows, count[rows])
            place = np.arange(len(segment)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
            ends = begin[segment] + place + window
            length, low, _ = index.matching_statistics(joined, ends, np.full(len(ends), window))
            hit = length == window
            found.append((segment[hit], at[segment[hit]] + place[hit], low[hit]))
        segment, place, group = map(np.concatenate, zip(*found))
        if not len(group):
            return pa.table({"id": pa.array([], pa.int64()), "key": pa.array([], pa.int64()),
                             "body": pa.array([], pa.binary())})
        order = np.lexsort((place, keys[segment], ids[segment], group))
        segment, place, group = segment[order], place[order], group[order]
        doc, key = ids[segment], keys[segment]
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        least = doc[new][np.cumsum(new) - 1]
        again = np.zeros(len(group), bool)  # the same window earlier in the same text
        again[1:] = ~new[1:] & (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (place[1:] > place[:-1])
        first = np.flatnonzero(new | ~np.append(False, (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])))
        begins = place[first][np.searchsorted(first, np.arange(len(group)), side="right") - 1]
        late = (doc > least) | (again & (place > begins))
        return ranges_by_row(segment[late], place[late], place[late] + window, ids, keys)

    return task


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_removed, spans (the removed ranges of words) and kept: the words
    that stay, joined by blanks.  Columns of ``docs`` with these names are replaced.

    Without ``keep_text`` the text column is left out.
    """
    ranges = covered(docs, id_col, text_col, word_elements, window, min(GRAM, window), _shard(window),
                     True)
    marked = with_ranges(docs, ranges, id_col, text_col)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def make(texts: pa.Array, blobs: pa.Array):
        counts, removed, spans, kept = [], [], [], []
        data, offsets = utf8(texts)
        for r in range(len(texts)):
            body = data[offsets[r]:offsets[r + 1]]
            starts, ends, _ = word_ranges(body, np.array([0, len(body)]), NOT_BLANK)
            ranges = merged(blobs[r].as_py())
            spans.append([{"start": a, "end": b} for a, b in ranges.tolist()])
            gone = np.zeros(len(starts) + 1, np.int64)
            np.add.at(gone, ranges[:, 0], 1)
            np.add.at(gone, ranges[:, 1], -1)
            stays = np.cumsum(gone[:-1]) == 0
            raw = body.tobytes()
            kept.append(b" ".join(raw.split()) if stays.all() else
                        b" ".join(raw[a:b] for a, b in zip(starts[stays].tolist(), ends[stays].tolist())))
            counts.append(len(starts))
            removed.append(len(starts) - int(stays.sum()))
        return (pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span),
                pa.array(kept, pa.binary()).cast(pa.string()))

    text = f"c{docs.columns.index(text_col)}"
    fields = "n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"
    made = with_columns(marked, [text, "ranges"], fields, make,
                        drop=("ranges",) if keep_text else ("ranges", text))
    new = ["n_words", "n_removed", "spans", "kept"]
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)
                         if c not in new and f"c{i}" in made.columns], *new)
