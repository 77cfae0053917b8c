"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are runs of letters, digits and non-ASCII characters after A-Z has been
lower-cased.  A test item contributes every window of ``n`` consecutive words
(an item of fewer words is one window).  The windows' 64-bit hashes go to the
executors as one sorted array; each task hashes the windows of its documents, and
every hit is verified word by word before it counts.

What is broadcast is bounded: the items are cut into pieces of a few thousand words
(that overlap by a window less a word), and at most about ``BLOCK_BYTES`` of them, some
40 bytes a word with hashes and places, are with the executors at a time.  A larger
benchmark is scanned block after block, each in a pass of its own whose hits are stored.

Defined results: null and empty texts have no words and no hits; items without
words are never found; the windows of an item without identifier are hit like
others, but it cannot be named: it is not among ``items``; repeated items are all
reported; item identifiers are compared as text.  Columns of the documents that are
called like one of the result give way to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.columns import (ALNUM, LOWER, range_hash, slices, utf8, with_columns,
                                   word_ranges)
from loadworks.llm.components import stored

WINDOW = 10
PIECE_WORDS = 4_000        # words of an item's piece
BLOCK_BYTES = 16 << 20     # benchmark text that is broadcast at a time


def _words(data: np.ndarray, offsets: np.ndarray):
    low = LOWER[data]
    starts, ends, first = word_ranges(low, offsets, ALNUM)
    return low, starts, ends, first


class WindowSet:
    """The windows of some items: by length, their sorted hashes and where they begin; and all words to verify hits."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        self.names = [name for name, _ in items]
        self.low, self.starts, self.ends, first = _words(*utf8(pa.array([t for _, t in items], pa.string())))
        self.item = np.repeat(np.arange(len(items), dtype=np.int32), np.diff(first))
        words = range_hash(self.low, self.starts, self.ends)
        size = np.minimum(np.diff(first), n)
        self.windows = {}
        for k in np.unique(size[size > 0]).tolist():
            at = np.concatenate([np.arange(a, b - k + 1) for a, b in zip(first[:-1][size == k], first[1:][size == k])])
            hashes = range_hash(words, at, at + k)
            order = np.argsort(hashes, kind="stable")
            self.windows[k] = hashes[order], at[order].astype(np.int32)

    def _text(self, i: int, k: int) -> bytes:
        return b" ".join(self.low[a:b].tobytes() for a, b in zip(self.starts[i:i + k], self.ends[i:i + k]))

    def scan(self, low: np.ndarray, starts, ends, first):
        """Hit flag of each word, and the (text, item) pairs found."""
        hit = np.zeros(len(starts) + 1, np.int64)
        pairs: set[tuple[int, int]] = set()
        word = range_hash(low, starts, ends)
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for size, (known, where) in self.windows.items():
            at = np.arange(len(word) - size + 1)
            at = at[text_of[at] == text_of[at + size - 1]] if len(at) else at
            if not len(at):
                continue
            h = range_hash(word, at, at + size)
            slot = np.searchsorted(known, h)
            like = known[np.minimum(slot, len(known) - 1)] == h
            upto = np.searchsorted(known, h[like], side="right")
            for i, a, b in zip(at[like].tolist(), slot[like].tolist(), upto.tolist()):
                own = b" ".join(low[x:y].tobytes() for x, y in zip(starts[i:i + size], ends[i:i + size]))
                same = [j for j in where[a:b].tolist() if self._text(j, size) == own]
                if same:
                    hit[i] += 1
                    hit[i + size] -= 1
                    pairs.update((int(text_of[i]), int(self.item[j])) for j in same)
        return np.cumsum(hit[:-1]) > 0, pairs


FIELDS = "n_words long, hits array<int>, items array<string>"


def _pieces(benchmark: DataFrame, n: int) -> DataFrame:
    """(item, piece, text, bytes): the items' lower-cased words in pieces of bounded size."""
    def task(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                low, starts, ends, _ = _words(*utf8(pa.array([text.as_py()], pa.string())))
                for k, i in enumerate(range(0, max(1, len(starts) - n + 1), PIECE_WORDS)):
                    own = [low[a:b].tobytes() for a, b in zip(starts[i:i + PIECE_WORDS + n - 1], ends[i:i + PIECE_WORDS + n - 1])]
                    if own:
                        rows.append((item, k, b" ".join(own).decode()))
            items, numbers, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(numbers, pa.int64()),
                                              pa.array(texts, pa.string())], names=["item", "piece", "text"])

    return benchmark.mapInArrow(task, "item string, piece long, text string").withColumn("bytes", F.octet_length("text"))


def _scan_block(docs: DataFrame, text_col: str, items: list[tuple[str | None, str]], n: int) -> DataFrame:
    """``docs`` with n_words, hits (indexes of hit words) and items."""
    shared = docs.sparkSession.sparkContext.broadcast(WindowSet(items, n))

    def make(texts: pa.Array):
        data, offsets = utf8(texts)
        counts, hits, found = [], [], []
        for i, j in slices(offsets):
            low, starts, ends, first = _words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            flags, pairs = shared.value.scan(low, starts, ends, first)
            names: dict[int, set[str]] = {}
            for k, item in pairs:
                if shared.value.names[item] is not None:
                    names.setdefault(k, set()).add(shared.value.names[item])
            for k in range(j - i):
                counts.append(int(first[k + 1] - first[k]))
                hits.append(np.flatnonzero(flags[first[k]:first[k + 1]]).astype(np.int32))
                found.append(sorted(names.get(k, ())))
        return (pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())),
                pa.array(found, pa.list_(pa.string())))

    return with_columns(docs, [text_col], FIELDS, make)


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", n: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, hits and items.

    ``hits`` are the indexes of the words inside an occurrence of a window,
    ``items`` the distinct items found, sorted as strings.  A benchmark of one block
    needs no shuffle.  With more blocks the documents are stored once with a row number, each
    block's pass stores the rows that it hits, and these (a row a block at most) are put together
    and joined back by row number.
    """
    pieces = stored(_pieces(benchmark.select(F.col(item_col).cast("string").alias("item"),
                                             F.col(item_text_col).alias("text")).where("text is not null"), n), "benchmark")
    size = pieces.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))

    def block(k: int) -> list[tuple[str | None, str]]:
        part = pieces if blocks == 1 else pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == k)
        return [(r["item"], r["text"]) for r in part.select("item", "text").toLocalIterator()]

    if blocks == 1:
        return _scan_block(docs, text_col, block(0), n)
    old = [f"c{i}" for i in range(len(docs.columns))]
    rows = stored(docs.toDF(*old).withColumn("row", F.monotonically_increasing_id()), "documents")
    text = old[docs.columns.index(text_col)]
    found = None
    for k in range(blocks):
        part = stored(_scan_block(rows.select("row", F.col(text).alias("text")), "text", block(k), n)
                      .where("size(hits) > 0").select("row", "hits", "items"), "hits")
        found = part if found is None else found.unionByName(part)
    found = found.groupBy(F.col("row").alias("hit_row")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    words = with_columns(rows, [text], "n_words long", lambda texts: [pa.array(np.diff(_words(*utf8(texts))[3]))])
    out = words.join(found, F.col("row") == F.col("hit_row"), "left")
    new = ["n_words", "hits", "items"]
    return out.select(*[F.col(o).alias(c) for o, c in zip(old, docs.columns) if c not in new], "n_words",
                      F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove_spans(texts: pa.Array, hits: pa.Array) -> list[str | None]:
    """The texts without their hit words; texts without hits stay as they are."""
    out = []
    for text, hit in zip(texts.to_pylist(), hits.to_pylist()):
        if text is None or not hit:
            out.append(text)
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        _, starts, ends, _ = _words(raw, np.array([0, len(raw)]))
        drop = np.zeros(len(raw) + 1, np.int64)
        hit = np.array(hit)
        runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
        for run in runs:
            drop[starts[run[0]]] += 1
            drop[ends[run[-1]]] -= 1
        out.append(raw[np.cumsum(drop[:-1]) == 0].tobytes().decode())
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """``docs`` with the hit spans removed from the text, and n_words and n_hit of the text before."""
    old = [f"c{i}" for i in range(len(docs.columns))]
    text = f"c{docs.columns.index(text_col)}"
    found = scan(docs.toDF(*old), benchmark, text, n=n)
    found = with_columns(found, [text, "hits"], f"{text} string",
                         lambda texts, hits: [pa.array(remove_spans(texts, hits), pa.string())])
    return found.select(*[F.col(o).alias(c) for o, c in zip(old, docs.columns) if c not in ("n_words", "n_hit")],
                        "n_words", F.size("hits").cast("long").alias("n_hit"))
