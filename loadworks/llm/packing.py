"""Order-preserving sequence packing by dynamic programming.

The documents of a task form one stream of tokens, in their order.  Cuts of
the stream into sequences of at most ``length`` tokens are chosen so that the
padding plus the penalties for cutting inside documents is least:

    cost(j) = penalty(j) + SEQUENCE_COST + min over i of cost(i) + padding(j - i)

where i and j are possible cuts: ends of documents (no penalty), ends of
sentences, and a coarse grid inside documents that keeps every stretch
feasible.  Padding is ``length - (j - i)``, so the best i of a window is the
least cost(i) + i, kept by a monotone queue; sequences whose length is a power
of two are not padded and are tried as well.

Defined results: a null or empty text is only the end id; every id lies in
exactly one piece; texts of any length are cut into several pieces; rows with
equal ids are packed one by one.  Nothing is shuffled: sequences do not cross
tasks, which costs at most one short tail a task, itself cut by the same rule.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.token_count import byte_letters

LENGTH = 2048
END_ID = 1
GRID = 128            # tokens between possible cuts inside a sentence
SENTENCE_COST = 4     # penalty of a cut at the end of a sentence, in tokens of padding
INSIDE_COST = 24      # penalty of a cut anywhere else inside a document
SEQUENCE_COST = 128   # of a sequence: windows are filled rather than cut into short powers of two
BLOCK = 1 << 18       # tokens planned at a time; the last sequence is carried over

SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Encoder:
    """Token ids of a byte-level vocabulary file, and which ids end a sentence.

    Where the file's merges are in the order of its ids (checked), the faster
    rank-based encoder gives the same ids; otherwise, and for texts that it
    cannot split (very long runs of blanks), the file's own library is used.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        value = {c: b for b, c in enumerate(byte_letters())}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {t: i for t, i in vocab.items() if t not in added}
        raw = {i: bytes(value[c] for c in t) for t, i in tokens.items()}
        first = min(vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges)
        ordered = all(vocab["".join(m if isinstance(m, list) else m.split(" "))] == first + k
                      for k, m in enumerate(merges))
        self.ends = np.zeros(max([*raw, *added.values()]) + 1, bool)
        for i, b in raw.items():
            self.ends[i] = b.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")
        plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word"))
                    for t in spec["added_tokens"])
        gpt2 = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" \
            and spec["pre_tokenizer"]["use_regex"] and not spec["pre_tokenizer"]["add_prefix_space"]
        if ordered and plain and gpt2:
            import tiktoken
            pattern = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
                       r"""|\s+(?!\S)|\s+""")
            own = tiktoken.Encoding("own", pat_str=pattern, special_tokens=added,
                                    mergeable_ranks={b: i for i, b in raw.items()})
            self.fast = lambda text: own.encode_to_numpy(text, allowed_special="all")
        else:
            self.fast = None
        self.path, self.own = path, None

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast(text)
            except ValueError as error:  # its pattern backtracks over a run of blanks
                if "backtracking" not in str(error):
                    raise
        if self.own is None:
            from tokenizers import Tokenizer
            self.own = Tokenizer.from_file(self.path)
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def candidate_cuts(sentence_end: np.ndarray, ends: np.ndarray, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a stretch of tokens and their penalties.

    ``sentence_end`` flags tokens after which a sentence ends; ``ends`` are the
    positions after the last token of each document.
    """
    n = len(sentence_end)
    cost = np.full(n + 1, -1, np.int64)
    cost[grid::grid] = INSIDE_COST
    cost[np.flatnonzero(sentence_end) + 1] = SENTENCE_COST
    cost[ends] = 0
    cost[0] = 0
    if cost[n] < 0:
        cost[n] = INSIDE_COST
    at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def choose_cuts(at: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """The cuts of least padding plus penalties, from at[0] to at[-1]."""
    at, penalty = at.tolist(), penalty.tolist()
    where = {p: k for k, p in enumerate(at)}
    sizes = [1 << k for k in range(length.bit_length() - 1, -1, -1) if 1 << k <= length]
    small = [s for s in sizes if s < length]
    cost, best = [0] * len(at), [0] * len(at)
    queue = deque([(0 + at[0], 0)])
    for j in range(1, len(at)):
        p = at[j]
        while p - at[queue[0][1]] > length:
            queue.popleft()
        value, i = queue[0]
        least = value + length - p
        for s in small:  # a sequence whose length is a power of two has no padding
            k = where.get(p - s)
            if k is not None and cost[k] < least:
                least, i = cost[k], k
        cost[j], best[j] = least + penalty[j] + SEQUENCE_COST, i
        value = cost[j] + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [at[-1]], len(at) - 1
    while j:
        j = best[j]
        cuts.append(at[j])
    return cuts[::-1]


def _tail(first: int, last: int, length: int) -> list[int]:
    """Cuts of the last stretch of a task: whole, or in powers of two where that costs less."""
    n, parts = last - first, []
    if n == 0 or n & (n - 1) == 0:
        return [last] if n else []
    if length - n <= (INSIDE_COST + SEQUENCE_COST) * (bin(n).count("1") - 1):
        return [last]
    while n:
        parts.append(1 << (n.bit_length() - 1))
        n -= parts[-1]
    return list((first + np.cumsum(parts)).tolist())


class Packer:
    """Packs one task's stream; holds the tokens of a block and of the open sequences."""

    def __init__(self, sentence_ends: np.ndarray, length: int, sequence: int):
        self.sentence_ends, self.length, self.sequence = sentence_ends, length, sequence
        self.held: list[tuple] = []  # (id, ids still to place, ids placed before, ids in all)
        self.size = 0

    def add(self, name, ids: np.ndarray) -> list[tuple]:
        self.held.append((name, ids, 0, len(ids)))
        self.size += len(ids)
        return self.place(False) if self.size >= BLOCK else []

    def place(self, last: bool) -> list[tuple]:
        """Pieces of the sequences that are final; the last two wait for what follows."""
        if not self.size:
            return []
        ids = np.concatenate([h[1] for h in self.held])
        ends = np.cumsum([len(h[1]) for h in self.held])
        cuts = choose_cuts(*candidate_cuts(self.sentence_ends[ids], ends, max(1, min(GRID, self.length // 16))),
                           self.length)
        cuts = cuts[:-1] + _tail(cuts[-2], cuts[-1], self.length) if last else cuts[:-2]
        out, k = [], 0
        for a, b in zip(cuts[:-1], cuts[1:]):
            offset = 0
            while a < b:
                while ends[k] <= a:
                    k += 1
                name, own, before, size = self.held[k]
                upto = min(b, int(ends[k]))
                begin = before + a - int(ends[k]) + len(own)
                out.append((name, begin, upto - a, zlib.crc32(ids[a:upto].tobytes()), size,
                            self.sequence, offset))
                offset += upto - a
                a = upto
            self.sequence += 1
        done = cuts[-1]
        rest = int(np.searchsorted(ends, done, side="right"))
        held = self.held[rest:]
        if held:
            name, own, before, size = held[0]
            gone = done - (int(ends[rest]) - len(own))
            held[0] = (name, own[gone:], before + gone, size)
        self.held, self.size = held, len(ids) - done
        return out


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    ``sequence_id`` joins the task's number with a running number, so a task
    that is run again on another executor gives the same ids.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", *(c.split()[0] for c in SCHEMA.split(", "))]

    def task(batches):
        own = encoder(path)
        end = np.array([end_id], np.uint32)
        packer = Packer(own.ends, length, TaskContext.get().partitionId() << 36)

        def batch_of(rows):
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])], names=names)

        id_type, rows = None, []
        for batch in batches:
            id_type = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids = np.concatenate([own.encode(text).astype(np.uint32), end]) if text else end
                rows += packer.add(name, ids)
                if len(rows) >= 20000:
                    yield batch_of(rows)
                    rows = []
        rows += packer.place(True)
        if rows:
            yield batch_of(rows)

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(task, f"id {kind}, {SCHEMA}"))
