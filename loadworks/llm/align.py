"""Alignment of the tokens of two tokenizers over the bytes of the same texts.

Both tokenizers encode the whole text.  Where a token of each begins with a space
at the same byte, both have ended a token just before: these anchors, checked on
the tokens' byte lengths, split a document into windows, mostly a word each.  A
window's alignment depends on its token ids alone: equal pairs of id tuples are
aligned once in a slice of texts, and those that recur are remembered by the
worker (a bounded table).

Inside a window the offsets where tokens of both end together close a group and
link the two tokens that end there.  One of two linked tokens is a suffix of the
other's bytes, so there are no more different id pairs than the tokens of both
vocabularies have bytes, in any corpus (``Vocabularies.bound``): the corpus-wide
counts of pairs may be broadcast.  Documents keep their distinct pairs with
their numbers of times; texts are tokenised once and never shuffled.

Defined results: null and empty texts, and texts that a tokenizer does not give
back byte by byte (with one space before them), have no tokens: all zero and an
empty digest.  Strings of special tokens inside texts are plain text.  Rows of
equal id stay rows of their own; an empty table gives no rows.  Input columns that
are not named are ignored, whatever their names.  A text is held in memory
several times over by its task, whatever its length.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.columns import mix, range_hash, slices, utf8
from loadworks.llm.components import stored
from loadworks.llm.token_count import byte_letters

REMEMBERED = 200_000  # windows whose alignment a worker keeps
SLICE = 1 << 20       # bytes of text that are aligned together (a longer text alone)

BLANKS = 100_000      # a run of so many blanks is too much for the rank-based encoder's pattern

# Fixed value: how the byte-level vocabulary splits a text before its merges.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
           r"""|\s+(?!\S)|\s+""")


class Window(NamedTuple):
    """Alignment of a window: its groups as text, and its linked pairs as packed 64-bit codes."""

    groups: str
    codes: bytes


class Aligned(NamedTuple):
    """Alignment of some texts: by text its numbers of tokens and its groups, and all links by text."""

    n_a: np.ndarray
    n_b: np.ndarray
    groups: list[str]
    link_text: np.ndarray
    codes: np.ndarray


def gathered(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of all ranges starts[i]:ends[i], one after the other."""
    size = ends - starts
    return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())


def same_windows(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window of each id tuple pair, number of each window's pair) of windows at_a[i]:at_a[i + 1], at_b alike.

    Found by hash and compared id by id; a window that only shares its hash stands alone.
    """
    hashed = mix(range_hash(a, at_a[:-1], at_a[1:]) * np.uint64(0x9E3779B97F4A7C15) ^ range_hash(b, at_b[:-1], at_b[1:]))
    _, first, pair = np.unique(hashed, return_index=True, return_inverse=True)
    other = np.zeros(len(pair), bool)
    for ids, at in ((a, at_a), (b, at_b)):
        size = np.diff(at)
        like = first[pair]
        other |= size != size[like]
        place = gathered(at[like], at[like] + size)
        differs = ids[np.minimum(place, len(ids) - 1)] != ids
        other |= np.add.reduceat(differs, at[:-1]) > 0
    alone = np.flatnonzero(other)
    pair[alone] = len(first) + np.arange(len(alone))
    return np.concatenate([first, alone]), pair


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens.

    The byte-level file is encoded by ranks where its merges are in the order of its ids (checked), and by
    its own library otherwise and for texts with runs of blanks that the
    rank-based encoder cannot split.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        value = {c: b for b, c in enumerate(byte_letters())}
        vocab, added = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        tokens = {t: i for t, i in vocab.items() if t not in added}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        first = vocab[merges[0]] if merges else 0
        split = spec["pre_tokenizer"]
        ranked = (spec["normalizer"] is None and split["type"] == "ByteLevel" and split["use_regex"]
                  and not split["add_prefix_space"] and all(vocab[m] == first + k for k, m in enumerate(merges)))
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in tokens.items():
            self.a_bytes[i] = bytes(value[c] for c in t)
        self.a_path, self.library, self.ranked = a_path, None, None
        if ranked:
            import tiktoken
            self.ranked = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={},
                                            mergeable_ranks={self.a_bytes[i]: i for i in tokens.values()})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.pieces.vocab_size()
        self.b_bytes = [b"" if self.pieces.is_control(i) or self.pieces.is_unknown(i)
                        else bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i)
                        else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.pieces.id_to_piece(list(range(n))))]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))
        # an id as text with what may follow it: another of its group, the other side, a group, a window
        self.written = [f"{i}{after}" for i in range(max(len(self.a_bytes), n)) for after in (",", "|", ";", "")]
        self.known: dict[tuple[bytes, bytes], Window] = {}

    @property
    def bound(self) -> int:
        """Different linked pairs there can be: the suffixes of all tokens (a byte may have two pieces)."""
        return int(2 * self.a_size.sum() + self.b_size.sum())

    def encode_a(self, text: str) -> list[int]:
        if self.ranked is not None and (len(text) < BLANKS or not re.search(rf"\s{{{BLANKS}}}", text)):
            return self.ranked.encode_ordinary(text)
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.a_path)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both tokenizers by text; none where one of them does not give the text back.

        The tokens of the rank-based encoder are cut out of the text, so only the others are compared.
        """
        coded = [([], [])] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        for k, b in zip(some, self.pieces.encode([texts[k] for k in some], num_threads=1) if some else ()):
            whole = " " + texts[k]
            if b"".join(map(self.b_bytes.__getitem__, b)) != whole.encode():
                continue
            a = self.encode_a(whole)
            if self.ranked is not None or b"".join(map(self.a_bytes.__getitem__, a)) == whole.encode():
                coded[k] = a, b
        return coded

    def windows(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[Window]:
        """Alignments of windows that both tokenizers begin and end together: their ids one after
        the other, and how many there are of each."""
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        shared = np.zeros(int(a_end[-1]) + 1, np.int8)
        shared[a_end] = 1
        b_last = shared[b_end] == 1
        shared[:] = 0
        shared[b_end] = 1
        a_last = shared[a_end] == 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        a_upto, b_upto = (np.append(0, np.flatnonzero(last) + 1) for last in (a_last, b_last))
        # a group's tokens of a, then its tokens of b
        a_place = np.arange(len(a)) + b_upto[a_group]
        b_place = np.arange(len(b)) + a_upto[b_group + 1]
        order = np.empty(len(a) + len(b), np.int64)
        order[a_place] = a * 4 + a_last
        order[b_place] = b * 4 + 2 * b_last
        stop = np.cumsum(n_a) + np.cumsum(n_b)
        order[stop - 1] += 1  # a window's last token is one of b: nothing follows
        codes = (a[a_last].astype(np.int64) * len(self.b_bytes) + b[b_last]).tobytes()
        upto = (a_group[np.cumsum(n_a) - 1] + 1) * 8
        written, text = order.tolist(), self.written.__getitem__
        return [Window("".join(map(text, written[i:j])), codes[k:m]) for i, j, k, m in zip(
            [0, *stop.tolist()], stop.tolist(), [0, *upto.tolist()], upto.tolist())]

    def remembered(self, a: np.ndarray, b: np.ndarray, at_a, end_a, at_b, end_b) -> list[Window]:
        """The alignments of windows (pairs of id tuples), those not yet known worked out together."""
        keys = [(a[i:j].tobytes(), b[k:m].tobytes()) for i, j, k, m in zip(
            at_a.tolist(), end_a.tolist(), at_b.tolist(), end_b.tolist())]
        new = [w for w, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = range(len(keys))
        if len(new):
            w = np.array(new)
            made = self.windows(a[gathered(at_a[w], end_a[w])], b[gathered(at_b[w], end_b[w])],
                                (end_a - at_a)[w], (end_b - at_b)[w])
            self.known.update(zip([keys[k] for k in new], made))
        return [self.known[key] for key in keys]

    def align(self, texts: list[str | None]) -> Aligned:
        """Tokens, groups and links of texts."""
        coded = self.encode(texts)
        n_a, n_b = (np.array([len(c[k]) for c in coded], np.int64) for k in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(c[k] for c in coded), np.int32) for k in (0, 1))
        if not len(a):
            return Aligned(n_a, n_b, [""] * len(texts), np.zeros(0, np.int64), np.zeros(0, np.int64))
        # Both sides of a text have the same bytes, so offsets over all texts agree.
        a_start, b_start = (np.cumsum(size) - size for size in (self.a_size[a], self.b_size[b]))
        spaced = np.zeros(int(a_start[-1]) + 1, bool)
        spaced[a_start[self.a_space[a]]] = True
        anchors = b_start[self.b_space[b]]
        anchors = anchors[spaced[np.minimum(anchors, len(spaced) - 1)] & (anchors < len(spaced))]
        at_a, at_b = (np.append(np.searchsorted(start, anchors), len(start)) for start in (a_start, b_start))
        first, pair = same_windows(a, b, at_a, at_b)
        # windows that occur once are rare: they are aligned, but not remembered
        once = np.bincount(pair) == 1
        number = np.where(once, (~once).sum() + np.cumsum(once), np.cumsum(~once)) - 1
        pair, rare, first = number[pair], first[once], first[~once]
        found = self.remembered(a, b, at_a[first], at_a[first + 1], at_b[first], at_b[first + 1])
        if len(rare):
            n_rare = [at[rare + 1] - at[rare] for at in (at_a, at_b)]
            found += self.windows(a[gathered(at_a[rare], at_a[rare + 1])], b[gathered(at_b[rare], at_b[rare + 1])], *n_rare)
        border = np.searchsorted(at_a[:-1], np.append(0, np.cumsum(n_a)))  # each text begins with an anchor
        written, numbers = [w.groups for w in found], pair.tolist()
        groups = [";".join(map(written.__getitem__, numbers[i:j])) for i, j in zip(border[:-1], border[1:])]
        size = np.array([len(w.codes) // 8 for w in found])
        every = np.frombuffer(b"".join(w.codes for w in found), np.int64)
        upto = np.cumsum(size)[pair]
        place = gathered(upto - size[pair], upto)
        window_text = np.repeat(np.arange(len(texts)), np.diff(border))
        return Aligned(n_a, n_b, groups, np.repeat(window_text, size[pair]), every[place])


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    """The tokenizers of two files, loaded once in each worker."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Vocabularies(a_path, b_path)
    return _LOADED[a_path, b_path]


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, codes, times) of every row.

    ``codes`` are the distinct linked pairs of the row (a id times the number of b
    ids, plus b id), ``times`` how often each is linked.  With ``keep_groups``
    the groups themselves follow as text, ``a ids|b ids`` separated by ``;``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", *(c.split()[0] for c in _COUNTS.split(", ")), "codes", "times", *["groups"] * keep_groups]

    def task(batches):
        gc.disable()  # many small tuples, none of them in a cycle
        try:
            yield from aligned(batches)
        finally:
            gc.enable()

    def aligned(batches):
        own = vocabularies(a_path, b_path)
        pairs = len(own.a_bytes) * len(own.b_bytes)
        for batch in batches:
            texts = batch.column(1)
            for i, j in slices(utf8(texts)[1], SLICE):
                found = own.align(texts[i:j].to_pylist())
                n_links = np.bincount(found.link_text, minlength=j - i)
                distinct, times = np.unique(found.link_text * pairs + found.codes, return_counts=True)
                offsets = pa.array(np.searchsorted(distinct, np.arange(j - i + 1) * pairs), pa.int32())
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
                columns = [batch.column(0)[i:j], *map(pa.array, (found.n_a, found.n_b, n_links, n_links, digests)),
                           pa.ListArray.from_arrays(offsets, pa.array(distinct % pairs)),
                           pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(found.groups, pa.string())] * keep_groups, names=names)

    schema = f"id {kind}, {_COUNTS}, codes array<long>, times array<int>" + ", groups string" * keep_groups
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(task, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, count) of all linked pairs of a corpus."""
    return (aligned.select(F.inline(F.arrays_zip("codes", "times")))
            .groupBy(F.col("codes").alias("code")).agg(F.sum("times").alias("count")))


def score(aligned: DataFrame, counts: DataFrame, b_tokens: int, bound: int) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of codes and times.

    ``counts`` has at most ``bound`` rows (16 bytes each) and is broadcast; more are an error.
    """
    table = counts.select("code", "count").limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise ValueError(f"more than {bound} linked pairs: the counts are not of these vocabularies")
    table = table.sort_by("code")
    code, count = (np.ascontiguousarray(table[c].to_numpy()) for c in ("code", "count"))
    best = np.zeros(b_tokens, np.int64)
    np.maximum.at(best, code % b_tokens, count)
    shared = aligned.sparkSession.sparkContext.broadcast((code, count, count == best[code % b_tokens]))
    passed = [c for c in aligned.columns if c not in ("codes", "times")]

    def task(batches):
        known, number, top = shared.value
        for batch in batches:
            lists, times = batch.column(len(passed)), batch.column(len(passed) + 1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            at = np.searchsorted(known, lists.values.to_numpy()[offsets[0]:offsets[-1]])
            n = times.flatten().to_numpy().astype(np.int64)
            offsets -= offsets[0]
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
                    for x in (n * top[at], n * number[at])] if len(known) else [np.zeros(len(lists), np.int64)] * 2
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(passed)], *map(pa.array, sums)],
                                             names=[*passed, "n_best", "count_sum"])

    schema = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in passed)
    return aligned.select(*passed, "codes", "times").mapInArrow(task, f"{schema}, n_best long, count_sum long")


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row."""
    aligned = stored(align(docs, a_path, b_path, id_col, text_col), "aligned")
    own = vocabularies(a_path, b_path)
    return score(aligned, pair_counts(aligned), len(own.b_bytes), own.bound)
