"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a doubly linked list; the ranks of its adjacent pairs
lie in a heap.  The lowest pair is popped and merged, its new neighbours are
pushed, stale entries are skipped.  The count is the number of initial symbols
less the number of merges; no identifiers are made.  Counts of words already
seen by a worker come from a bounded table.

Defined results: null and empty texts have 0 tokens; the strings of special
tokens inside a text count as one token each, as in the library's default;
lengths are unlimited.  No shuffle: each row is counted where it is read.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.columns import utf8

REMEMBERED = 400_000  # words whose counts a worker keeps
SLICE_CHARS = 1 << 22


def byte_letters() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(0x100 + extra)
            extra += 1
    return out


# The parts of a tokenizer file that the quick path stands for.
QUICK_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
QUICK_BEFORE = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
# Characters that the quick path may meet besides ASCII: Latin letters that combine with nothing, and common marks.
QUICK_CHARACTERS = [chr(c) for c in [*range(0x00, 0x250), *range(0x2010, 0x2028), 0x20AC]]


class Counter:
    """Counts tokens as the byte-pair model of a tokenizer file with word ends does.

    Texts are normalised and cut into words by the file's own library.  Texts of
    common characters take a quicker path, if the file's parts are the known ones: those
    characters stand on their own, so lower-casing and the file's pattern are enough.  Each
    of them is compared with the library when the file is loaded and left out if it differs.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
               if model.get(k)]
        marked = [t["content"] for t in spec["added_tokens"]
                  if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]]
        if model["type"] != "BPE" or odd or marked:
            raise ValueError(f"{path}: not a plain byte-pair model ({model['type']}, {odd}, {marked})")
        library = Tokenizer.from_file(path)
        self.normalizer, self.before = library.normalizer, library.pre_tokenizer
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(p) if isinstance(p, list) else tuple(p.split(" ")) for p in model["merges"]]
        self.ranks = {pair: k for k, pair in enumerate(pairs)}
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) \
            if specials else None
        self.letters = byte_letters()
        self.known: dict[str | tuple[str], int] = {}  # words as they are, or as a tuple in the letters of bytes
        self.find = self.other = None
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (len(parts) == 2 and parts[0].get("behavior") == "Removed" and parts[0].get("invert")
                and parts[1] == QUICK_BEFORE and (spec["normalizer"] or {}).get("normalizers") == QUICK_NORMALIZER):
            self.find = regex.compile(parts[0]["pattern"]["Regex"]).findall
            same = [c for c in QUICK_CHARACTERS if all(
                self.quick(t) == self.words(t) for t in (c, f"a{c}b", f"1{c}2", f"{c}{c}", f"!{c}!", f" {c} "))]
            self.other = re.compile("[^" + "".join(map(re.escape, same)) + "]").search

    def words(self, text: str) -> list[str]:
        """A text's words in the letters of bytes, by the file's library."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [w for w, _ in self.before.pre_tokenize_str(text)]

    def quick(self, text: str) -> list[str]:
        """The same for texts of common characters."""
        return [self.spelled(w) for w in self.find(text.lower())]

    def spelled(self, word: str) -> str:
        """A word in the letters of its bytes."""
        return "".join([self.letters[b] for b in word.encode()])

    def word(self, word: str) -> int:
        """Symbols that are left of a word (in the letters of bytes) when no pair can be merged."""
        symbols = list(word)
        symbols[-1] += self.suffix
        n = len(symbols)
        ranks = self.ranks
        heap = [(ranks[pair], i) for i in range(n - 1)
                if (pair := (symbols[i], symbols[i + 1])) in ranks]
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            left = symbols[i]
            if left is None or (j := after[i]) >= n or ranks.get((left, symbols[j])) != rank:
                continue  # stale: one of its symbols has been merged
            merged = left + symbols[j]
            symbols[i], symbols[j] = merged, None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((merged, symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (p := before[i]) >= 0 and (r := ranks.get((symbols[p], merged))) is not None:
                heapq.heappush(heap, (r, p))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        quick = self.find is not None and self.other(text) is None
        known, total = self.known, 0
        for word in self.find(text.lower()) if quick else self.words(text):
            n = known.get(word if quick else (word,))
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[word if quick else (word,)] = self.word(self.spelled(word) if quick else word)
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or self.special.search(text) is None:
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of a file, made once in each worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, in place."""
    kind = docs.schema[id_col].dataType.simpleString()

    def task(batches):
        own = counter(path)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            counts = [own.count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(offsets[1:] - offsets[:-1]), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(task, f"id {kind}, n_bytes long, n_tokens long"))
