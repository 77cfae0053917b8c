"""Plain brute-force versions of the operators' definitions."""

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text, n):
    words = BLANK_WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def near_components(docs, n, share):
    """id -> smallest id reachable; all pairs that share a shingle are compared."""
    sets = {d: shingle_set(t, n) for d, t in docs}
    label = {d: d for d in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    for a, s in sets.items():
        for b in {b for x in s for b in where[x] if b < a}:
            common = len(s & sets[b])
            if share[1] * common >= share[0] * (len(s) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def byte_dedup(docs, window):
    first = {}
    for d, t in sorted((d, t or "") for d, t in docs if d is not None):
        b = t.encode()
        for k in range(len(b) - window + 1):
            first.setdefault(b[k:k + window], d)
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if d is not None and first[b[k:k + window]] < d:
                gone[k:k + window] = b"\1" * window
        out[d] = (len(b), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(b, gone) if not g))
    return out


def word_dedup(docs, window):
    first = {}
    words = {d: BLANK_WORDS.findall(t or "") for d, t in docs}
    for d in sorted(d for d in words if d is not None):
        for k in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][k:k + window]), (d, k))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if d is not None and first[tuple(w[k:k + window])] < (d, k):
                gone[k:k + window] = [True] * window
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def contamination(docs, items, n):
    """id -> (words, hit word indexes, items)."""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM_WORDS.findall((text or "").translate(LOWER))
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k:k + size])].add(str(item))
    sizes = {len(x) for x in windows}
    out = {}
    for d, text in docs:
        w = ALNUM_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (names := windows.get(tuple(w[k:k + size]))):
                    hit.update(range(k, k + size))
                    found |= names
        out[d] = (len(w), sorted(hit), sorted(found))
    return out
