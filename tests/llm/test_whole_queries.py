"""The registered queries over texts longer than a slice, repeated and null ids and clashing columns,
all contract columns against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadworks.llm import lang_id, queries
from loadworks.llm.columns import SLICE_BYTES
from tests.llm import brute

CLASHING = "n_tokens int, score double, kept string, id int, n_words int, spans string"


def long_texts(seed=23):
    """Texts over one slice: a text, a near copy, a part across the slice's border, and short ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9)))
                  for _ in range(3000)]
    words = [rng.choice(vocabulary) for _ in range(230_000)]
    copy = list(words)
    for k in rng.sample(range(len(copy)), 2000):
        copy[k] = rng.choice(vocabulary)
    first, second = " ".join(words), "\n".join(copy)
    assert len(first.encode()) > SLICE_BYTES + 50_000
    border = first.encode()[SLICE_BYTES - 400:SLICE_BYTES + 400].decode("utf-8", "ignore")
    return [(7, first), (3, second), (90, f"Before {border} after"), (1, "few words"), (2, ""), (4, None),
            (91, "x" * (SLICE_BYTES + 77))]


@pytest.fixture(scope="module")
def rows():
    return long_texts()


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long"))
    spark.createDataFrame([(d, t, "en" if d % 2 else None, "s", 5, 1, 0.5, "k", 3, 4, "z") for d, t in rows],
                          f"doc_id long, text string, lang string, source string, n_chars int, {CLASHING}") \
        .repartition(3).write.parquet(f"{path}/documents.parquet")
    middle = rows[0][1].encode()[SLICE_BYTES - 100:SLICE_BYTES + 100].decode("utf-8", "ignore")
    spark.createDataFrame([("i1", middle, 1), ("i2", "few words", 2)],
                          "item_id string, text string, hits int").write.parquet(f"{path}/benchmark.parquet")
    pages = [(d, f"http://h/{d}", t, "c") for d, t in rows] \
        + [(200, "u", rows[0][1]), (201, "u", "y" * 400 + "\r\n\r\nWARC/1.1\r\nContent-Length: 1\r\n\r\n" + rows[1][1])]
    spark.createDataFrame([(*p[:3], "c") for p in pages],
                          "page_id long, url string, html string, type string").write.parquet(f"{path}/pages.parquet")
    return path, [p[:3] for p in pages]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_byte_dedup(spark, rows, folder):
    got = queries.op5_byte_dedup(spark, folder[0]).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} \
        == {d: (n, n - len(kept), spans, sha(kept)) for d, (n, spans, kept) in brute.byte_dedup(rows, 50).items()}


def test_word_dedup(spark, rows, folder):
    got = queries.op8_word_dedup(spark, folder[0]).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} \
        == {d: (n, gone, sha(kept.encode())) for d, (n, gone, kept) in brute.word_dedup(rows, 20).items()}


def test_decontamination(spark, rows, folder):
    got = queries.op2_decontaminate(spark, folder[0]).collect()
    items = [tuple(r) for r in spark.read.parquet(f"{folder[0]}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d: (n, len(hit), len(names), sha(",".join(names).encode()), bool(hit))
            for d, (n, hit, names) in brute.contamination(rows, items, 10).items()}
    assert {r["doc_id"]: tuple(r[1:6]) for r in got} == want
    assert want[7][1] > 0


def test_near_duplicates(spark, rows, folder):
    got = queries.op3_near_duplicates(spark, folder[0]).collect()
    want = brute.near_components(rows, 3, (85, 100))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} \
        == {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert want[7][1] == 3


def test_token_counts(spark, rows, folder):
    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    library.no_truncation()
    library.no_padding()
    got = queries.op4_token_count(spark, folder[0]).collect()
    want = {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t in rows}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} \
        == {d: (len((t or "").encode()), want[d], want[d] > 2048) for d, t in rows}


def pieces_are_whole(got, texts):
    """Each row's ids lie in exactly one piece, crc included; sequences are gapless and not too long.

    ``texts``: id -> its texts (several rows may share an id)."""
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    ids = {d: Counter(tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,) for t in ts)
           for d, ts in texts.items()}
    found = defaultdict(Counter)
    for r in got:
        found[r["doc_id"]][(r["doc_tokens"], r["start"], r["length"], r["ids_crc32"])] += 1
    assert set(found) == set(ids)
    for d, pieces in found.items():
        assert sum(n * p[2] for p, n in pieces.items()) == sum(n * len(x) for x, n in ids[d].items())
        for (size, start, length, crc), n in pieces.items():
            fitting = [c for x, c in ids[d].items() if len(x) == size and crc ==
                       zlib.crc32(np.array(x[start:start + length], "<u4").tobytes())]
            assert sum(fitting) >= n
        for x, n in ids[d].items():
            if len(ids[d]) == 1 and n == 1:
                ends = [0]
                for _, start, length, _ in sorted(pieces):
                    assert start == ends[-1]
                    ends.append(start + length)
                assert ends[-1] == len(x)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= 2048


def test_packing(spark, rows, folder):
    pieces_are_whole(queries.op10_pack(spark, folder[0]).collect(), {d: [t] for d, t in rows})


def test_packing_of_repeated_and_null_ids(spark, tmp_path):
    rng = random.Random(4)
    rows = [(d, " ".join(rng.choice(["one", "two", "three.", "four"]) for _ in range(rng.randint(0, 3000))))
            for d in (1, 1, 2, 3, 3, None, None)] + [(2, None), (4, "same"), (4, "same")]
    spark.createDataFrame([(d, t, 1, 0) for d, t in rows], "doc_id long, text string, sequence_id int, length int") \
        .repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    pieces_are_whole(queries.op10_pack(spark, str(tmp_path)).collect(), texts)


def test_archives(spark, folder):
    path, pages = folder
    got = queries.op9_warc(spark, path).collect()
    digests = {p: hashlib.sha1((h or "").encode()).hexdigest() for p, _, h in pages}
    largest = {}
    for p, _, h in pages:
        if len((h or "").encode()) >= 1000:
            largest[digests[p]] = max(p, largest.get(digests[p], p))
    want = [(p, len((h or "").encode()), digests[p],
             *(("revisit", top) if (top := largest.get(digests[p], p)) != p else ("response", None)), True)
            for p, _, h in pages]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_nearest(spark, sf):
    rows = [(r[0], np.array(r[1], float)) for r in
            spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = defaultdict(list)
    for r in sorted(queries.op7_nearest(spark, sf).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    space, names = np.stack([v for _, v in rows]), np.array([i for i, _ in rows])
    found = wanted = 0
    for q, v in rows:
        if q % 100:
            continue
        far = np.sqrt(((space - v) ** 2).sum(1))
        near = [int(i) for _, i in sorted((d, i) for d, i in zip(far, names) if i != q)[:10]]
        assert len(got[q]) == len(near)
        for i, score in got[q]:
            assert math.isclose(score, math.sqrt(sum((a - b) ** 2 for a, b in zip(
                space[names == i][0].tolist(), v.tolist()))), rel_tol=1e-12)
        found += len(set(near) & {i for i, _ in got[q]})
        wanted += len(near)
    assert found >= 0.9 * wanted


def grams(text):
    """4-grams of a text by the definition, byte by byte."""
    out, raw = b"\x02", b" " + text.encode() + b" "
    for byte in raw:
        byte = byte + 0x20 if 0x41 <= byte <= 0x5A else byte
        byte = byte if 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20
        if byte != 0x20 or out[-1] != 0x20:
            out += bytes([byte])
    out += b"\x02"
    return [out[k:k + 4] for k in range(len(out) - 3)]


def test_languages_equal_an_exact_dictionary(spark, sf):
    """Bit-sliced filters less false positives decide as exact sets of n-grams do."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    train = [(r["lang"], r["text"]) for r in docs.where(~held_out).collect() if r["lang"] and r["text"] is not None]
    counts = defaultdict(Counter)
    for lang, text in train:
        counts[lang].update(grams(text))
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    top = Counter()
    for lang, c in counts.items():
        for g, n in c.items():
            top[g] = max(top[g], n / total[lang])
    known = {}
    for lang, c in counts.items():
        kept = [g for g, n in c.items() if n / total[lang] >= lang_id.RATIO * top[g]]
        known[lang] = set(sorted(kept, key=lambda g: (-c[g], g))[:lang_id.GRAMS])
    got = {r["doc_id"]: r for r in queries.op1_language_id(spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == set(texts)
    long = " ".join(t for lang, t in train if lang == train[0][0])
    long = long * (SLICE_BYTES // len(long.encode()) + 2)
    model = lang_id.fit(docs.where(~held_out))
    answer = lang_id.predict(spark.createDataFrame([(-1, long)], "doc_id long, text string"), model).first()
    assert answer["lang_pred"] == train[0][0]
    got[-1], texts[-1] = answer, long
    for d, text in texts.items():
        found = grams(text or "")
        if not any(map(str.isalpha, text or "")):
            assert (got[d]["lang_pred"], got[d]["score"]) == ("und", 0)
            continue
        share = {lang: sum(g in known[lang] for g in found) / len(found) for lang in known}
        assert abs(got[d]["score"] - share[got[d]["lang_pred"]]) < max(0.02, 2 / len(found))
        assert share[got[d]["lang_pred"]] >= max(share.values()) - max(0.01, 2 / len(found))
