"""Language id, decontamination, token counts, licences and packing."""

import json
import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadworks.llm import decontaminate, lang_id, license_scan, packing, queries, token_count
from tests.llm import brute

ODD = [None, "", " \n\t ", "a", "12345 !!", "Σας ΟΔΟΣ Σ", "<|endoftext|>x<|startoftext|><|endoftext|>",
       "I'm can't 12345 ...!!", "İstanbul ß ﬁ é", "日本語 テスト 😀😀", "a" * 6000, "x\x00y", "word " * 4000]


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def odd_frame(spark):
    rows = [(i, t, None, None, "extra") for i, t in enumerate(ODD)] + [(None, "a null id", "en", 1.0, "extra")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, n_words string")


def empty(df):
    return df.where("false")


# --- language id

def test_language_accuracy_on_held_out_documents(spark, sf):
    docs = docs_of(spark, sf)
    got = queries.op1_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert got.count() == docs.count() and held.count() > 10
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_texts(spark, sf):
    model = lang_id.fit(docs_of(spark, sf))
    got = {r["doc_id"]: r for r in lang_id.predict(odd_frame(spark), model).collect()}
    for i, text in enumerate(ODD):
        lettered = any(c.isalpha() for c in text or "")
        assert (got[i]["lang_pred"] != "und") == lettered
        assert 0 <= got[i]["score"] <= 1 and (lettered or got[i]["score"] == 0)
    assert lang_id.predict(empty(odd_frame(spark)), model).count() == 0
    nothing = lang_id.fit(empty(docs_of(spark, sf)))
    assert {r["lang_pred"] for r in lang_id.predict(odd_frame(spark), nothing).collect()} == {"und"}


def test_only_the_most_frequent_languages_are_learned(spark):
    """A dirty language column: masks of several words, a bound on what is learned, ties by name."""
    rows = [(100 * k + n, f"{chr(0x4E00 + 7 * k) * 9} {chr(0x5E00 + 5 * k) * 8}", f"l{k:03}")
            for k in range(150) for n in range(2 if k < 140 else 1)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(train, languages=140)
    assert model.languages == [f"l{k:03}" for k in range(140)]
    assert model.masks.shape[1] == 3
    got = lang_id.predict(train.where("lang < 'l140'"), model).collect()
    assert len(got) == 280 and all(r["lang_pred"] == r["lang"] for r in got)
    assert lang_id.fit(train, languages=141).languages[-1] == "l140"


def test_filters_hold_what_they_were_given():
    grams = np.arange(1, 3000, 7).astype(np.uint32)
    size = 1 << 14
    masks = np.zeros((size, 1), np.uint64)
    masks[np.unique(np.concatenate(lang_id._slots(grams, size))), 0] = 1
    hit = np.ones(len(grams), np.uint64)
    for slot in lang_id._slots(grams, size):
        hit &= masks[slot, 0]
    assert hit.all()


# --- decontamination

def test_decontamination_equals_brute_force(spark, sf):
    docs, items = docs_of(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute.contamination([(r["doc_id"], r["text"]) for r in docs.collect()],
                               [(r["item_id"], r["text"]) for r in items.collect()], 10)
    for size in (decontaminate.BLOCK_BYTES, 2000):  # one block, several blocks
        got = decontaminate.scan(docs, items, block_bytes=size).collect()
        assert {r["doc_id"]: (r["n_words"], r["hits"], r["items"]) for r in got} == want
    assert any(hits for _, hits, _ in want.values())


def test_decontamination_of_odd_rows(spark):
    items = spark.createDataFrame(
        [(1, "Alpha beta"), (2, None), (3, "..."), (4, "one two three four five six seven eight nine ten"),
         (4, "one two three four five six seven eight nine ten"), (None, "alpha"), (None, "gamma delta")],
        "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "see ALPHA-beta!", "x"), (2, None, "x"), (3, "", "x"), (4, "alphabeta", "x"), (4, "alphabeta", "x"),
         (5, "one two three four five six seven eight nine ten", "x"), (6, "only gamma delta here", "x"),
         (None, "alpha beta", "x")], "doc_id long, text string, hits string")
    for size in (decontaminate.BLOCK_BYTES, 20):
        got = decontaminate.scan(docs, items, block_bytes=size).select("doc_id", "n_words", "hits", "items").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
            (1, 3, [1, 2], ["1"]), (2, 0, [], []), (3, 0, [], []), (4, 1, [], []), (4, 1, [], []),
            (5, 10, list(range(10)), ["4"]), (6, 4, [1, 2], []), (None, 2, [0, 1], ["1"])]))
    cut = {r["doc_id"]: r["text"] for r in decontaminate.clean(docs, items).collect()}
    assert cut[1] == "see !" and cut[2] is None and cut[4] == "alphabeta" and cut[5] == ""
    assert decontaminate.scan(docs, empty(items)).where("size(hits) > 0").count() == 0
    assert decontaminate.scan(empty(docs), items).count() == 0


def test_long_items_are_cut_into_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 7)
    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:10])), (3, " ".join(words[50:59]))],
                                  "item_id long, text string")
    rows = [(i, "x " + " ".join(words[i:i + 10]) + " y") for i in range(55)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.contamination(rows, [(r["item_id"], r["text"]) for r in items.collect()], 10)
    got = {r["doc_id"]: (r["n_words"], r["hits"], r["items"]) for r in decontaminate.scan(docs, items, block_bytes=100).collect()}
    assert got == want


def test_windows_take_few_bytes_a_word():
    words = " ".join(f"word{i % 9973}x{i}" for i in range(200_000))
    own = decontaminate.WindowSet([("a", words)], 10)
    held = sum(x.nbytes for x in (own.low, own.starts, own.ends, own.item, *own.windows[10]))
    assert held < 50 * 200_000


# --- token counts

def test_token_counts_equal_the_library(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = docs_of(spark, sf).select("doc_id", "text").unionByName(
        odd_frame(spark).select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in token_count.count_tokens(docs, path).collect():
        text = texts[r["id"]]
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids), text[:60]
    assert token_count.count_tokens(empty(docs), path).count() == 0


def test_token_counts_of_all_characters_equal_the_library():
    """Every assigned code point in short texts, and random mixtures of letters, marks and blanks."""
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = token_count.Counter(path), Tokenizer.from_file(path)
    texts = [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1" for c in range(1, 0x32000)
             if unicodedata.category(chr(c)) not in ("Cs", "Co", "Cn")]
    rng = random.Random(1)
    letters = [*map(chr, range(1, 0x3000)), *map(chr, range(0xA000, 0xB000)), "𲠆", "ꟋꟋ",
               *(["a", "b", " ", "\n", "Σ", "é", "\u0301", "1", "'s", "<|endoftext|>"] * 200)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(20_000)]
    for i in range(0, len(texts), 20_000):
        part = texts[i:i + 20_000]
        for text, e in zip(part, library.encode_batch(part, add_special_tokens=False)):
            assert own.count(text) == len(e.ids), text


def test_unknown_tokenizer_files_are_refused(tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["model"]["unk_token"] = "<|endoftext|>"
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_count.Counter(str(tmp_path / "t.json"))


def test_heap_merge_skips_stale_pairs():
    own = token_count.Counter(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for word in ("aaaaaaaaa", "banana", "mississippi", "thththth", "ananananas"):
        assert own.word(word) == len(library.encode(word, add_special_tokens=False).ids)


# --- licences

def test_licences_are_found_and_nothing_else(spark, sf):
    docs = docs_of(spark, sf)
    model = license_scan.fit(docs)
    found = license_scan.scan(docs, model).groupBy("family").count().collect()
    for r in found:
        notice = {"MIT": "MIT License", "Apache-2.0": "Apache License", "GPL-3.0": "GNU General",
                  "CC-BY-NC-4.0": "CC BY-NC"}[r["family"]]
        lines = docs.select(F.explode(F.split("text", "\n")).alias("p")).where(F.col("p").contains(notice))
        assert r["count"] == lines.count()
    rows = spark.createDataFrame(
        [(1, "intro\nReleased under the MIT License.\nend", 0), (2, None, 0), (3, "", 0),
         (4, "He got a license to drive. MIT is a school.", 0),
         (5, "This work is licensed under a Creative Commons Attribution 4.0 International License.", 0),
         (5, "Licensed under CC BY 4.0.\n" * 3, 0), (None, "Released under the MIT License.", 0)],
        "doc_id long, text string, part int")
    got = license_scan.scan(rows, model).collect()
    assert sorted((str(r["id"]), r["part"], r["family"]) for r in got) == [
        ("1", 1, "MIT"), ("5", 0, "CC-BY-4.0"), ("5", 0, "CC-BY-4.0"), ("5", 1, "CC-BY-4.0"),
        ("5", 2, "CC-BY-4.0"), ("None", 0, "MIT")]
    assert license_scan.scan(empty(rows), model).count() == 0


# --- packing

def test_headers_without_the_word_licence_are_not_ordinary(spark, sf):
    """MIT, BSD and CC0 headers in the sampled documents neither train unknown nor lift thresholds."""
    headers = [(f, t) for f, t, _ in license_scan.NOTICES
               if not any(w in t.lower() for w in ("licen", "copyright", "copyleft"))]
    headers = [(f, t) for f, t in headers if f in ("MIT", "BSD", "CC0-1.0")]
    plain = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect() if r["text"]]
    rows = [(i, headers[i % len(headers)][1] + "\n" + plain[i % len(plain)]) for i in range(300)]
    rows += [(1000 + k, t) for k, (_, t, _) in enumerate(license_scan.NOTICES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["id"], r["family"]) for r in license_scan.scan(docs, license_scan.fit(docs)).collect()}
    assert {(i, headers[i % len(headers)][0]) for i in range(300)} <= got
    assert {(1000 + k, f) for k, (f, _, _) in enumerate(license_scan.NOTICES)} <= got


GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
WRAPPED = {
    "gpl3": (GPL3, {"GPL-3.0"}),
    "gpl2": (GPL3.replace("version 3", "version 2"), {"GPL-2.0"}),
    "gpl2 line": ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
    "mit": ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\n"
            "documentation files", {"MIT"}),
    "bsd": ("Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that", {"BSD"}),
    "apache": ("Licensed under the Apache License,\nVersion 2.0.", {"Apache-2.0"}),
    "apache, number wrapped": ("This file is licensed under the Apache License, Version\n2.0. Ask before", {"Apache-2.0"}),
    "two": ("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
    "split by a blank line": ("This program is free software: you can redistribute it and/or modify\n\nit under the terms of the\n\n"
                              "GNU General Public License as published by", set()),
    "epl": ("This program is made available under the terms of the Eclipse Public License v. 2.0.", set()),
    "cc by-nd": ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", set()),
    "cc by-nc-sa": ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
                    set()),
    "cc by-nc-sa line": ("Licensed under CC BY-NC-SA 4.0.", set()),
    "gpl 1": ("This work is licensed under the GNU General Public License, version 1.", set()),
    "long line": ("word " * 30_000 + "Released under the MIT License. " + "other " * 30_000, {"MIT"}),
}


def test_wrapped_notices_versions_and_near_misses(spark, sf):
    plain = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(20).collect()]
    rows = [(k, name, f"{plain[k % 20]}\n\n{text}\n\n{plain[(k + 1) % 20]}") for k, (name, (text, _)) in enumerate(WRAPPED.items())]
    docs = spark.createDataFrame(rows, "doc_id long, family string, text string")
    model = license_scan.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    found = defaultdict(set)
    for r in license_scan.scan(docs, model).collect():
        found[r["id"]].add(r["family"])
    alone = {r["id"] for r in license_scan.scan(spark.createDataFrame(
        [(k, t or "") for k, t in enumerate(plain)], "doc_id long, text string"), model).collect()}
    assert len(alone) <= 2  # the documents around hold few notices of their own
    quiet = {k for k in range(len(rows)) if not {k % 20, (k + 1) % 20} & alone}
    got = {rows[k][1]: found[k] for k in quiet}
    assert got == {rows[k][1]: WRAPPED[rows[k][1]][1] for k in quiet} and len(quiet) >= len(rows) - 4


def check_packing(rows, texts, path, length=packing.LENGTH):
    """Every id in exactly one piece, sequences gapless and at most ``length``; returns the padding share."""
    library = Tokenizer.from_file(path)
    ids = {d: library.encode(t or "", add_special_tokens=False).ids + [packing.END_ID] for d, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.array(ids[r["id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert len(own) == r["length"] > 0 and zlib.crc32(own.tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["id"]])
        pieces[r["id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for group, total in [*((p, len(ids[d])) for d, p in pieces.items()), *((s, None) for s in sequences.values())]:
        at = 0
        for start, size in sorted(group):
            assert start == at
            at += size
        assert at == (total or at)
    assert set(pieces) == set(ids)
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    assert max(sizes) <= length
    assert len(sizes) <= 1.1 * sum(sizes) / length + 4  # a short tail a task at most
    return sum(0 if n & (n - 1) == 0 else length - n for n in sizes) / max(1, sum(sizes))


def test_packing_places_every_id_once(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = docs_of(spark, sf).select("doc_id", "text").unionByName(
        odd_frame(spark).where("doc_id is not null").select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    padding = check_packing(packing.pack(docs, path).collect(), texts, path)
    assert padding < 0.02
    check_packing(packing.pack(docs, path, length=64).collect(), texts, path, 64)
    assert packing.pack(empty(docs), path).count() == 0


def test_packing_encodes_very_long_runs_of_blanks():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = packing.Encoder(path), Tokenizer.from_file(path)
    for text in ("a" + " " * 1_200_000 + "b", "\n" * 1_200_000):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n, length = int(rng.integers(1, 60)), 16
        ends = np.unique(np.append(rng.integers(1, n + 1, 3), n))
        sentence = rng.random(n) < 0.3
        at, cost = packing.candidate_cuts(sentence, ends, 4)
        best = {0: 0}
        for j, c in zip(at[1:].tolist(), cost[1:].tolist()):
            best[j] = c + packing.SEQUENCE_COST + min(best[i] + (0 if (j - i) & (j - i - 1) == 0 else length - j + i)
                              for i in best if j - i <= length)
        cuts = packing.choose_cuts(at, cost, length)
        own = dict(zip(at.tolist(), cost.tolist()))
        paid = sum(packing.SEQUENCE_COST + own[j] + (0 if (j - i) & (j - i - 1) == 0 else length - j + i)
                   for i, j in zip(cuts[:-1], cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == n and paid == best[n]
