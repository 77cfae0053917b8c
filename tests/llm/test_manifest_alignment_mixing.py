"""Merkle manifest, token alignment and mixing against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadworks.llm import align, merkle, mixing, queries
from tests.llm import brute

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, tmp_path, rows, extra=True):
    """A folder with documents (with columns that clash with those of the operators)."""
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("pos", "n", "group", "order", "leaf", "id", "size", "payload"):
            df = df.withColumn(c, F.lit("extra"))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# ------------------------------------------------------------------ manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*fields):
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(level):
    """Root of a list of digests, and the (left, right) siblings of every leaf, bottom up."""
    proofs, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, p in enumerate(at):
            run = p // 3 * 3
            proofs[k].append(("".join(level[run:p]), "".join(level[p + 1:run + 3])))
            at[k] = p // 3
        level = [h(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], proofs


def manifest_of(rows):
    """All columns of the query, from the definition."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made, subroots = [], []
    for name in names:
        own = [(r, leaf_of(r[0], r[3], r[2], r[4], r[1])) for r in groups[name]]
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        subroot, proofs = tree([x[1] for x in own])
        subroots.append(subroot)
        made.append([(r, leaf, p) for (r, leaf), p in zip(own, proofs)])
    if not subroots:
        return []
    root, upper = tree(subroots)
    out = []
    for part, subroot, above in zip(made, subroots, upper):
        for r, leaf, proof in part:
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf_of(r[0], r[3], r[2], r[4], text)
            for left, right in proof + above:
                node = h(left, node, right)
            out.append((r[0], leaf, subroot, root, h(*(a + b for a, b in proof + above)), node, node == root))
    return out


def manifest_rows(seed=1):
    """Sources of one leaf up to several blocks, nulls everywhere, repeated ids and rows."""
    rng = random.Random(seed)
    rows, n = [], 0
    for source, size in (("a", 1), ("b", 3), ("é", 4), (None, 10), ("z|", 243), ("hot", 244), ("y", 800), ("", 2)):
        for _ in range(size):
            text = "".join(rng.choice("ab \né") for _ in range(rng.randint(0, 12)))
            rows.append((n, text, rng.choice(["en", None]), source, rng.choice([None, len(text)])))
            n += 1
    rows += [(7, "seven\nagain", None, "y", 3)] * 3 + [(None, "no id\n", "en", "y", 1), (7, None, "en", "b", 0)]
    rng.shuffle(rows)
    return rows


def test_manifest_equals_brute_force(spark, tmp_path):
    rows = manifest_rows()
    got = queries.op11_merkle_manifest(spark, table(spark, tmp_path, rows)).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted(map(tuple, got), key=key) == sorted(manifest_of(rows), key=key)


@pytest.mark.parametrize("rows", [[], [(5, None, None, None, None)], [(1, "a", "en", "s", 1), (2, "b", "en", "t", 1)]])
def test_manifest_of_few_rows(spark, tmp_path, rows):
    got = queries.op11_merkle_manifest(spark, table(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(manifest_of(rows))


def test_manifest_keeps_further_columns_and_finds_a_changed_digest(spark):
    rows = spark.range(30).select(F.col("id").alias("k"), F.lit("g").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"),
                                  (F.col("id") * 2).alias("pos"))
    made = merkle.manifest(rows, "g", "k").collect()
    assert all(r["pos"] == 2 * r["k"] for r in made)
    for r in made:
        node = r["leaf"]
        for s in r["proof"]:
            node = h(s["left"], node, s["right"])
        assert node == r["root"] == r["subroot"]
        assert h(r["proof"][0]["left"], "0" * 64, r["proof"][0]["right"]) != r["root"]


# ------------------------------------------------------------------ alignment

ODD = [None, "", " ", "  two  spaces ", "▁ mark", "<|endoftext|> and <s> </s> <unk>", "naïve café 日本語 😀", "tab\tline\r\nend\n\n",
       "x\x00y", "a" * 3000, "word " * 3000, "I'm don't 12345 ...!!", " nbsp em", "ﬁ ① Ⅷ é", " " * 50 + "x"]


def aligned_of(texts):
    """The columns of the query, with the libraries alone and every shared end."""
    a_lib = Tokenizer.from_file(A)
    a_lib.encode_special_tokens = True
    vocab = {i: t for t, i in a_lib.get_vocab().items()}
    letters = {c: b for b, c in enumerate(align.byte_letters())}
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B)

    def a_bytes(i):
        return bytes(letters[c] for c in vocab[i])

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(ids, size):
        at, out = 0, []
        for i in ids:
            at += size(i)
            out.append(at)
        return out

    rows, pairs = [], Counter()
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            rows.append((0, 0, 0, [], ""))
            continue
        a_end, b_end = ends(a, lambda i: len(a_bytes(i))), ends(b, lambda i: len(b_bytes(i)))
        shared, groups, links, i, j = sorted(set(a_end) & set(b_end)), [], [], 0, 0
        for s in shared:
            k, m = a_end.index(s, i) + 1, b_end.index(s, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        pairs.update(links)
        rows.append((len(a), len(b), len(groups), links, h(";".join(groups))))
    best = defaultdict(int)
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    return [(n_a, n_b, n_groups, len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links), digest)
            for n_a, n_b, n_groups, links, digest in rows]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_the_libraries(spark, sf, tmp_path):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, "null id", None, None, None)] * 2
    got = queries.op12_token_alignment(spark, table(spark, tmp_path, rows))
    assert set(got.columns) == {"doc_id", *COLUMNS}
    got = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in got.collect()]
    want = [(r[0], *x) for r, x in zip(rows, aligned_of([r[1] for r in rows]))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert want[0][1:] == (0, 0, 0, 0, 0, 0, "") and want[4][1] == 0  # null; a text that holds the space mark


def test_alignment_of_random_texts(spark):
    rng = random.Random(3)
    alphabet = list("abcdeé  \n\t.,'0123ßЖ日😀́​▁<>|s") + ["<s>", "the ", " of"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: tuple(r[c] for c in COLUMNS) for r in align.links(df, A, B).collect()}
    assert [got[i] for i in range(len(texts))] == aligned_of(texts)


def test_alignment_of_an_empty_table_and_of_a_small_memory(spark, monkeypatch):
    df = spark.createDataFrame([(1, "some words of a text"), (2, "other words of a text")], "doc_id long, text string")
    assert align.links(df.where("false"), A, B).count() == 0
    own = align.Vocabularies(A, B)
    texts = ["some words of a text and other words", None, "of another text", "some words"]
    whole = own.align(texts)
    monkeypatch.setattr(align, "REMEMBERED", 2)
    assert all(np.array_equal(x, y) for x, y in zip(align.Vocabularies(A, B).align(texts), whole))
    again = own.align(texts)  # all windows are known
    assert all(np.array_equal(x, y) for x, y in zip(again, whole))
    kept = align.align(df, A, B, keep_groups=True).collect()
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in kept)


def test_windows_that_only_share_their_hash_stand_alone(monkeypatch):
    a, b = np.array([1, 2, 1, 2, 1, 3, 1], np.int32), np.array([5, 5, 5, 6], np.int32)
    at_a, at_b = np.array([0, 2, 4, 6, 7]), np.array([0, 1, 2, 3, 4])
    monkeypatch.setattr(align, "mix", lambda h: np.zeros(len(h), np.uint64))
    first, pair = align.same_windows(a, b, at_a, at_b)
    ids = lambda w: (tuple(a[at_a[w]:at_a[w + 1]]), tuple(b[at_b[w]:at_b[w + 1]]))
    assert [ids(first[p]) for p in pair] == [ids(w) for w in range(4)]


def test_linked_pairs_are_bounded_by_the_vocabularies(spark):
    own = align.vocabularies(A, B)
    assert own.bound < 1_000_000
    df = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    aligned = align.align(df, A, B)
    with pytest.raises(ValueError):
        align.score(aligned, align.pair_counts(aligned), len(own.b_bytes), 1)


def test_a_run_of_blanks_that_the_rank_encoder_cannot_split():
    own = align.vocabularies(A, B)
    own_library = Tokenizer.from_file(A)
    text = "x" + " " * 1_200_000 + "y"
    assert own.encode_a(text) == own_library.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------------ mixing

def shares(sizes, most=3):
    """Target of each source, by sharing again until none is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        over = sum(weight[s] for s in order if s not in full)
        target = {s: float(most * sizes[s]) if s in full else weight[s] * rest / over for s in order}
        more = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not more:
            return target
        full |= more


def mixing_rows(seed=5):
    """Small, large, tiny, empty and null sources; empty texts; repeated ids and rows."""
    rng = random.Random(seed)
    rows, n = [], 0
    for source, size in (("a", 700), ("tiny", 3), ("b", 40), (None, 90), ("hot", 3000), ("nothing", 5), ("Z", 60), ("é", 25)):
        for _ in range(size):
            words = 0 if source == "nothing" else rng.choice([0, 1, 5, rng.randint(1, 400)])
            rows.append((n, rng.choice([" ", "\n", "\t\r "]).join(["w"] * words) if words else rng.choice([None, "", " \n"]),
                         "en", source, 1))
            n += 1
    rows += [(3, "the same row", "en", "a", 1)] * 200 + [(None, "no id at all", "en", "b", 1)] * 3
    rng.shuffle(rows)
    return rows


def check_mix(rows, got, near):
    size = lambda t: len(brute.BLANK_WORDS.findall(t or ""))
    total = defaultdict(int)
    for r in rows:
        total[r[3]] += size(r[1])
    want = shares(total)
    by_row = Counter((r[0], size(r[1]), total[r[3]], round(want[r[3]], 6)) for r in rows)
    assert by_row == Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got)
    assert all(0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in got)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        key = (r["source_size"], round(r["target"], 6))
        taken[key] += r["taken"]
        largest[key] = max(largest[key], r["size"])
    for source, t in want.items():
        key = (total[source], round(t, 6))
        assert abs(taken[key] - t) <= max(near * t, largest[key] / 2 + 1e-6), source
    return want


def test_mix_meets_its_targets(spark, tmp_path):
    rows = mixing_rows()
    df = queries.op13_mixing(spark, table(spark, tmp_path, rows))
    want = check_mix(rows, df.collect(), 0.002)
    assert any(t == 0 for t in want.values()) and sum(want.values()) > 0


def test_mix_depends_on_the_rows_alone(spark, tmp_path):
    rows = mixing_rows(6)
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: tuple(map(str, r))
    first = sorted(map(tuple, mixing.mix(df.repartition(1), block=200).collect()), key=key)
    again = sorted(map(tuple, mixing.mix(df.repartition(7, "n_chars", "text"), block=200).collect()), key=key)
    assert first == again
    check_mix(rows, mixing.mix(df, block=200).withColumnRenamed("id", "doc_id").collect(), 0.002)


def test_mix_of_the_documents(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    check_mix(rows, queries.op13_mixing(spark, sf).collect(), 0.02)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "a b", None, "s", 1)], [(1, "a b c", "", "s", 1), (2, "d", "", "t", 1)]])
def test_mix_of_few_rows(spark, tmp_path, rows):
    check_mix(rows, queries.op13_mixing(spark, table(spark, tmp_path, rows)).collect(), 0)


def test_flight_keeps_words_and_number():
    rng = np.random.default_rng(9)
    for n in (0, 1, 2, 3, 50, 4000):
        p, sizes = rng.random(n), rng.integers(0, 500, n).astype(float)
        out = mixing.flight(p, sizes, np.random.default_rng(1))
        assert ((out >= 0) & (out <= 1)).all() and ((out > 0) & (out < 1)).sum() <= 2
        assert abs(out.sum() - p.sum()) < 1e-5 and abs((out * sizes).sum() - (p * sizes).sum()) < 1e-2
        landed = mixing.landing(out, sizes)
        assert set(landed.tolist()) <= {0.0, 1.0}


def test_flight_keeps_the_probabilities():
    """Over many runs a unit is taken as often as its probability says."""
    p, sizes = np.array([0.1, 0.5, 0.7, 0.3, 0.9, 0.45] * 5), np.arange(30.0) + 1
    mean = np.mean([mixing.flight(p, sizes, np.random.default_rng(s)) for s in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def test_words_are_counted_in_constant_memory_by_two_replacements(spark):
    texts = [None, "", " ", "a", " a b\t\tc\x0b\x0cd\r\ne ", "é ü x\x00y", "w " * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in df.collect()] == [len(brute.BLANK_WORDS.findall(t or "")) for t in texts]
