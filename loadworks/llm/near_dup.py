"""MinHash near-duplicates with an LSH forest.

Every document's set of word shingles gets a signature of ``VALUES`` minima.
The forest has ``TREES`` orders: order t is the signature rotated by t times
``LEAST_DEPTH`` values.  All documents are sorted in each order.  Candidates
are the next ``NEIGHBOURS`` in an order whose common prefix is at least
``LEAST_DEPTH`` values long.  Where more documents than that share a prefix,
the region is looked at on deeper levels too, and on each level everyone is
also a candidate with the ``HUBS`` documents closest to the region's most
common values of those rows of the region that the task holds at a time.

Candidates whose signatures differ too much (by four standard deviations) are
left out; the others are confirmed on the full sets.  Documents with equal
sets are one class from the start.  Confirming goes in two rounds: each
document's likeliest partner first, then the pairs that still join different
components, so a large group of copies costs about one comparison a document.
A region that then still holds several components is looked at as a whole, over
all batches and tasks: its members meet its centre, the member with the most
confirmed links, so copies of one text meet their original however many they are.
Regions that are open even then (templates) are finished exactly: a prefix- and
size-filtered join over the rarest shingles of their members finds every pair of
two components that is similar enough.

Defined results: a document without words (or text, or id) is linked with
nothing; fewer words than a shingle make one shingle of all; rows with equal
ids are separate members of the same id; the component id is the smallest id
reachable.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.columns import LOWER, NOT_BLANK, mix, range_hash, slices, utf8, word_ranges
from loadworks.llm.components import components, small, stored

SHINGLE = 3
SHARE = (85, 100)
TREES = 16
LEAST_DEPTH = 4
VALUES = TREES * LEAST_DEPTH
NEIGHBOURS = 6
HUBS = 4
LEVELS = (4, 6, 8)    # depths at which a region gets hubs
GROUP = 256           # documents compared with one other in a group
SLICE = 1 << 19
RARITY = 1 << 20      # counters of the shingles of open regions, by hash
SALT = 4096           # rows of one shingle dealt to a part of the join

_SEEDS = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and each text's first."""
    low = LOWER[data]
    starts, ends, first = word_ranges(low, offsets, NOT_BLANK)
    words = range_hash(low, starts, ends)
    count = np.diff(first)
    of = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(words))
    last = np.minimum(at + n, first[1:][of]) if len(words) else at
    ok = (last - at == n) | ((at == first[:-1][of]) & (count[of] < n)) if len(words) else np.zeros(0, bool)
    hashes, of = range_hash(words, at[ok], last[ok]), of[ok]
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.searchsorted(of, np.arange(len(count) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """VALUES minima of each non-empty set (empty sets: zeros)."""
    out = np.zeros((len(first) - 1, VALUES), np.uint32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        for k, seed in enumerate(_SEEDS):
            moved = (hashes ^ (seed >> np.uint64(1))) * seed
            out[full, k] = np.minimum.reduceat(moved, first[full]) >> np.uint64(32)
    return out


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def sketch(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, n_shingles, f1, f2, sig): set size, 128-bit fingerprint of the set, signature."""
    def task(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets, SLICE):
                hashes, first = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n)
                other = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
                with np.errstate(over="ignore"):
                    f1 = np.diff(np.concatenate([[np.uint64(0)], np.cumsum(hashes, dtype=np.uint64)])[first])
                    f2 = np.diff(np.concatenate([[np.uint64(0)], np.cumsum(other, dtype=np.uint64)])[first])
                sig = signatures(hashes, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first).astype(np.int64)),
                     _signed(f1), _signed(f2), pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["id", "n_shingles", "f1", "f2", "sig"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(task, "id long, n_shingles long, f1 long, f2 long, sig binary"))


_HEAD = 4 * LEAST_DEPTH                  # bytes of the first values in a key
_WIDTH = _HEAD + VALUES - LEAST_DEPTH    # then a byte of each further value


def _orders(batches):
    """(tree, key, id, n): a document's signature from each tree's first value on."""
    for batch in batches:
        n = len(batch)
        data, _ = utf8(batch.column(2))
        sig = data.view(np.uint32).reshape(n, VALUES)
        for t in range(TREES):
            turned = np.roll(sig, -t * LEAST_DEPTH, axis=1)
            head = turned[:, :LEAST_DEPTH].astype(">u4").view(np.uint8).reshape(n, -1)
            key = np.concatenate([head, (turned[:, LEAST_DEPTH:] & np.uint32(0xFF)).astype(np.uint8)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, t, np.int32)), pa.array([k.tobytes() for k in key], pa.binary()),
                 batch.column(0), batch.column(1)], names=["tree", "key", "id", "n"])


def _least_equal(share: tuple[int, int]) -> int:
    """Equal values below which a pair of that similarity is four standard deviations off."""
    p = share[0] / share[1]
    return int(np.floor(VALUES * p - 4 * np.sqrt(VALUES * p * (1 - p))))


def _meet(a, b, key, ids, sizes, share):
    """(larger id, smaller id, equal values) of the row pairs that may be similar enough."""
    ok = (ids[a] != ids[b]) & (share[1] * np.minimum(sizes[a], sizes[b]) >= share[0] * np.maximum(sizes[a], sizes[b]))
    a, b = a[ok], b[ok]
    equal = LEAST_DEPTH + (key[a, 4 + _HEAD:] == key[b, 4 + _HEAD:]).sum(1)
    ok = equal >= _least_equal(share)
    a, b = a[ok], b[ok]
    return np.maximum(ids[a], ids[b]), np.minimum(ids[a], ids[b]), equal[ok]


def _pairs_of_rows(key, ids, sizes, share):
    """Candidates among rows in the order of a tree (key: tree, first values, further bytes)."""
    n = len(ids)
    out = []
    for d in range(1, min(NEIGHBOURS, n - 1) + 1):
        at = np.flatnonzero((key[d:, :4 + _HEAD] == key[:-d, :4 + _HEAD]).all(1))
        out.append(_meet(at, at + d, key, ids, sizes, share))
    for level in LEVELS:
        prefix = 4 + _HEAD + level - LEAST_DEPTH
        new = np.ones(n + 1, bool)
        new[1:-1] = (key[1:, :prefix] != key[:-1, :prefix]).any(1)
        border = np.flatnonzero(new)
        for begin, end in zip(border[:-1], border[1:]):
            if end - begin <= NEIGHBOURS + 1:
                continue
            region = key[begin:end, 4 + _HEAD:]
            common = np.array([np.bincount(region[:, c]).argmax() for c in range(region.shape[1])])
            central = (region == common).sum(1)
            rows = np.arange(begin, end)
            for hub in begin + np.lexsort((ids[begin:end], -central))[:HUBS]:
                out.append(_meet(rows, np.full(len(rows), hub), key, ids, sizes, share))
    return [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]


def _neighbours(share: tuple[int, int]):
    """Candidates of the sorted rows; the first and last rows of a task are passed on."""
    def task(batches):
        tail, head = None, 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            data, _ = utf8(batch.column(1))
            tree = batch.column(0).to_numpy().astype(">u4").view(np.uint8).reshape(n, 4)
            rows = (np.concatenate([tree, data.reshape(n, _WIDTH)], axis=1),
                    batch.column(2).to_numpy(), batch.column(3).to_numpy())
            if head < NEIGHBOURS:
                first = [x[:NEIGHBOURS - head] for x in rows]
                head += len(first[0])
                yield _edge_batch(*first)
            if tail is not None:
                rows = tuple(np.concatenate([a, b]) for a, b in zip(tail, rows))
            yield _pair_batch(*_pairs_of_rows(*rows, share))
            tail = tuple(x[-NEIGHBOURS:] for x in rows)
        if tail is not None:
            yield _edge_batch(*tail)

    return task


def _pair_batch(a, b, equal):
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(equal, pa.int64()), pa.nulls(len(a), pa.binary())],
        names=["a", "b", "n", "key"])


def _edge_batch(key, ids, sizes):
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.nulls(len(ids), pa.int64()), pa.array(sizes, pa.int64()),
         pa.array([k.tobytes() for k in key], pa.binary())], names=["a", "b", "n", "key"])


def _border_task(share: tuple[int, int]):
    """Candidates among the rows at the borders of tasks, of one tree."""
    def task(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("a", "ascending")])
        data, _ = utf8(rows["key"].combine_chunks())
        found = _pairs_of_rows(data.reshape(len(rows), 4 + _WIDTH), rows["a"].to_numpy(), rows["n"].to_numpy(), share)
        return pa.table(dict(zip(("a", "b", "n"), (pa.array(x, pa.int64()) for x in found))))

    return task


def candidates(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b, equal) with b < a: pairs that meet in the forest, and their equal signature values."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.select("id", "n_shingles", "sig").mapInArrow(
        _orders, "tree int, key binary, id long, n long")
    met = stored(rows.repartitionByRange(parts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
                 .mapInArrow(_neighbours(share), "a long, b long, n long, key binary"), "forest")
    # neighbours on two sides of a border of tasks: a dozen rows a task
    crossed = (met.where("b is null").groupBy(F.substring("key", 1, 4).alias("tree"))
               .applyInArrow(_border_task(share), "a long, b long, n long"))
    return (met.where("b is not null").select("a", "b", "n").unionByName(crossed)
            .groupBy("a", "b").agg(F.max("n").alias("equal")))


def _prefixes(batches):
    """(region, id): the prefixes of LEAST_DEPTH values of a document's signature, a row a tree."""
    for batch in batches:
        n = len(batch)
        data, _ = utf8(batch.column(1))
        sig = data.view(np.uint32).reshape(n, TREES, LEAST_DEPTH)
        at = LEAST_DEPTH * np.arange(n)
        for t in range(TREES):
            region = range_hash(sig[:, t].ravel(), at, at + LEAST_DEPTH)
            yield pa.RecordBatch.from_arrays([_signed(mix(region + np.uint64(t))), batch.column(0)],
                                             names=["region", "id"])


def regions(sets: DataFrame) -> DataFrame:
    """(region, id) of the members of regions too large for everybody to be a neighbour of everybody."""
    rows = sets.select("id", "sig").mapInArrow(_prefixes, "region long, id long")
    dense = stored(rows.groupBy("region").count().where(F.col("count") > NEIGHBOURS + 1).select("region"), "dense")
    return stored(rows.join(small(dense), "region", "left_semi"), "regions")


def open_members(members: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(region, id, label) of the members of regions with several components, and those regions."""
    named = members.join(label.withColumnRenamed("v", "id"), "id", "left").select(
        "region", "id", F.coalesce("label", "id").alias("label"))
    several = stored(named.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                     .where("low < high").select("region"), "open-regions")
    return stored(named.join(small(several), "region", "left_semi"), "open-members"), several


def to_centres(members: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b): the members of open regions, each with its region's centre b of another component."""
    ends = links.select(F.col("a").alias("id")).unionAll(links.select(F.col("b").alias("id")))
    degree = ends.groupBy("id").agg(F.count("*").alias("n"))
    centre = stored(members.join(degree, "id").groupBy("region")
                    .agg(F.max(F.struct("n", "id", "label")).alias("c"))
                    .select("region", F.col("c.id").alias("b"), F.col("c.label").alias("other")), "centres")
    return members.join(small(centre), "region").where("label <> other").select(F.col("id").alias("a"), "b").distinct()


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle, at most: counted by the shingles' hashes modulo RARITY."""
    def task(batches):
        total = np.zeros(RARITY, np.int64)
        for batch in batches:
            data, _ = utf8(batch.column(0))
            total += np.bincount((data.view(np.uint64) % np.uint64(RARITY)).astype(np.int64), minlength=RARITY)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    found = (sets.select("set").mapInArrow(task, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
             .toArrow())  # RARITY numbers at most
    out = np.zeros(RARITY, np.int64)
    out[found["slot"].to_numpy()] = found["n"].to_numpy()
    return out


def _rarest(rarity, share: tuple[int, int]):
    """(shingle, parts, id, label, size, at, indexed) of each set's rarest shingles.

    Sets a and b (size of a at least that of b) that are similar enough share
    one of the first ``size - least + 1`` shingles of a and of b in any common
    order, where least is the smallest overlap that can suffice: for a the share
    of its size, for b (``indexed``) the share of sets of equal sizes.
    """
    def task(batches):
        counts = rarity.value
        for batch in batches:
            out = [[] for _ in range(7)]
            for i, label, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = np.frombuffer(s.as_buffer(), np.uint64)
                n = len(own)
                held = counts[(own % np.uint64(RARITY)).astype(np.int64)]
                first = np.lexsort((own, held))[:n - -(-share[0] * n // share[1]) + 1]
                indexed = n - -(-2 * share[0] * n // sum(share)) + 1
                size = len(first)
                for col, value in zip(out, (own[first].view(np.int64), held[first] // SALT + 1, np.full(size, i),
                                            np.full(size, label), np.full(size, n), np.arange(size),
                                            np.arange(size) < indexed)):
                    col.append(value)
            flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in flat[:6]],
                                              pa.array(flat[6].astype(bool))],
                                             names=["shingle", "parts", "id", "label", "size", "at", "indexed"])

    return task


def across(sets: DataFrame, labels: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b) with b < a: all pairs of sets of different labels that may be similar enough (a set join)."""
    rarity = sets.sparkSession.sparkContext.broadcast(_rarity(sets))
    rows = stored(sets.join(labels, "id").select("id", "label", "set").mapInArrow(
        _rarest(rarity, share), "shingle long, parts long, id long, label long, size long, at long, indexed boolean"),
        "rarest")
    probe = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    index = (rows.where("indexed").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("shingle", "part", *[F.col(c).alias(f"{c}2") for c in ("id", "label", "size", "at")]))
    num, den = share
    overlap = F.least(F.col("size") - F.col("at"), F.col("size2") - F.col("at2"))  # at most, from here on
    met = probe.join(index, ["shingle", "part"]).where(
        (F.col("label") != F.col("label2"))
        & ((F.col("size") > F.col("size2")) | ((F.col("size") == F.col("size2")) & (F.col("id") > F.col("id2"))))
        & (num * F.col("size") <= den * F.col("size2"))
        & (overlap * (num + den) >= num * (F.col("size") + F.col("size2"))))
    return met.select(F.greatest("id", "id2").alias("a"), F.least("id", "id2").alias("b")).distinct()


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, set) of the wanted documents: sorted shingle hashes as bytes."""
    def task(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets, SLICE):
                hashes, first = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                    names=["id", "set"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.join(small(wanted), "id", "left_semi").mapInArrow(task, "id long, set binary")


def _confirm(share: tuple[int, int]):
    """Compares one document's set with those of the others of its group."""
    def task(group: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        hub = group["hub"][0].as_py()
        roles, ids = group["is_hub"].to_pylist(), group["id"].to_pylist()
        own = [np.frombuffer(s.as_buffer(), np.uint64) for s, r in zip(group["set"], roles) if r]
        for s, r, i in zip(group["set"], roles, ids):
            if r:
                continue
            other = np.frombuffer(s.as_buffer(), np.uint64)
            for mine in own:
                slot = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
                common = int((mine[slot] == other).sum()) if len(mine) else 0
                if share[1] * common >= share[0] * (len(mine) + len(other) - common):
                    out_a.append(i)
                    out_b.append(hub)
                    break
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return task


def confirm(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; b's set goes to groups of GROUP others."""
    per = pairs.groupBy("b").count().select("b", F.ceil(F.col("count") / GROUP).cast("int").alias("parts"))
    dealt = pairs.join(per, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
    others = dealt.select("a", "b", "part").join(sets, dealt["a"] == sets["id"]).select(
        F.col("b").alias("hub"), "part", F.lit(False).alias("is_hub"), "id", "set")
    hubs = per.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    hubs = hubs.join(sets, hubs["b"] == sets["id"]).select(
        F.col("b").alias("hub"), "part", F.lit(True).alias("is_hub"), "id", "set")
    return (others.unionByName(hubs).groupBy("hub", "part")
            .applyInArrow(_confirm(share), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    ``share`` is the least similarity as numerator and denominator.  Shuffled
    are sketches, order keys, the links, and the sets of documents with a
    candidate; texts stay where they are unless those documents are too many
    to be broadcast as ids.
    """
    rows = stored(sketch(docs, id_col, text_col, shingle), "sketch")
    linked = rows.where("n_shingles > 0 and id is not null")
    face = ["f1", "f2", "n_shingles"]
    classes = stored(linked.groupBy(*face).agg(F.min(F.struct("id", "sig")).alias("one"))
                     .select(*face, "one.id", "one.sig"), "classes")
    pairs = stored(candidates(classes, share), "pairs")
    wanted = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")
    sets = _sets(docs, wanted, id_col, text_col, shingle)
    # rows that share an id: only the sets of their classes count
    sets = stored(sets.dropDuplicates(["id", "set"]), "sets")
    ends = pairs.select(F.col("a").alias("v"), F.struct("equal", "a", "b").alias("p")).unionByName(
        pairs.select(F.col("b").alias("v"), F.struct("equal", "a", "b").alias("p")))
    best = stored(ends.groupBy("v").agg(F.max("p").alias("p")).select("p.a", "p.b").distinct(), "best")
    links = stored(confirm(best, sets, share), "confirmed")
    label = components(links)
    side = lambda c: label.select(F.col("v").alias(c), F.col("label").alias(f"l{c}"))
    open_pairs = stored(
        pairs.join(best, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
        .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"), "open")
    links = stored(links.unionByName(confirm(open_pairs, sets, share)), "links-of-pairs")
    label = components(links)
    # members of a dense region that the task's hubs and neighbours left apart
    dense = regions(classes)
    members, several = open_members(dense, label)
    if several.limit(1).count():
        sets = stored(_sets(docs, stored(members.select("id").distinct(), "members"), id_col, text_col, shingle)
                      .dropDuplicates(["id", "set"]), "open-sets")
        links = stored(links.unionByName(confirm(stored(to_centres(members, links), "to-centres"), sets, share)),
                       "links-of-centres")
        label = components(links)
        members, several = open_members(dense, label)
        if several.limit(1).count():
            pairs = stored(across(sets, members.select("id", "label").distinct(), share), "across")
            label = components(links.unionByName(confirm(pairs, sets, share)))
    named = classes.select(*face, F.col("id").alias("v")).join(label, "v", "left").select(
        *face, F.coalesce("label", "v").alias("component_id"))
    known = rows.select("id", *face).join(named, face, "left")
    return known.select("id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component_id"))
                        .otherwise(F.col("id")).alias("component_id"))
