"""Distributed search for repeated windows, shared by the substring operators.

1. Each task finds the anchors of its texts and keeps, of equal stretches, the
   smallest document; what it keeps goes to buckets by gram hash.
2. A bucket sees all stretches of a gram.  An equal stretch in a smaller
   document settles an occurrence: ``whole``, every window of it is a repeat.
   Where a gram has several different stretches that agree on one side of the
   gram, the smallest document of each is ``open``: its windows may or may not
   occur in the others.
3. The marks go back to their documents by id, and the open stretches, with
   their elements, go to shards by gram.  An index of the caller's choice finds
   the repeats inside a shard.
4. All covered ranges go back to their documents by id.

The documents meet the marks and the ranges in the same arrangement by id, in one
plan: Spark shuffles the texts once and reads that exchange twice.

Hot passages are pre-aggregated in step 1 (a task sends an equal stretch once)
and frequent k-grams are ranked last when anchors are picked, so a passage in
a third of all documents has its anchors at its rare places.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadworks.llm.anchors import Anchors, Frequent, Ranges, anchors
from loadworks.llm.columns import mix, slices, utf8

SAMPLE_DOCS = 2000         # documents of the frequent k-gram estimate, about
FREQUENT_SHARE = 0.0025    # share of those documents that makes a k-gram frequent
FREQUENT_MOST = 100_000    # k-grams treated as frequent, at most (the most frequent)
BUCKET_BYTES = 8 << 20     # text of a bucket of anchors
SHARD_BYTES = 8 << 20      # text of a shard of open stretches
FLUSH = 1_500_000          # anchors that a task holds before it sends them
_MARK = np.dtype([("gram", "<u8"), ("stretch", "<u4")])  # gram: 40 bits, then the open bit


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): key tells rows of one id with different texts apart."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"),
                       text.alias("text"))


def placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs``, its columns renamed c0, c1, ..., with id, key and ``at``: by this one value a row is
    shuffled and joined (rows without an id are dealt out by their text).

    Both joins with the documents take exactly these columns and rows, so that they share an
    exchange; what a join does not want is left out behind it, inside the task.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    own, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    keyed = docs.toDF(*names).select(*names, F.col(own).cast("long").alias("id"), F.xxhash64(text).alias("key"))
    return keyed.select(*names, "id", "key", F.coalesce("id", "key").alias("at"))


def frequent_grams(rows: DataFrame, n_rows: int, elements: Callable, k: int) -> Frequent:
    """k-grams that are frequent in a sample of about SAMPLE_DOCS documents."""
    share = min(1.0, SAMPLE_DOCS / max(1, n_rows))
    least = max(4, int(FREQUENT_SHARE * share * n_rows))

    def task(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            found = []
            for i, j in slices(offsets):
                values, bounds = elements(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                found += [np.unique(Ranges(values[a:b]).grams(k)) for a, b in zip(bounds[:-1], bounds[1:])]
            grams, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64),
                                      return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))],
                                             names=["gram", "n"])

    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text")
    counted = (sample.mapInArrow(task, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(FREQUENT_MOST).select("gram"))
    return Frequent(counted.toArrow()["gram"].to_numpy().astype(np.int64).view(np.uint64))


def _found(data, offsets, i, j, elements, window, k, frequent) -> tuple[np.ndarray, np.ndarray, Anchors]:
    """Elements, bounds and anchors of rows i to j, with grams cut to 40 bits and stretches to 32."""
    values, bounds = elements(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
    found = anchors(values, bounds, window, k, frequent)
    return values, bounds, found._replace(gram=found.gram >> np.uint64(24),
                                          stretch=(found.stretch >> np.uint64(32)).astype(np.uint32))


def _groups(*keys) -> np.ndarray:
    """Flags the first of each run of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _pack(gram, stretch, left, right, ids) -> bytes:
    base = int(ids.min())
    wide = int(ids.max()) - base >= 1 << 32
    head = np.array([base, wide, len(ids)], np.int64).tobytes()
    return (head + (gram & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
            + (gram >> np.uint64(32)).astype(np.uint8).tobytes() + stretch.astype("<u4").tobytes()
            + left.tobytes() + right.tobytes() + (ids if wide else (ids - base).astype("<u4")).tobytes())


def _unpack(blob: bytes):
    base, wide, n = np.frombuffer(blob, np.int64, 3)
    n, at = int(n), 24
    gram = np.frombuffer(blob, "<u4", n, at).astype(np.uint64)
    gram |= np.frombuffer(blob, np.uint8, n, at + 4 * n).astype(np.uint64) << np.uint64(32)
    stretch = np.frombuffer(blob, "<u4", n, at + 5 * n)
    left = np.frombuffer(blob, "<u2", n, at + 9 * n)
    right = np.frombuffer(blob, "<u2", n, at + 11 * n)
    ids = np.frombuffer(blob, np.int64 if wide else np.uint32, n, at + 13 * n).astype(np.int64)
    return gram, stretch, left, right, ids if wide else ids + base


def _marks(ids, gram, stretch, is_open):
    """(id, marks) of each document."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    marks = np.empty(len(ids), _MARK)
    marks["gram"] = gram[order] << np.uint64(1) | is_open[order].astype(np.uint64)
    marks["stretch"] = stretch[order]
    heads = np.flatnonzero(_groups(ids)) if len(ids) else np.zeros(0, np.int64)
    tails = np.append(heads[1:], len(ids))
    return pa.array(ids[heads], pa.int64()), pa.array([marks[a:b].tobytes() for a, b in zip(heads, tails)],
                                                      pa.binary())


def _side(hashes: np.ndarray) -> np.ndarray:
    """16 bits of a side hash; 0 stays for the end of a text alone."""
    return np.where(hashes == 0, 0, (hashes >> np.uint64(40)) | np.uint64(1)).astype("<u2")


def _sketch_task(elements, window, k, frequent, buckets):
    """Of equal stretches that a task holds the smallest document goes to a bucket; the others are settled."""
    def send(parts):
        gram, stretch, left, right, doc = map(np.concatenate, parts)
        order = np.lexsort((doc, stretch, gram))
        gram, stretch, doc = gram[order], stretch[order], doc[order]
        first = _groups(gram, stretch)
        settled = (doc > doc[first][np.cumsum(first) - 1]) & _groups(gram, stretch, doc)
        names, marks = _marks(doc[settled], gram[settled], stretch[settled], np.zeros(settled.sum(), bool))
        yield _sketch_batch(np.ones(len(names), bool), names, marks)
        pick = order[first]
        gram, stretch, doc, left, right = gram[first], stretch[first], doc[first], left[pick], right[pick]
        bucket = (gram % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((doc, bucket))
        columns = [c[order] for c in (gram, stretch, left, right, doc)]
        heads = np.flatnonzero(_groups(bucket[order]))
        blobs = [_pack(*[c[a:b] for c in columns]) for a, b in zip(heads, np.append(heads[1:], len(bucket)))]
        yield _sketch_batch(np.zeros(len(blobs), bool), pa.array(bucket[order][heads]), pa.array(blobs, pa.binary()))

    def task(batches):
        parts, held = [[], [], [], [], []], 0
        for batch in batches:
            ids, (data, offsets) = batch.column(0).to_numpy(), utf8(batch.column(1))
            for i, j in slices(offsets):
                _, _, f = _found(data, offsets, i, j, elements, window, k, frequent)
                for col, x in zip(parts, (f.gram, f.stretch, _side(f.left), _side(f.right), ids[i + f.text])):
                    col.append(x)
                held += len(f.text)
                if held >= FLUSH:
                    yield from send(parts)
                    parts, held = [[], [], [], [], []], 0
        if held:
            yield from send(parts)

    return task


def _sketch_batch(settled, key, blob):
    return pa.RecordBatch.from_arrays([pa.array(settled), key, blob], names=["settled", "key", "blob"])


def _agreeing(gram, side, stretch) -> np.ndarray:
    """Flags stretches of which a different one has the same gram and side."""
    order = np.lexsort((stretch, side, gram))
    group = _groups(gram[order], side[order])
    different = np.add.reduceat(_groups(gram[order], side[order], stretch[order]).astype(np.int64),
                                np.flatnonzero(group))
    out = np.zeros(len(gram), bool)
    out[order] = (different[np.cumsum(group) - 1] > 1) & (side[order] > 0)
    return out


def _bucket_task(group: pa.Table) -> pa.Table:
    """Marks of the documents of a bucket; marks that are settled already pass through."""
    if group["settled"][0].as_py():
        return pa.table({"id": group["key"], "marks": group["blob"]})
    gram, stretch, left, right, doc = map(np.concatenate, zip(*[_unpack(b.as_py()) for b in group["blob"]]))
    order = np.lexsort((doc, stretch, gram))
    gram, stretch, doc = gram[order], stretch[order], doc[order]
    first = _groups(gram, stretch)
    whole = (doc > doc[first][np.cumsum(first) - 1]) & _groups(gram, stretch, doc)
    pick = order[first]
    is_open = np.zeros(len(gram), bool)
    is_open[first] = (_agreeing(gram[first], left[pick], stretch[first])
                      | _agreeing(gram[first], right[pick], stretch[first]))
    pick = whole | is_open
    ids, marks = _marks(doc[pick], gram[pick], stretch[pick], is_open[pick])
    return pa.table({"id": ids, "marks": marks})


def runs(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sorted disjoint ranges that cover the given ones, as rows (start, end)."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    heads = np.flatnonzero(new)
    return np.stack([start[heads], end[np.append(heads[1:], len(start)) - 1]], axis=1)


_SPREAD = "settled boolean, shard long, id long, key long, at long, body binary"


def _spread_task(elements, window, k, frequent, shards, in_text, text_name):
    """Covered ranges of the settled anchors, and the open stretches for the shards."""
    def task(batches):
        for batch in batches:
            wanted = pc.and_(pc.is_valid(batch["id"]), pc.is_valid(batch[text_name]))
            if not in_text:
                wanted = pc.and_(wanted, pc.is_valid(batch["marks"]))
            batch = batch.select(["id", "key", text_name, "marks"]).filter(wanted)
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = utf8(batch.column(2))
            dealt = mix(ids.view(np.uint64)) % np.uint64(shards)
            out = [[], [], [], [], [], []]
            for i, j in slices(offsets):
                values, bounds, found = _found(data, offsets, i, j, elements, window, k, frequent)
                gram, stretch, start, end = found.gram, found.stretch, found.start, found.end
                anchor_bounds = np.searchsorted(found.text, np.arange(j - i + 1))
                for r in range(j - i):
                    a, b = anchor_bounds[r], anchor_bounds[r + 1]
                    if a == b:
                        continue
                    g, s = gram[a:b], stretch[a:b]
                    seen = np.zeros(b - a, bool)
                    if in_text:  # an equal stretch earlier in the same text settles one too
                        order = np.lexsort((start[a:b], s, g))
                        seen[order] = ~_groups(g[order], s[order])
                    marks = np.frombuffer(b"".join(batch.column(3)[i + r].as_py() or []), _MARK)
                    if not len(marks) and not in_text:
                        continue
                    code = (g << np.uint64(16)) ^ s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    want = ((marks["gram"] >> np.uint64(1)) << np.uint64(16)) \
                        ^ marks["stretch"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    opened = (marks["gram"] & np.uint64(1)).astype(bool)
                    whole = np.isin(code, want[~opened]) | seen
                    left = np.isin(code, want[opened]) & ~whole
                    ranges = runs(start[a:b][whole] - bounds[r], end[a:b][whole] - bounds[r])
                    if len(ranges):
                        row = (True, int(dealt[i + r]), ids[i + r], keys[i + r], None, ranges.tobytes())
                        for col, x in zip(out, row):
                            col.append(x)
                    for n in np.flatnonzero(left) + a:
                        row = (False, int(gram[n] % np.uint64(shards)), ids[i + r], keys[i + r],
                               int(start[n] - bounds[r]), values[start[n]:end[n]].tobytes())
                        for col, x in zip(out, row):
                            col.append(x)
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=["settled", "shard", "id", "key", "at", "body"])

    return task


def _ranges_task(shard_task: Callable):
    """Covered ranges of a shard; ranges that are settled already pass through."""
    def task(group: pa.Table) -> pa.Table:
        if group["settled"][0].as_py():
            return group.select(["id", "key", "body"])
        return shard_task(group.select(["id", "key", "at", "body"]))

    return task


def covered(docs: DataFrame, id_col: str, text_col: str, elements: Callable, window: int, k: int,
            shard_task: Callable, in_text: bool) -> DataFrame:
    """(id, ranges) of the ids with repeats: ranges are pairs of a row's key and a binary blob of
    (start, end) pairs of its elements that repeats cover.  Rows with a null id or text have none.

    ``elements(data, offsets)`` turns texts into element arrays; ``shard_task``
    maps an Arrow table (id, key, at, body) of a shard to (id, key, body) with
    covered ranges; ``in_text`` lets repeats inside one text count.
    """
    rows = _rows(docs, id_col, text_col)
    full = rows.where("id is not null and text is not null")
    facts = full.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    n_rows, n_bytes = facts[0], facts[1] or 0
    buckets = max(1, -(-n_bytes // BUCKET_BYTES))
    shards = max(1, -(-n_bytes // SHARD_BYTES))
    frequent = frequent_grams(full, n_rows, elements, k)
    sketches = full.select("id", "text").mapInArrow(
        _sketch_task(elements, window, k, frequent, buckets), "settled boolean, key long, blob binary")
    sketches = sketches.withColumn("bucket", F.when(F.col("settled"), F.pmod(F.xxhash64("key"), F.lit(buckets)))
                                   .otherwise(F.col("key")))
    marks = (sketches.groupBy("settled", "bucket").applyInArrow(_bucket_task, "id long, marks binary")
             .groupBy(F.col("id").alias("of")).agg(F.collect_list("marks").alias("marks")))
    # a left join: an inner one would filter the documents before their exchange, which is shared
    spread = placed(docs, id_col, text_col).join(marks, F.col("at") == F.col("of"), "left").drop("of").mapInArrow(
        _spread_task(elements, window, k, frequent, shards, in_text, f"c{docs.columns.index(text_col)}"), _SPREAD)
    return (spread.groupBy("settled", "shard").applyInArrow(_ranges_task(shard_task), "id long, key long, body binary")
            .groupBy(F.col("id").alias("of")).agg(F.collect_list(F.struct("key", "body")).alias("ranges")))


def with_ranges(docs: DataFrame, ranges: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs``, its columns renamed c0, c1, ..., with each row's ranges (null: none)."""
    rows = placed(docs, id_col, text_col).join(ranges, F.col("at") == F.col("of"), "left")
    own = F.transform(F.filter("ranges", lambda x: x["key"] == F.col("key")), lambda x: x["body"])
    return rows.select(*[f"c{i}" for i in range(len(docs.columns))],
                       F.when(F.col("id").isNotNull(), own).alias("ranges"))
