"""Approximate nearest neighbours with an inverted multi-index.

Each vector is cut into two halves that are quantised separately, so K + K
centroids make K * K cells.  A query walks the pairs of centroids in order of
summed squared distance, with a heap, until the cells it has passed hold
enough vectors; those are ranked by exact Euclidean distance.

Equal vectors are indexed once, with their smallest ids: a copy group of any
size neither fills a cell nor a task.  Rows are dealt by first-half cluster,
large clusters over several blocks, and a cluster's queries over parts, so a
task holds at most about BLOCK vectors and ASKS queries.

Defined results: vectors that are null, zero, hold null or non-finite
components, or differ in length from the index take no part, as query or as
candidate; ties go to the smaller id; queries with fewer candidates get them
all; repeated ids are separate rows of the same id, and a query's own id is
never its neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadworks.session import scratch_path

SAMPLE = 20_000      # vectors that the centroids are fitted on
CELL_ROWS = 4        # mean vectors of a cell that K aims at
MAX_K = 512
ROUNDS = 8           # of the centroid fit
CANDIDATES = 0.5    # share of the vectors that a query ranks ...
LEAST = 4000         # ... and their least number
BLOCK = 4096         # vectors of a block
ASKS = 8192          # queries that meet a block in one group


def usable(vector: Column) -> Column:
    """Is the vector free of nulls and non-finite components, and not zero?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def fit_centroids(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from evenly spaced distinct rows; empty clusters keep their centroid."""
    rows = np.unique(rows, axis=0)
    rows = rows[np.random.default_rng(7).permutation(len(rows))]
    centroids = rows[:k].copy()
    for _ in range(rounds):
        nearest = (np.square(centroids).sum(1) - 2 * rows @ centroids.T).argmin(1)
        counts = np.bincount(nearest, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, rows)
        centroids[counts > 0] = total[counts > 0] / counts[counts > 0, None]
    return centroids


def squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum(0, np.square(rows).sum(1)[:, None] + np.square(centroids).sum(1) - 2 * rows @ centroids.T)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells in order of summed distance until they hold ``enough`` vectors."""
    a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
    heap, seen, out, held = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = (int(a[i]), int(b[j]))
        if sizes[cell]:
            out.append(cell)
            held += sizes[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return out


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            neighbours: int = 10, candidates: float = CANDIDATES, least: int = LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``neighbours`` nearest rows of each query row.

    ``queries`` is a condition on the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    more = neighbours + 1  # a query's own row may be among them
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asks")).where(usable(F.col("v")))
    dims = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, half = dims["dim"], max(1, dims["dim"] // 2)
    rows = rows.where(F.size("v") == dim).withColumn("key", F.xxhash64("v"))
    # the smallest ids of each distinct vector: first within salted parts, then over them
    parts = Window.partitionBy("key", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    whole = Window.partitionBy("key").orderBy("vec_id")
    members = (rows.select("key", "vec_id", "v").withColumn("n", F.dense_rank().over(parts))
               .where(F.col("n") <= more).withColumn("n", F.dense_rank().over(whole))
               .where(F.col("n") <= more).dropDuplicates(["key", "vec_id"]))
    path = scratch_path(spark, "ann-members")
    members.write.parquet(path)
    members = spark.read.parquet(path)
    distinct = members.where("n = 1").select("key", "v", F.col("vec_id").alias("low"))
    total = distinct.count()
    k = int(min(MAX_K, max(1, np.ceil(np.sqrt(total / CELL_ROWS)))))
    share = min(1.0, SAMPLE / total)
    sample = distinct.where(F.pmod("key", F.lit(1 << 20)) < int(np.ceil(share * (1 << 20)))).select("v")
    sample = _matrix(sample.toArrow()["v"].combine_chunks())
    if not len(sample):
        sample = _matrix(distinct.select("v").limit(k).toArrow()["v"].combine_chunks())
    model = (fit_centroids(sample[:, :half], k), fit_centroids(sample[:, half:], k)
             if dim > half else np.zeros((1, 0)))
    shared = spark.sparkContext.broadcast(model)

    def assign(batches):
        one, two = shared.value
        for batch in batches:
            x = _matrix(batch.column(1))
            i = squared(x[:, :half], one).argmin(1) if len(x) else np.zeros(0, int)
            j = squared(x[:, half:], two).argmin(1) if len(x) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32())],
                names=["key", "v", "low", "i", "j"])

    path = scratch_path(spark, "ann-index")
    distinct.mapInArrow(assign, "key long, v array<double>, low long, i int, j int").write.parquet(path)
    index = spark.read.parquet(path)
    sizes = np.zeros((len(model[0]), len(model[1])), np.int64)  # K * K numbers, bounded by MAX_K
    for r in index.groupBy("i", "j").count().collect():
        sizes[r["i"], r["j"]] = r["count"]
    blocks = np.maximum(1, -(-sizes.sum(1) // BLOCK))
    enough = max(least, int(np.ceil(candidates * total)))
    walked = spark.sparkContext.broadcast((sizes, enough))

    def route(batches):
        one, two = shared.value
        sizes, enough = walked.value
        for batch in batches:
            x = _matrix(batch.column(1))
            out = [[], [], [], []]
            if len(x):
                first, second = squared(x[:, :half], one), squared(x[:, half:], two)
            for q in range(len(x)):
                cells: dict[int, list[int]] = {}
                for i, j in walk(first[q], second[q], sizes, enough):
                    cells.setdefault(i, []).append(j)
                for i, js in cells.items():
                    for col, value in zip(out, (batch.column(0)[q].as_py(), x[q], i, js)):
                        col.append(value)
            kinds = [pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=["key", "v", "i", "js"])

    asked = rows.where("asks").select("key").distinct()
    path = scratch_path(spark, "ann-routed")
    (index.join(asked, "key", "left_semi").select("key", "v")
     .mapInArrow(route, "key long, v array<double>, i int, js array<int>").write.parquet(path))
    routed = spark.read.parquet(path)
    # a group holds one of a cluster's blocks and one of the parts that its queries are dealt to
    parts = np.ones(len(blocks), np.int64)
    for r in routed.groupBy("i").count().collect():  # at most MAX_K rows
        parts[r["i"]] = -(-r["count"] // ASKS)

    def of(numbers: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), F.col("i") + 1)

    def dealt(number: Column) -> Column:
        return F.pmod(F.xxhash64("key"), number).cast("int")

    def each(number: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), number.cast("int") - 1))

    routed = routed.withColumn("part", dealt(of(parts))).withColumn("block", each(of(blocks)))
    held = index.withColumn("block", dealt(of(blocks))).withColumn("part", each(of(parts)))

    def rank(asks: pa.Table, rows: pa.Table) -> pa.Table:
        keys, out = [], [[], []]
        if len(asks) and len(rows):
            rows = rows.sort_by("j")
            x, j = _matrix(rows["v"].combine_chunks()), rows["j"].to_numpy()
            low, near = rows["low"].to_numpy(), rows["key"].to_numpy()
            q = _matrix(asks["v"].combine_chunks())
            for n, js in enumerate(asks["js"].to_pylist()):
                js = np.array(js)
                spans = [np.arange(a, b) for a, b in zip(np.searchsorted(j, js), np.searchsorted(j, js, "right"))]
                at = np.concatenate(spans)
                distance = np.sqrt(np.square(x[at] - q[n]).sum(1))
                best = np.lexsort((low[at], distance))[:more]
                keys += [asks["key"][n].as_py()] * len(best)
                out[0].append(near[at[best]])
                out[1].append(distance[best])
        flat = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table({"asking": pa.array(keys, pa.int64()), "key": pa.array(flat[0].astype(np.int64)),
                         "score": pa.array(flat[1], pa.float64())})

    cell = ["i", "block", "part"]
    ranked = (routed.groupBy(*cell).cogroup(held.groupBy(*cell))
              .applyInArrow(rank, "asking long, key long, score double"))
    # the best distinct vectors of a query, then their ids, then the best ids
    close = ranked.join(members.where("n = 1").select("key", F.col("vec_id").alias("low")), "key")
    order = Window.partitionBy("asking").orderBy("score", "low")
    close = close.withColumn("n", F.row_number().over(order)).where(F.col("n") <= more).drop("n", "low")
    ids = close.join(members.select("key", "vec_id"), "key")
    order = Window.partitionBy("asking").orderBy("score", "vec_id")
    ids = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= more).drop("n", "key")
    found = (rows.where("asks").select(F.col("vec_id").alias("query_id"), F.col("key").alias("asking")).distinct()
             .join(ids, "asking").where("vec_id <> query_id"))
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= neighbours)
            .select("query_id", "rank", "vec_id", "score"))
