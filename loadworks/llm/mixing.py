"""Mixing sources to target weights by the cube method of balanced sampling.

Every source has a target number of words; a document of a source whose target
is r times its size is taken floor(r) times, and once more with probability r's
fraction.  The cube method decides the last part: three undecided documents at
a time, their probabilities are moved along the direction that changes neither
their words nor their number in all, until one of them is 0 or 1.  At most two
documents of a block stay undecided; they meet those of other blocks in the next
round, until at most two of a source are left: the landing takes the outcome
whose words come nearest to the target.

Blocks are dealt by a hash of the document id and hold about ``BLOCK`` documents
of one source, so a source of any size is decided in parallel, and the words and
the number of a source's documents are kept in every block.  Rows that
are equal in id and size are one unit with a count: of n equal rows with
probability p, floor(n p) are taken and one unit keeps the fraction.

Defined results: a null text has 0 words; sources of no words have target 0 and
nothing taken; a NULL source is a source and comes last; an empty table gives no
rows.  The result depends on ids, sizes and sources alone, not on files or tasks.
Texts are read once and never shuffled.  Input columns that are not named are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadworks.llm.components import small, stored
from loadworks.llm.ranking import numbered

BLOCK = 4096
MOST = 3            # a source's target, and what is taken of a document, in sizes
CYCLE = 3           # weights 1, 2, ... CYCLE, repeated over the sources
NEAR = 1e-9         # a probability this near to 0 or 1 has arrived
CHUNK = 1 << 16     # equal rows are given back in chunks of so many


def word_count(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+ without holding them: one letter a word, then no blanks."""
    short = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]++", "x")
    return F.length(F.regexp_replace(short, r"[\x20\x09-\x0D]++", "")).cast("long")


def targets(sizes: DataFrame, most: int = MOST, cycle: int = CYCLE) -> DataFrame:
    """(source, source_size, target, ratio) of every source from (source, source_size).

    The total is shared by weight; a source whose share exceeds ``most`` times
    its size gets that, and the rest is shared again among the others.  Each
    turn is one aggregate over the sources; the driver sees three numbers.
    """
    ranked = numbered(sizes.withColumn("last", F.col("source").isNull().cast("int")), "last", ["source"])
    nulls = ranked.groupBy().agg(F.max(F.when(F.col("last") == 0, F.col("n")))).first()[0] or 0
    at = F.when(F.col("last") == 1, F.lit(nulls)).otherwise(F.col("pos"))
    rows = stored(ranked.select("source", "source_size", (at % cycle + 1).alias("weight")), "sources")
    bound = F.col("source_size") * most
    rest, weights, capped = 0, 1, -1
    full = F.lit(False)
    while True:
        found = rows.agg(F.sum("source_size"), F.sum(F.when(full, bound)), F.sum(F.when(~full, F.col("weight"))),
                         F.count(F.when(full, 1))).first()
        rest, weights = (found[0] or 0) - (found[1] or 0), found[2] or 1
        if found[3] == capped:
            break
        capped = found[3]
        full = F.col("weight") * F.lit(int(rest)).cast("decimal(38,0)") > bound * F.lit(int(weights)).cast("decimal(38,0)")
    target = F.when(full, bound.cast("double")).otherwise(
        F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(weights)))
    ratio = F.when(full, F.lit(float(most))).when(F.col("source_size") == 0, F.lit(0.0)) \
        .otherwise(F.least(target / F.col("source_size"), F.lit(float(most))))
    return stored(rows.select("source", "source_size", target.alias("target"), ratio.alias("ratio")), "targets")


def _direction(s: list[float]) -> tuple[float, float, float]:
    """A move of three probabilities that keeps their sum and their words."""
    u = (s[1] - s[2], s[2] - s[0], s[0] - s[1])
    scale = max(map(abs, u))
    return (1.0, -1.0, 0.0) if scale == 0 else (u[0] / scale, u[1] / scale, u[2] / scale)


def flight(p: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The probabilities after the flight: all but two at most are 0 or 1."""
    p, draws = p.tolist(), iter(rng.random(len(p)).tolist())  # every step decides one at least
    open_at = [k for k, x in enumerate(p) if NEAR < x < 1 - NEAR]
    for k, x in enumerate(p):
        if not NEAR < x < 1 - NEAR:
            p[k] = float(round(x))
    sizes, held, waiting = sizes.tolist(), open_at[:3], iter(open_at[3:])
    while len(held) == 3:
        u = _direction([sizes[k] for k in held])
        up = min((1 - p[k]) / x if x > 0 else -p[k] / x for k, x in zip(held, u) if x)
        down = min(p[k] / x if x > 0 else (p[k] - 1) / x for k, x in zip(held, u) if x)
        step = up if next(draws) * (up + down) < down else -down
        keep = []
        for k, x in zip(held, u):
            p[k] += step * x
            if NEAR < p[k] < 1 - NEAR:
                keep.append(k)
            else:
                p[k] = float(round(p[k]))
        held = keep
        while len(held) < 3 and (k := next(waiting, None)) is not None:
            held.append(k)
    return np.array(p)


def landing(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The outcome of the last undecided units (at most two) whose words come nearest to the expected."""
    left = [k for k, x in enumerate(p) if 0 < x < 1]
    best = None
    for choice in range(1 << len(left)):
        taken = [choice >> i & 1 for i in range(len(left))]
        off = abs(sum((t - p[k]) * sizes[k] for t, k in zip(taken, left)))
        number = abs(sum(t - p[k] for t, k in zip(taken, left)))
        if best is None or (off, number, choice) < best[0]:
            best = ((off, number, choice), taken)
    out = p.copy()
    out[left] = best[1]
    return out


def _decided(units: DataFrame) -> DataFrame:
    """The flight of every (source, block), and the landing of sources that are one block."""
    def fly(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("key", "ascending")])
        seed = table["seed"][0].as_py()
        rng = np.random.Generator(np.random.PCG64(seed & (1 << 63) - 1))
        sizes = table["size"].to_numpy()
        p = flight(table["p"].to_numpy(), sizes, rng)
        if table["blocks"][0].as_py() == 1:
            p = landing(p, sizes)
        return table.set_column(table.column_names.index("p"), "p", pa.array(p))

    seeded = units.withColumn("seed", F.xxhash64(F.lit(42), F.col("source"), F.col("block"), F.col("blocks")))
    return seeded.groupBy("source", "block").applyInArrow(fly, seeded.schema).drop("seed")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        block: int = BLOCK) -> DataFrame:
    """(id, size, source_size, target, taken) of every row."""
    sized = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size")), "sizes")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    units = sized.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    per_source = units.groupBy("source").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    goal = stored(goal.alias("g").join(per_source.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source")))
                  .select("g.*", "blocks"), "goals").withColumnRenamed("source", "goal_source")
    joined = units.join(small(goal), F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    share = (F.col("ratio") - F.floor("ratio")) * F.col("n")
    key = F.xxhash64("id", "size")
    rows = stored(joined.select("id", "source", "size", "n", "source_size", "target", "blocks", key.alias("key"),
                                F.pmod(key, F.col("blocks")).alias("block"), F.floor("ratio").alias("copies"),
                                F.floor(share).alias("sure"), (share - F.floor(share)).alias("p")), "units")
    out, live = rows.where("p = 0"), rows.where("p > 0")
    while True:  # at most two units of a block go on
        flown = stored(_decided(live), "flight")
        out = out.unionByName(flown.where("p = 0 or p = 1"))
        live = flown.where("p > 0 and p < 1")
        if not live.limit(1).count():
            break
        live = live.withColumn("block", F.floor(F.col("block") / (block // 2))) \
            .withColumn("blocks", F.ceil(F.col("blocks") / (block // 2)))
    out = out.select("id", "size", "source_size", "target", "copies", "n",
                     (F.col("sure") + F.col("p").cast("long")).alias("extra"))
    single = out.where("n = 1").withColumn("k", F.lit(0).cast("long"))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK))).alias("c")
    many = out.where("n > 1").select("*", chunk)
    many = many.repartition("id", "size", "c").select(*out.columns, F.explode(F.sequence(
        F.col("c") * CHUNK, F.least((F.col("c") + 1) * CHUNK, F.col("n")) - 1)).alias("k"))
    return single.unionByName(many).select(
        "id", "size", "source_size", "target",
        (F.col("size") * (F.col("copies") + (F.col("k") < F.col("extra")).cast("long"))).alias("taken"))
