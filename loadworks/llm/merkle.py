"""Merkle manifest of a table: a digest a row, a root a group and one over all, and proofs.

Rows of a group, in order, are the leaves of a tree in which every ``FAN``
consecutive nodes become their digest until one is left.  Aligned blocks of
``FAN ** LEVELS`` nodes are reduced where they lie: a level of a block is one
string of digests of fixed width, its parents are the digests of fixed-width
substrings of it, and the siblings of a node are the substrings that flank it
inside its run.  The roots of the blocks are the nodes of the next round; a
group ends in the round in which it is a single block.  The roots of the groups
are the leaves of one more tree of the same kind.

Proofs are put together from the top: every block adds its own segments below
those of its root, so a round joins one row a block.

Defined results: a null field is hashed as ``-``; a lone leaf is its group's
root; a NULL group is a group and comes first; rows of equal order are placed by
their digest; an empty table gives no rows.  Texts are hashed where they are
read; only digests are shuffled.  Input columns that are not named are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadworks.llm.components import stored
from loadworks.llm.ranking import numbered

FAN = 3
LEVELS = 5     # levels of a block: its first string holds 243 digests
WIDTH = 64     # characters of a digest


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its text; ``-`` for NULL."""
    def one(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest(F.concat(*map(one, fields)))


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof (segments left and right of it, bottom up) lead to."""
    return F.aggregate(proof, start, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def siblings(proof: Column) -> Column:
    """All digests of a proof as one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _parents(level: Column) -> Column:
    """The next level of a block: digests of runs of ``FAN`` digests."""
    run = FAN * WIDTH
    last = F.ceil(F.length(level) / run).cast("int") - 1
    return F.array_join(F.transform(F.sequence(F.lit(0), last),
                                    lambda i: digest(F.substring(level, i * run + 1, F.lit(run)))), "")


def _segments(levels: Column, depth: Column, at: Column) -> Column:
    """The flanks of the node at place ``at`` of the first level, and of its ancestors."""
    out = []
    for k in range(LEVELS):
        place = F.floor(at / FAN ** k).cast("int")
        level, inside = F.element_at(levels, k + 1), place % FAN
        left = F.substring(level, (place - inside) * WIDTH + 1, inside * WIDTH)
        right = F.substring(level, place * WIDTH + 1 + WIDTH, (FAN - 1 - inside) * WIDTH)
        out.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*out), F.lit(1), depth)


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and (group, round, top) of every group.

    ``nodes``: group, n (nodes of the group), pos, digest, payload.
    """
    size, rounds, ends = FAN ** LEVELS, [], None
    while True:
        blocks = (nodes.groupBy("group", "n", F.floor(F.col("pos") / size).alias("block"))
                  .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "payload"))).alias("items")))
        need = sum(((F.col("n") > FAN ** k).cast("int") for k in range(1, LEVELS)), (F.col("n") > 1).cast("int"))
        blocks = blocks.withColumn("depth", F.when(F.col("n") > size, LEVELS).otherwise(need)) \
            .withColumn("l0", F.array_join(F.col("items")["digest"], ""))
        for k in range(LEVELS):
            blocks = blocks.withColumn(f"l{k + 1}", F.when(F.col("depth") > k, _parents(F.col(f"l{k}"))))
        levels = [f"l{k}" for k in range(LEVELS + 1)]
        blocks = stored(blocks.select(
            "group", "n", "block", "depth", F.array(*levels[:-1]).alias("levels"),
            F.coalesce(*levels[::-1]).alias("top"),
            F.transform("items", lambda x: F.struct(x["pos"], x["payload"])).alias("items")), "blocks")
        done = blocks.where(F.col("n") <= size).select("group", F.lit(len(rounds)).alias("round"), "top")
        ends = done if ends is None else ends.unionByName(done)
        rounds.append(blocks)
        open_blocks = blocks.where(F.col("n") > size)
        if not open_blocks.limit(1).count():
            return rounds, ends
        nodes = open_blocks.select("group", F.ceil(F.col("n") / size).alias("n"), F.col("block").alias("pos"),
                                   F.col("top").alias("digest"), F.lit(None).cast("string").alias("payload"))


def _descend(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """(group, pos, payload, proof, what else ``ends`` holds) of the nodes of the first round.

    ``ends``: group, round in which it ends, proof of its root, further columns.
    """
    extra = [c for c in ends.columns if c not in ("group", "round", "proof")]
    items = None
    for k, blocks in reversed(list(enumerate(rounds))):
        above = ends.where(F.col("round") == k).select(
            F.col("group").alias("above_group"), F.lit(0).cast("long").alias("at"), "proof", *extra)
        if items is not None:
            above = above.unionByName(items.select(
                F.col("group").alias("above_group"), F.col("pos").alias("at"), "proof", *extra))
        joined = blocks.join(above, F.col("group").eqNullSafe(F.col("above_group")) & (F.col("block") == F.col("at")))
        first = F.col("block") * FAN ** LEVELS
        items = joined.select("group", *extra, F.inline(F.transform("items", lambda x: F.struct(
            x["pos"].alias("pos"), x["payload"].alias("payload"),
            F.concat(_segments(F.col("levels"), F.col("depth"), x["pos"] - first), F.col("proof")).alias("proof")))))
    return items


def manifest(rows: DataFrame, group: str, order: str, leaf_col: str = "leaf") -> DataFrame:
    """(group, order, leaf, ..., subroot, root, proof) of every row.

    ``proof``: array of the strings left and right of the leaf and its ancestors,
    bottom up, through the group's root to the root of all.  Further columns of
    ``rows`` are carried along; they should be short.
    """
    names = rows.columns
    flat = rows.select(F.col(group).alias("group"), F.col(order).alias("order"), F.col(leaf_col).alias("digest"),
                       F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(names)]).alias("payload"))
    nodes = numbered(flat, "group", ["order", "digest"])
    rounds, ends = _grow(nodes.select("group", "n", "pos", "digest", "payload"))
    ends = stored(ends, "subroots")
    tops = numbered(ends.select(F.lit(0).alias("group"), F.col("group").alias("order"), F.col("top").alias("digest"),
                                F.struct(F.col("group").alias("name"), "round", "top").alias("payload")),
                    "group", ["order"])
    upper, roots = _grow(tops.select("group", "n", "pos", "digest", "payload"))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    named = _descend(upper, roots.select("group", "round", empty.alias("proof"), F.col("top").alias("root")))
    named = stored(named.select(F.col("payload.name").alias("group"), F.col("payload.round").alias("round"), "proof",
                                F.col("payload.top").alias("subroot"), "root"), "roots")
    found = _descend(rounds, named)
    return found.select(*[F.col(f"payload.p{i}").alias(c) for i, c in enumerate(names)
                          if c not in ("subroot", "root", "proof")], "subroot", "root", "proof")
