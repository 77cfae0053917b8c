"""Best-match of tables by column overlap and of names by token similarity.

Inputs are token sets as rows: ``(id, token)``.  A naive token equi-join
emits every pair of sets sharing *any* token, which is quadratic for common
tokens.  Instead an exact two-phase prefix filter is used:

1. Tokens of each left set are ranked rarest first (by how many right sets
   hold them).  Candidates from the rarest token alone give a first best
   score ``b1`` — a lower bound of the true best.
2. Any right set scoring at least ``b1`` must share a token among the first
   ``m - o + 1`` ranked tokens, where ``m`` counts the left tokens present on
   the right and ``o`` is the overlap that score ``b1`` requires.  Candidates
   from that prefix are scored exactly; the best of them is the best overall.

Common tokens sit at the end of the ranking, so they are only used for sets
without a good rare-token match.  A candidate is dropped before it is scored
if its size, or what follows the shared token in both sets, cannot give the
overlap that the bound asks for (both sets are in the same order, so the row of
their first shared token passes whenever the pair does).  Posting lists are dealt to
salted parts of at most ``PART`` sets, so a common token is not one task.  Sets are kept
as one array each and a pair is scored once, from both arrays.  Nothing is
capped: the result is exact, ties are broken by name.  Zero overlap never wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = 4096  # sets of a salted part of a posting list, about


def tokens_of_names(names: DataFrame, id_col: str, name_col: str | None = None) -> DataFrame:
    """``(id, token)`` from names split on ``_`` and blanks, lower-cased."""
    name = F.col(name_col or id_col)
    toks = F.split(F.trim(F.regexp_replace(F.lower(name), "[_\\s]+", " ")), " ")
    return names.select(F.col(id_col).alias("id"), F.explode(toks).alias("token")) \
        .filter(F.col("token") != "").distinct()


def _collapsed(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One set of each group of equal sets, and ``(lid, name)`` from it to all their names.

    Equal sets have equal size and equal sums of two 64-bit token hashes; the
    set kept is the one of the smallest name.
    """
    tokens = tokens.select("id", "token").distinct()
    wide = "decimal(38,0)"
    face = tokens.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("token").cast(wide)).alias("a"),
        F.sum(F.xxhash64(F.lit("second"), "token").cast(wide)).alias("b"))
    first = face.groupBy("n", "a", "b").agg(F.min("id").alias("lid"))
    names = face.join(first, ["n", "a", "b"]).select("lid", F.col("id").alias("name"))
    kept = tokens.join(first.select(F.col("lid").alias("id")), "id", "left_semi")
    return kept, names


def _sets(tokens: DataFrame, df: DataFrame, name: str) -> DataFrame:
    """``(name, toks, n)``: each set as one array, rarest token first; tokens that the right side
    does not hold come last and count for the size only."""
    ranked = tokens.join(df, "token", "left").select(
        "id", F.struct(F.coalesce("df", F.lit(1 << 62)).alias("df"), "token").alias("x"))
    return ranked.groupBy(F.col("id").alias(name)).agg(F.array_sort(F.collect_list("x")).alias("x")) \
        .select(name, F.col("x.token").alias("toks"), F.size("x").alias("n"),
                F.size(F.filter("x", lambda e: e["df"] < 1 << 62)).alias("m"))


def best_match(left: DataFrame, right: DataFrame, measure: str = "containment") -> DataFrame:
    """Best right set for each left set: ``(lid, rid, overlap, score)``.

    ``measure``: ``containment`` = overlap / |left| (column overlap of a wanted
    table), ``jaccard`` = overlap / |left ∪ right| (name similarity).  Score is
    in percent.  Left sets without any overlapping right set are absent.
    """
    left, left_names = _collapsed(left)
    right, _ = _collapsed(right)  # of equal sets the first name would win anyway
    df = right.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    lsets, rsets = _sets(left, df, "lid"), _sets(right, df, "rid")
    # posting lists, each dealt to salted parts of bounded length
    postings = rsets.select("rid", F.col("n").alias("nr"), F.posexplode("toks").alias("rpos", "token")) \
        .join(df.select("token", F.ceil(F.col("df") / PART).alias("parts")), "token") \
        .withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("parts")))
    parts = df.select("token", F.ceil(F.col("df") / PART).alias("parts"))

    def candidates(probes: DataFrame) -> DataFrame:
        """Probes ``(lid, nl, need, lpos, token, ...)`` with the right sets that hold the token and can still
        reach ``need``: by their sizes, and by what is left of both sets behind the token."""
        dealt = probes.join(parts, "token").withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        met = dealt.join(postings.drop("parts"), ["token", "salt"])
        reach = F.lit(1) + F.least(F.col("nl") - F.col("lpos") - 1, F.col("nr") - F.col("rpos") - 1)
        return met.filter(reach >= _needed(F.col("need"), F.col("nr"))).select("lid", "rid").distinct()

    def _needed(score: Column, nr: Column) -> Column:
        """Overlap that a pair needs to score at least ``score``."""
        if measure == "jaccard":
            return score / (1 + score) * (F.col("nl") + nr) - 1e-9
        return score * F.greatest(F.col("nl"), F.lit(1)) - 1e-9

    def scored(pairs: DataFrame) -> DataFrame:
        o = F.size(F.array_intersect("toks", "rtoks"))
        met = pairs.join(lsets.select("lid", "toks", F.col("n").alias("nl")), "lid") \
            .join(rsets.select("rid", F.col("toks").alias("rtoks"), F.col("n").alias("nr")), "rid") \
            .select("lid", "rid", "nl", "nr", o.alias("o"))
        val = F.col("o") / (F.col("nl") + F.col("nr") - F.col("o")) if measure == "jaccard" \
            else F.col("o") / F.greatest(F.col("nl"), F.lit(1))
        return met.withColumn("s", val)

    some = lsets.filter("m > 0").select("lid", F.col("n").alias("nl"), "m", "toks")
    # phase 1: the rarest token of each left set gives a score that the best one reaches at least
    first = some.select("lid", "nl", F.lit(0.0).alias("need"), F.lit(0).alias("lpos"), F.col("toks")[0].alias("token"))
    b1 = scored(candidates(first)).groupBy("lid").agg(F.max("s").alias("need"))
    # phase 2: a set that scores as much shares a token of the prefix
    min_o = F.greatest(F.ceil(F.col("need") * F.greatest(F.col("nl"), F.lit(1)) - F.lit(1e-9)), F.lit(1))
    probes = some.join(b1, "lid").select(
        "lid", "nl", "need", F.posexplode(F.slice("toks", F.lit(1), F.greatest(F.col("m") - min_o + 1, F.lit(1)).cast("int")))
        .alias("lpos", "token"))
    best = scored(candidates(probes)).groupBy("lid").agg(
        F.min(F.struct((-F.col("s")).alias("ns"), F.col("rid").alias("rid"),
                       F.col("o").alias("o"), F.col("s").alias("s"))).alias("b"))
    best = best.select("lid", F.col("b.rid").alias("rid"), F.col("b.o").cast("long").alias("overlap"),
                       (F.col("b.s") * 100).alias("score"))
    return best.join(left_names, "lid").select(F.col("name").alias("lid"), "rid", "overlap", "score")


def _score_out(c: Column) -> Column:
    return F.round(c, 2).cast("decimal(7,2)")


def _tables_by_columns(wanted: DataFrame, have: DataFrame) -> DataFrame:
    w = wanted.select(F.col("table_name").alias("id"), F.lower("column_name").alias("token"))
    h = have.select(F.col("table_name").alias("id"), F.lower("column_name").alias("token"))
    return best_match(w, h, "containment")


def match_tables(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Best table of ``have(table_name, column_name)`` for each wanted table
    by column overlap ``|W ∩ H| / |W| * 100``; names are case-insensitive."""
    b = _tables_by_columns(wanted, have)
    names = wanted.select(F.col("table_name").alias("lid")).distinct()
    return names.join(b, "lid", "left").select(
        F.col("lid").alias("wanted"), F.col("rid").alias("best_match"),
        F.coalesce("overlap", F.lit(0)).alias("overlap"),
        _score_out(F.coalesce("score", F.lit(0.0))).alias("score"))


def match_renamed(renames: DataFrame, have: DataFrame) -> DataFrame:
    """Best table of ``have(table_name, column_name)`` for each wanted table by the names its columns are
    given: ``|A ∩ T| / max(|A|, 1)`` with A the distinct targets of ``renames(table_name, column_name,
    target)``, case-insensitive; columns without a target do not count.  Wanted tables without
    targets, or without a match, are listed with score 0."""
    given = renames.filter("target IS NOT NULL AND target <> ''").select("table_name", F.col("target").alias("column_name"))
    b = _tables_by_columns(given, have)
    sizes = given.groupBy("table_name").agg(F.countDistinct(F.lower("column_name")).alias("targets"))
    names = renames.select("table_name").distinct().join(sizes, "table_name", "left")
    return names.join(b.withColumnRenamed("lid", "table_name"), "table_name", "left").select(
        F.col("table_name").alias("wanted"), F.col("rid").alias("best_match"),
        F.coalesce("targets", F.lit(0)).cast("long").alias("targets"), F.coalesce("overlap", F.lit(0)).alias("overlap"),
        _score_out(F.coalesce("score", F.lit(0.0))).alias("score"))


def match_names(wanted: DataFrame, have: DataFrame, name_col: str = "name") -> DataFrame:
    """Most similar name (Jaccard of ``_``/blank tokens × 100) per wanted name."""
    w = tokens_of_names(wanted, name_col)
    h = tokens_of_names(have, name_col)
    b = best_match(w, h, "jaccard")
    names = wanted.select(F.col(name_col).alias("lid")).distinct()
    return names.join(b, "lid", "left").select(
        F.col("lid").alias("wanted"), F.col("rid").alias("best_match"),
        _score_out(F.coalesce("score", F.lit(0.0))).alias("score"))


def resolve_tables(wanted: DataFrame, have_tables: DataFrame, have_cols: DataFrame,
                   aliases: DataFrame | None = None) -> DataFrame:
    """Fallback chain per wanted table.

    An alias whose target table exists comes first (score 100; of several the
    first name).  Then candidates with columns score by column overlap,
    candidates without columns by name similarity; the best positive score
    wins, compared unrounded (ties by name).  With no positive score, the
    widest candidate table is used.

    wanted: ``(table_name, column_name)``; have_tables: ``(table_name)``;
    have_cols: ``(table_name, column_name)``; aliases: ``(table_name, target)``.
    """
    pool = _tables_by_columns(wanted, have_cols).select(
        F.col("lid").alias("wanted"), F.col("rid").alias("best_match"), F.col("score").alias("s"),
        F.lit("columns").alias("how"))
    colless = have_tables.join(have_cols.select("table_name").distinct(), "table_name", "left_anti")
    wnames = wanted.select(F.col("table_name").alias("name")).distinct()
    by_name = best_match(tokens_of_names(wnames, "name"),
                         tokens_of_names(colless.select(F.col("table_name").alias("name")), "name"), "jaccard")
    pool = pool.unionByName(by_name.select(F.col("lid").alias("wanted"), F.col("rid").alias("best_match"),
                                           F.col("score").alias("s"), F.lit("name").alias("how")))
    if aliases is not None:
        targets = aliases.join(have_tables.select(F.col("table_name").alias("target")), "target", "left_semi")
        pool = pool.unionByName(targets.select(
            F.col("table_name").alias("wanted"), F.col("target").alias("best_match"),
            F.lit(100.0).alias("s"), F.lit("alias").alias("how")))
    best = pool.groupBy("wanted").agg(
        F.min(F.struct((F.col("how") != "alias").alias("later"), (-F.col("s")).alias("ns"), "best_match", "s",
                       "how")).alias("b"))
    widths = have_tables.join(have_cols.groupBy("table_name").agg(F.count(F.lit(1)).alias("w")),
                              "table_name", "left")
    widest = widths.agg(F.min(F.struct((-F.coalesce("w", F.lit(0))).alias("nw"),
                                       F.col("table_name").alias("t"))).alias("x")).select("x.t")
    names = wanted.select(F.col("table_name").alias("wanted")).distinct()
    return names.join(best, "wanted", "left").select(
        "wanted",
        F.coalesce(F.col("b.best_match"), widest.scalar()).alias("resolved"),
        _score_out(F.coalesce(F.col("b.s"), F.lit(0.0))).alias("score"),
        F.when(F.col("b.how").isNotNull(), F.col("b.how")).otherwise(F.lit("widest")).alias("how"))
