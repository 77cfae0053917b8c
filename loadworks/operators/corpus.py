"""Rule scans over text corpora: issues, classes, statements, references.

A corpus is ``DataFrame(doc_id, content)`` (plus any grouping columns).
Rule catalogues are small and constant, so each rule becomes one literal
``rlike`` inside a single projection over the lines: one pass over the text,
no cross product of documents and rules, no UDF.

Lines are split on ``\\r?\\n`` everywhere; regular expressions must use
syntax shared by Java and RE2 (no look-around, no back-references).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadworks.operators.shaping import qcol

LINE_BREAK = r"\r?\n"


@dataclass(frozen=True)
class Rule:
    """A scan rule.  ``hints``: literal texts of which every match contains at
    least one; a line without any of them skips the regular expression (a
    cheap pre-check that does not change the result)."""

    name: str
    pattern: str
    severity: str = "high"
    description: str = ""
    multiline: bool = False
    hints: tuple[str, ...] = ()


def _matches(text: Column, rule: Rule) -> Column:
    test = text.rlike(rule.pattern)
    if not rule.hints:
        return test
    pre = F.lit(False)
    for h in rule.hints:
        pre = pre | text.contains(h)
    return pre & test


def to_lines(corpus: DataFrame, id_cols: list[str], content: str = "content") -> DataFrame:
    """``(ids..., line_no, line)``: one row per line, 1-based numbers."""
    return corpus.select(*[qcol(c) for c in id_cols],
                         F.posexplode(F.split(qcol(content), LINE_BREAK, -1)).alias("pos", "line")) \
        .select(*[qcol(c) for c in id_cols], (F.col("pos") + 1).alias("line_no"), "line")


def line_count(content: Column) -> Column:
    """Number of lines as ``str.splitlines`` counts them (no final empty line)."""
    parts = F.size(F.split(content, LINE_BREAK, -1))
    return F.when(F.coalesce(content, F.lit("")) == "", F.lit(0)) \
        .otherwise(parts - F.when(content.endswith("\n"), 1).otherwise(0))


def _newlines(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def _issue(rule: Rule, at: Column, before: Column, own: Column) -> Column:
    return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"),
                    F.lit(rule.multiline).alias("whole"), at.cast("long").alias("at"),
                    before.cast("long").alias("before"), own.cast("long").alias("own"))


_ISSUES = ("array<struct<rule:string,severity:string,whole:boolean,at:bigint,before:bigint,"
           "own:bigint>>")


def _line_issues(content: Column, rules: list[Rule]) -> Column:
    """An issue per rule and matching line; ``at`` is the line number."""
    none = F.lit(0)
    found = F.transform(F.split(content, LINE_BREAK, -1), lambda line, i: F.filter(F.array(*[
        F.when(_matches(line, r), _issue(r, i + 1, none, none)) for r in rules]),
        lambda x: x.isNotNull()))
    return F.flatten(found)


def _text_issues(content: Column, rule: Rule) -> Column:
    """An issue per match of a whole-text rule, with the line breaks since the match before
    (``before``) and in the match itself (``own``).

    With parts = split(text, p) and matches = regexp_extract_all(text, p), part i
    is the text between match i - 1 and match i.
    """
    pat = "(?ms)" + rule.pattern
    steps = F.zip_with(F.split(content, pat, -1), F.regexp_extract_all(content, F.lit(pat), 0),
                       lambda part, match: F.struct(part.alias("p"), match.alias("m")))
    steps = F.filter(steps, lambda x: x["m"].isNotNull())
    return F.transform(steps, lambda x, i: _issue(rule, i, _newlines(x["p"]), _newlines(x["m"])))


def _issues(content: Column, rules: list[Rule]) -> Column:
    """All issues of a text, in one expression: the corpus is read once for any number of rules."""
    line_rules = [r for r in rules if not r.multiline]
    parts = [_line_issues(content, line_rules)] if line_rules else []
    parts += [_text_issues(content, r) for r in rules if r.multiline]
    return F.concat(*[F.coalesce(p, F.array().cast(_ISSUES)) for p in parts])


def scan_rules(corpus: DataFrame, rules: list[Rule], id_cols: list[str] | None = None,
               content: str = "content") -> DataFrame:
    """Issues ``(ids..., rule, severity, line_no)``.

    Line rules give at most one issue per rule per line; multiline rules
    search the whole text and give one issue per match, on the line it begins.
    Issues of line rules come straight from the lines; only matches of whole-text
    rules are shuffled, for a running sum over the document's matches (linear in
    their number).  The texts are read once for each of the two kinds that occurs.
    """
    ids = [qcol(c) for c in (id_cols or ["doc_id"])]
    line_rules, text_rules = [r for r in rules if not r.multiline], [r for r in rules if r.multiline]
    none, parts = F.lit(0), []
    if line_rules:
        lines = corpus.select(*ids, F.posexplode(F.split(qcol(content), LINE_BREAK, -1)).alias("__pos", "__line"))
        on_line = F.array(*[F.when(_matches(F.col("__line"), r), _issue(r, F.col("__pos") + 1, none, none)) for r in line_rules])
        found = lines.select(*ids, F.explode(F.filter(on_line, lambda x: x.isNotNull())).alias("__i"))
        parts.append(found.select(*ids, F.col("__i.rule").alias("rule"), F.col("__i.severity").alias("severity"),
                                  F.col("__i.at").alias("line_no")))
    if text_rules:
        # the row's number first: behind the explode every match would get one of its own
        rows = corpus.select(*ids, F.monotonically_increasing_id().alias("__row"), qcol(content).alias("__text"))
        found = F.concat(*[F.coalesce(_text_issues(F.col("__text"), r), F.array().cast(_ISSUES)) for r in text_rules])
        rows = rows.select(*ids, "__row", F.explode(found).alias("__i"))
        w = Window.partitionBy("__row", "__i.rule").orderBy("__i.at")
        line = F.sum(F.col("__i.before") + F.col("__i.own")).over(w) - F.col("__i.own") + 1
        parts.append(rows.select(*ids, F.col("__i.rule").alias("rule"), F.col("__i.severity").alias("severity"),
                                 line.alias("line_no")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


GRAMS = (12, 4)  # letters of the pieces by which a rule table is indexed, the longest first


def _met(lines: DataFrame, rules: DataFrame, gram: int) -> DataFrame:
    """Pairs of a line and a rule whose literal shares a piece of ``gram`` letters with the line's cuts."""
    places = F.sequence(F.lit(1), F.length("literal") - gram + 1)
    index = rules.select("*", F.explode(F.array_distinct(
        F.transform(places, lambda i: F.substring("literal", i, F.lit(gram))))).alias("__gram"))
    # one pass over the line: a substring by position would count its letters from the start each time
    cuts = F.regexp_extract_all("__line", F.lit(f"(?s).{{{gram}}}"), F.lit(0))
    pieces = lines.filter(F.length("__line") >= 2 * gram - 1).select("*", F.explode(F.array_distinct(cuts)).alias("__gram"))
    return pieces.join(index, "__gram")


def scan_rule_table(corpus: DataFrame, rules: DataFrame, id_cols: list[str] | None = None,
                    content: str = "content") -> DataFrame:
    """Issues ``(ids..., rule, severity, line_no)`` of line rules that are rows of a table, however many.

    ``rules``: ``(rule, severity, pattern, literal)``, where every match of ``pattern`` (a regular
    expression; NULL: the literal itself) contains ``literal``.  An inverted index holds all
    pieces of ``gram`` letters of the literals; a line is cut at every ``gram``-th letter only,
    because a literal of ``2 * gram - 1`` letters holds one of these pieces wherever it
    begins.  So a line costs its length over ``gram`` lookups, whatever the number of rules, and only
    pairs that share a piece are compared.  Each rule is indexed by the longest pieces of ``GRAMS``
    that its literal allows; where no rule needs a size, adaptive execution leaves out that pass over
    the lines.  Rules with shorter literals, whose pieces would
    be missed, are compared with every line; a rule without literal is an error.  The planner
    broadcasts the index while it is small; texts are only shuffled beyond that.
    """
    ids = [qcol(c) for c in (id_cols or ["doc_id"])]
    checked = rules.select("rule", "severity", "pattern", F.when(
        F.coalesce(F.length("literal"), F.lit(0)) == 0, F.raise_error(F.lit("a rule without literal")).cast("string"))
        .otherwise(F.col("literal")).alias("literal"))
    lines = corpus.select(*ids, F.monotonically_increasing_id().alias("__row"), qcol(content).alias("__text")) \
        .select(*ids, "__row", F.posexplode(F.split("__text", LINE_BREAK, -1)).alias("__pos", "__line"))
    hit = F.contains(F.col("__line"), F.col("literal")) & (F.col("pattern").isNull() | F.expr("__line RLIKE pattern"))
    out = [*ids, "rule", "severity", (F.col("__pos") + 1).cast("long").alias("line_no")]
    size = F.length("literal")
    met, below = None, None
    for gram in GRAMS:
        fits = size >= 2 * gram - 1 if below is None else (size >= 2 * gram - 1) & (size < below)
        part = _met(lines, checked.filter(fits), gram).filter(hit).select(*out, "__row")
        met, below = part if met is None else met.unionByName(part), 2 * gram - 1
    # compared with every line: a condition that is no equality, as the short rules are few
    rest = lines.join(checked.filter(size < below), hit).select(*out, "__row")
    return met.distinct().unionByName(rest).drop("__row")


def classify_documents(corpus: DataFrame, rules: list[Rule], id_cols: list[str] | None = None,
                       content: str = "content") -> DataFrame:
    """``broken`` when a document has any issue, else ``clean``; with its counts of issues,
    critical and high ones.  No shuffle: the counts are taken where the text is read."""
    ids = [qcol(c) for c in (id_cols or ["doc_id"])]
    found = corpus.select(*ids, F.transform(_issues(qcol(content), rules),
                                            lambda i: i["severity"]).alias("__s"))

    def count(severity: str) -> Column:
        return F.size(F.filter("__s", lambda s: s == severity)).cast("long")
    return found.select(*ids, F.size("__s").cast("long").alias("issues"),
                        count("critical").alias("critical_issues"), count("high").alias("high_issues"),
                        F.when(F.size("__s") > 0, "broken").otherwise("clean").alias("classification"))


def summarise_scan(classified: DataFrame) -> DataFrame:
    """Files, clean, broken, issues, critical and high issue counts of ``classify_documents``."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return classified.agg(F.count(F.lit(1)).alias("files"),
                          F.count_if(F.col("classification") == "clean").alias("clean_files"),
                          F.count_if(F.col("classification") == "broken").alias("broken_files"),
                          total("issues").alias("total_issues"),
                          total("critical_issues").alias("critical_issues"),
                          total("high_issues").alias("high_issues"))


# ------------------------------------------------------------------ groups

@dataclass(frozen=True)
class MarkerRule:
    """``kind``: ``all`` (every marker present), ``any`` (one marker present)
    or ``count_word`` (more than ``n`` documents and ``word`` present, case
    insensitive)."""

    label: str
    kind: str
    markers: tuple[str, ...] = ()
    n: int = 0
    word: str = ""


def classify_by_markers(corpus: DataFrame, group_col: str, rules: list[MarkerRule],
                        default: str, content: str = "content") -> DataFrame:
    """Class of each group of documents; the first matching rule wins.

    Each group reduces to a few booleans and a count with map-side partial
    aggregation, so a huge group never sits in one task.
    """
    aggs, conds = [F.count(F.lit(1)).alias("__n")], []
    for i, r in enumerate(rules):
        if r.kind in ("all", "any"):
            flags = []
            for j, m in enumerate(r.markers):
                name = f"__r{i}_{j}"
                aggs.append(F.bool_or(F.coalesce(qcol(content).contains(m), F.lit(False))).alias(name))
                flags.append(F.col(name))
            cond = flags[0]
            for f in flags[1:]:
                cond = (cond & f) if r.kind == "all" else (cond | f)
        elif r.kind == "count_word":
            name = f"__r{i}_w"
            aggs.append(F.bool_or(F.coalesce(F.upper(qcol(content)).contains(r.word.upper()),
                                             F.lit(False))).alias(name))
            cond = (F.col("__n") > r.n) & F.col(name)
        else:
            raise ValueError(f"unknown marker rule kind {r.kind!r}")
        conds.append((cond, r.label))
    label = F.lit(default)
    for cond, lab in reversed(conds):
        label = F.when(cond, F.lit(lab)).otherwise(label)
    return corpus.groupBy(qcol(group_col)).agg(*aggs).select(qcol(group_col), label.alias("label"))


def flag_short_wrappers(corpus: DataFrame, name_col: str, needle: str, max_lines: int = 20,
                        skip: tuple[str, ...] = (), content: str = "content",
                        id_cols: list[str] | None = None) -> DataFrame:
    """Wrapper scripts to skip: name in ``skip``, or fewer than ``max_lines``
    lines and containing ``needle``."""
    ids = id_cols or ["doc_id"]
    n = line_count(qcol(content))
    by_name = F.coalesce(qcol(name_col).isin(*skip), F.lit(False)) if skip else F.lit(False)
    short = F.coalesce((n < max_lines) & qcol(content).contains(needle), F.lit(False))
    return corpus.select(*[qcol(c) for c in ids], n.alias("lines"),
                         (by_name | short).alias("flagged"),
                         F.when(by_name, "skip_list").when(short, "short_wrapper").alias("reason"))


def token_estimate(corpus: DataFrame, group_cols: list[str], content: str = "content") -> DataFrame:
    """Characters and estimated tokens ``max(1, chars // 4)`` per group
    (characters summed first, then divided)."""
    g = corpus.groupBy(*[qcol(c) for c in group_cols]).agg(
        F.sum(F.length(qcol(content))).cast("long").alias("chars"))
    return g.select(*[qcol(c) for c in group_cols], "chars",
                    F.greatest(F.lit(1), F.floor(F.col("chars") / 4)).cast("long").alias("tokens"))


# ------------------------------------------------------------------ statements

# Statements removed during conversion, and statement classes in
# the order they are tested.
REMOVABLE = {
    "INVALIDATE METADATA": r"(?i)\bINVALIDATE\s+METADATA\b",
    "REFRESH": r"(?i)\bREFRESH\s+\w+",
    "COMPUTE STATS": r"(?i)\bCOMPUTE\s+(?:INCREMENTAL\s+)?STATS\b",
    "SET SYNC_DDL": r"(?i)\bSET\s+SYNC_DDL\b",
}
STATEMENT_CLASSES = [
    ("INSERT", r"(?i)\bINSERT\s+(?:INTO|OVERWRITE)\b"),
    ("DELETE", r"(?i)\bDELETE\s+FROM\b"),
    ("UPDATE", r"(?i)\bUPDATE\s+\w+"),
    ("SELECT", r"(?i)\bSELECT\b"),
    ("MERGE", r"(?i)\bMERGE\s+INTO\b"),
    ("CREATE", r"(?i)\bCREATE\s+"),
]
# Function names that look like ``name.name`` references.
REF_SKIP = ["row_number", "date_trunc", "current_timestamp", "current_date"]
# Infrastructure commands that must not survive a conversion.
LEFTOVER_WORDS = {
    "impala-shell": r"(?i)\bimpala-shell\b",
    "kinit": r"(?i)\bkinit\b",
    "beeline": r"(?i)\bbeeline\b",
    "hdfs dfs": r"(?i)\bhdfs\s+dfs\b",
    "ssh": r"(?i)\bssh\s+",
}


# Where scripts hold their statements: -q arguments and spark.sql calls.
EMBEDDED = [
    r'-q\s+"([^"]+)"',
    r"-q\s+'([^']+)'",
    r'spark\.sql\(\s*f?"{3}([\s\S]+?)"{3}',
    r"spark\.sql\(\s*f?'{3}([\s\S]+?)'{3}",
    r'spark\.sql\(\s*f?"([^"\n]+)"\s*\)',
]


def extract_statements(scripts: DataFrame, id_cols: list[str], content: str = "content") -> DataFrame:
    """``(ids..., stmt_no, sql)``: the statements that whole scripts hold, in ``-q`` arguments
    and in single- or triple-quoted ``spark.sql`` calls.

    Numbered by kind of quoting, then by place; blank statements are left out.
    One pass over the texts, nothing is shuffled.
    """
    found = F.concat(*[F.regexp_extract_all(qcol(content), F.lit(p), 1) for p in EMBEDDED])
    ids = [qcol(c) for c in id_cols]
    return scripts.select(*ids, F.posexplode(found).alias("pos", "sql")) \
        .select(*ids, (F.col("pos") + 1).alias("stmt_no"),
                F.regexp_replace("sql", r"^\s+|\s+$", "").alias("sql")) \
        .filter(F.col("sql") != "")


def removable_left(stmts: DataFrame, id_cols: list[str], sql_col: str = "sql") -> DataFrame:
    """Statements that a conversion should have removed: ``(ids..., kind)``, once per kind."""
    hits = F.filter(F.array(*[F.when(qcol(sql_col).rlike(p), F.lit(k)) for k, p in REMOVABLE.items()]),
                    lambda x: x.isNotNull())
    return stmts.select(*[qcol(c) for c in id_cols], F.explode(hits).alias("kind")).distinct()


def positional_parameters(scripts: DataFrame, id_cols: list[str], content: str = "content") -> DataFrame:
    """Scripts that use positional parameters ($1, ${1}) but declare no widgets: ``(ids..., parameters)``."""
    used = F.array_distinct(F.regexp_extract_all(qcol(content), F.lit(r"\$\{?([1-9])\}?"), 1))
    return scripts.filter(~F.coalesce(qcol(content).contains("dbutils.widgets"), F.lit(False))) \
        .select(*[qcol(c) for c in id_cols], F.array_join(F.array_sort(used), ",").alias("parameters")) \
        .filter(F.col("parameters") != "")


def statement_class(sql: Column) -> Column:
    """Class of one statement; NULL for statements removed by conversion."""
    removable = F.lit(False)
    for p in REMOVABLE.values():
        removable = removable | sql.rlike(p)
    cls = F.lit("OTHER")
    for name, p in reversed(STATEMENT_CLASSES):
        cls = F.when(sql.rlike(p), F.lit(name)).otherwise(cls)
    return F.when(removable, F.lit(None).cast("string")).otherwise(cls)


def classify_statements(stmts: DataFrame, sql_col: str = "sql") -> DataFrame:
    """Adds ``stmt_class``; removable statements are dropped."""
    return stmts.withColumn("stmt_class", statement_class(qcol(sql_col))) \
        .filter(F.col("stmt_class").isNotNull())


def compare_statement_counts(src: DataFrame, out: DataFrame, script_col: str = "script_id",
                             class_col: str = "stmt_class") -> DataFrame:
    """Per script: source DML (INSERT, DELETE, UPDATE) against output DML
    (the same plus MERGE, which replaces updates); fewer in output = error."""
    def dml(df, classes, name):
        return df.groupBy(qcol(script_col)).agg(
            F.count_if(qcol(class_col).isin(*classes)).alias(name))
    s = dml(src, ["INSERT", "DELETE", "UPDATE"], "src_dml")
    o = dml(out, ["INSERT", "DELETE", "UPDATE", "MERGE"], "out_dml")
    j = s.join(o, script_col, "full_outer").select(
        qcol(script_col), F.coalesce("src_dml", F.lit(0)).alias("src_dml"),
        F.coalesce("out_dml", F.lit(0)).alias("out_dml"))
    return j.withColumn("status", F.when(F.col("out_dml") < F.col("src_dml"), "error")
                        .otherwise("ok"))


REF_PATTERN = r"\b\w+(?:\.\w+)+\b"


def table_refs(stmts: DataFrame, id_cols: list[str], sql_col: str = "sql") -> DataFrame:
    """Distinct referenced table names (last part of dotted names, lower case)."""
    refs = stmts.select(*[qcol(c) for c in id_cols],
                        F.explode(F.regexp_extract_all(qcol(sql_col), F.lit(REF_PATTERN), 0))
                        .alias("ref"))
    parts = F.split(F.lower("ref"), r"\.")
    skip = F.lit(False)
    for s in REF_SKIP:
        skip = skip | F.array_contains(parts, s)
    return refs.filter(~skip).select(*[qcol(c) for c in id_cols],
                                     F.element_at(parts, -1).alias("table_name")).distinct()


def missing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose keys are absent from ``b`` (anti join)."""
    return a.join(b.select(*[qcol(k) for k in keys]).distinct(), keys, "left_anti")


def scan_leftovers(lines: DataFrame, id_cols: list[str], words: dict[str, str] | None = None,
                   comment_prefixes: tuple[str, ...] = ("#", "//"),
                   line_col: str = "line") -> DataFrame:
    """Forbidden words on non-comment lines, once per word per document."""
    words = words or LEFTOVER_WORDS
    marks = "|".join(re.escape(p) for p in comment_prefixes)
    comment = qcol(line_col).rlike(rf"^\s*({marks})") if comment_prefixes else F.lit(False)
    hits = F.filter(F.array(*[F.when(qcol(line_col).rlike(p), F.lit(w)) for w, p in words.items()]),
                    lambda x: x.isNotNull())
    return lines.filter(~comment).select(*[qcol(c) for c in id_cols], F.explode(hits).alias("word")) \
        .distinct().withColumn("severity", F.lit("error"))
