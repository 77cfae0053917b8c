"""Landing-file sources: delimited and flat files, sniffing, names, counts.

Everything here is a distributed job over *many* files at once: per-file facts
(separator, header, record count, business date) come out as one row per file,
never from a driver loop over paths.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loadworks.operators.shaping import qcol

# Separator names and the by-width candidate order.
SEPARATOR_NAMES = {"\x01": "soh", "|": "pipe", "\t": "tab", ",": "comma", ";": "semicolon"}
WIDTH_CANDIDATES = ["|", "\t", ",", ";"]
SNIFF_BYTES = 4096        # prefix of a file that decides its separator
WIDTH_LINES = (2, 5)      # lines of a file that decide it by width


# ------------------------------------------------------------------ readers

def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   infer: bool = True, encoding: str = "utf-8",
                   schema: StructType | str | None = None) -> DataFrame:
    """Delimited file(s) with header flag, separator, encoding, inference.

    An explicit ``schema`` skips the inference pass (preferred at scale).
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep) \
        .option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer).lower())
    return reader.csv(path)


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_flat(spark: SparkSession, path: str, columns: list[str], sep: str = "|") -> DataFrame:
    """Headerless flat file read with a fixed all-STRING schema.

    Short control records keep the column count: missing trailing fields are
    NULL.  Such files have no quoting: a field may begin with a quote.
    """
    return spark.read.schema(string_schema(columns)).option("sep", sep) \
        .option("quote", "").option("header", "false").option("mode", "PERMISSIVE").csv(path)


def read_flat_checked(spark: SparkSession, path: str, columns: list[str], sep: str = "|",
                      min_fields: int = 2) -> tuple[DataFrame, DataFrame]:
    """A headerless flat file split by width: ``(rows, rejects)``, both with their file.

    Rows have at most as many fields as columns (control records are short: missing
    trailing fields are NULL) and at least ``min_fields``; lines of another width come
    back whole as ``(file, line, fields, reason)``.  Nothing is dropped: every non-blank
    line is in one of the two.  One pass over the text for each of the results that is
    used; no shuffle.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")) \
        .filter(F.col("line").rlike(r"\S"))
    parts = F.split("line", re.escape(sep), -1)
    n = F.size(parts)
    reason = F.when(n > len(columns), "too many fields").when(n < min_fields, "too few fields")
    cells = [F.when(F.get(parts, F.lit(i)) != "", F.get(parts, F.lit(i))).alias(c) for i, c in enumerate(columns)]
    return (lines.filter(reason.isNull()).select("file", *cells),
            lines.select("file", "line", n.alias("fields"), reason.alias("reason")).filter("reason IS NOT NULL"))


def drop_control_records(df: DataFrame, key: str, sentinel: str = "000") -> DataFrame:
    """Keep rows whose first column is present and not the control sentinel."""
    return df.filter(qcol(key).isNotNull() & (qcol(key) != F.lit(sentinel)))


# ------------------------------------------------------------------ lines

def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their 1-based number: ``(file, line_no, line)``.

    Lines of one file block are read in order by one task, so a per-partition
    increasing id orders them inside the block; block offsets come from a
    running count over the (few) blocks of each file.  No window over the
    lines themselves, so a huge file is never sorted in one task.

    The text is scanned twice, and both scans must pack the file's blocks into
    tasks alike, which Spark does for equal files and settings: do not change
    ``spark.sql.files.*`` between building and running the frame.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
        F.col("value").alias("line"))
    blocks = raw.groupBy("file", "__block").agg(F.min("__id").alias("__first"),
                                                F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("file").orderBy("__block") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = blocks.select("file", "__block", "__first",
                            (F.sum("__n").over(w) - F.col("__n")).alias("__before"))
    return raw.join(offsets, ["file", "__block"]).select(
        "file", (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("line_no"),
        "line")


def block_summaries(spark: SparkSession, path: str, sep: str | None = None,
                    width: int | None = None) -> DataFrame:
    """What matters of each file block, one row a block, in one scan.

    ``(file, block, lines, filled, first_at, last_at)``: lines, non-blank lines, and the
    places (from 0) of the first and last non-blank one.  With ``sep`` and ``width`` also
    ``bad`` (non-blank lines of another number of fields), ``first_fields`` and
    ``last_fields`` (fields of the first and last non-blank line) and ``last_value`` (the
    last one's last field as a number).  Lines of a block are read in order by one
    task, so everything is a sum, minimum or maximum of numbers there, and only the
    summaries are shuffled.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    at = F.when(F.col("line").rlike(r"\S"), F.col("id"))
    rows = raw.select("file", "block", "id", at.alias("at"), "line")
    found = [F.count(F.lit(1)).alias("lines"), F.count("at").alias("filled"),
             (F.min("at") - F.min("id")).alias("first_at"), (F.max("at") - F.min("id")).alias("last_at")]
    if sep is not None:
        rows = rows.select("file", "block", "id", "at", (_count(F.col("line"), sep) / len(sep) + 1).cast("int").alias("fields"),
                           F.substring_index("line", sep, -1).try_cast("long").alias("value"))
        found += [F.count(F.when(F.col("at").isNotNull() & (F.col("fields") != width), 1)).alias("bad"),
                  F.min_by("fields", "at").alias("first_fields"), F.max_by("fields", "at").alias("last_fields"),
                  F.max_by("value", "at").alias("last_value")]
    return rows.groupBy("file", "block").agg(*found)


def fold_blocks(blocks: DataFrame) -> DataFrame:
    """Summaries of whole files from those of their blocks: ``(file, lines, filled, first_no, last_no, ...)``.

    ``first_no`` and ``last_no`` are the 1-based numbers of the first and last non-blank
    line (NULL if there is none); the other columns as in ``block_summaries``.
    """
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("before", F.coalesce(F.sum("lines").over(w), F.lit(0)))
    place = F.when(F.col("filled") > 0, F.col("block"))
    found = [F.sum("lines").alias("lines"), F.sum("filled").alias("filled"),
             F.min(F.col("before") + F.col("first_at") + 1).alias("first_no"),
             F.max(F.col("before") + F.col("last_at") + 1).alias("last_no")]
    if "bad" in blocks.columns:
        found += [F.sum("bad").alias("bad"), F.min_by("first_fields", place).alias("first_fields"),
                  F.max_by("last_fields", place).alias("last_fields"), F.max_by("last_value", place).alias("last_value")]
    return placed.groupBy("file").agg(*found)


def count_records(spark: SparkSession, path: str, control_lines: int = 2) -> DataFrame:
    """``(file, records)``: lines from the first to the last non-blank one, less the control
    lines (header and trailer), of every file below ``path``; from block summaries."""
    span = F.coalesce(F.col("last_no") - F.col("first_no") + 1, F.lit(0)) - control_lines
    return fold_blocks(block_summaries(spark, path)).select("file", F.greatest(span, F.lit(0)).cast("long").alias("records"))


def head_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` lines of each file: ``(file, line_no, line)``.

    They are in the file's first block, whose lines one task reads in order, so
    nothing else is numbered or moved.  ``n`` lines must fit into a block; a
    line that is longer than a block belongs to the block it starts in.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"), F.col("value").alias("line"))
    w = Window.partitionBy("file").orderBy("__id")
    return raw.filter(F.col("__block") == 0).withColumn("line_no", F.row_number().over(w)) \
        .filter(F.col("line_no") <= n).select("file", "line_no", F.rtrim("line", F.lit("\r")).alias("line"))


def _count(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def sniff_delimiter(spark: SparkSession, path: str, sniff_bytes: int = SNIFF_BYTES) -> DataFrame:
    """Separator of each file from its first bytes: ``(file, delimiter)``.

    SOH present -> soh; else pipe if more pipes than commas; else tab if more
    tabs than commas; else comma (ties give comma; so does an empty file).
    Only lines that begin within the prefix are kept, each cut to its length;
    the prefix is cut at bytes, before decoding.
    """
    w = Window.partitionBy("file").orderBy("line_no")
    # every line has a byte at least, its end: no more lines than bytes can matter
    heads = head_lines(spark, path, sniff_bytes).select(
        "file", "line_no", F.col("line").cast("binary").alias("b"))
    heads = heads.withColumn("end", F.sum(F.octet_length("b") + 1).over(w)) \
        .withColumn("at", F.col("end") - F.octet_length("b") - 1).filter(F.col("at") < sniff_bytes) \
        .withColumn("s", F.decode(F.substring(F.col("b"), F.lit(1), (F.lit(sniff_bytes) - F.col("at")).cast("int")),
                                  "UTF-8"))
    s = heads.groupBy("file").agg(*[F.sum(_count(F.col("s"), c)).alias(n) for c, n in SEPARATOR_NAMES.items()])
    name = F.when(F.col("soh") > 0, "soh").when(F.col("pipe") > F.col("comma"), "pipe") \
        .when(F.col("tab") > F.col("comma"), "tab").otherwise("comma")
    return s.select("file", name.alias("delimiter"))


def sniff_delimiter_by_width(lines: DataFrame, window: tuple[int, int] = WIDTH_LINES) -> DataFrame:
    """Separator by widest row over some first lines of each file (see ``head_lines``).

    For each line and candidate (pipe, tab, comma, semicolon) the field count
    is taken; the strictly largest count wins, earlier lines and earlier
    candidates win ties; pipe when a file has no such lines.
    """
    cands = F.array(*[F.lit(c) for c in WIDTH_CANDIDATES])
    pairs = lines.select("file", "line_no", "line", F.posexplode(cands).alias("pos", "sep"))
    nf = F.when(F.col("line_no").between(*window),
                F.size(F.split(F.col("line"), F.concat(F.lit("\\Q"), F.col("sep"), F.lit("\\E")), -1)))
    best = pairs.groupBy("file").agg(F.max(F.when(nf.isNotNull(), F.struct(
        nf.alias("nf"), (-F.col("line_no")).alias("l"), (-F.col("pos")).alias("p"), "sep"))).alias("best"))
    names = F.create_map(*[x for k, v in SEPARATOR_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return best.select("file", F.coalesce(names[F.col("best.sep")], F.lit("pipe")).alias("delimiter"))


def has_header(first_line: Column, sep: str) -> Column:
    """Header when the first 10 characters of the first field hold no digit."""
    first_field = F.split(first_line, re.escape(sep), -1).getItem(0)
    return F.when(F.coalesce(first_line, F.lit("")) == "", F.lit(False)) \
        .otherwise(~F.substring(first_field, 1, 10).rlike("[0-9]"))


def header_flags(lines: DataFrame, sep: str) -> DataFrame:
    """``(file, has_header)`` from line 1 of each file (see ``head_lines``)."""
    return lines.filter(F.col("line_no") == 1).select("file", has_header(F.col("line"), sep).alias("has_header"))


def count_file_records(lines: DataFrame, control_lines: int = 2) -> DataFrame:
    """Data records per file: lines between the first and last non-blank line,
    minus the control (header + trailer) lines.  Counts the whole file."""
    at = F.when(F.col("line").rlike(r"\S"), F.col("line_no"))
    spans = lines.groupBy("file").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    return spans.select(
        "file", F.greatest(F.coalesce(F.col("b") - F.col("a") + 1, F.lit(0)) - control_lines,
                           F.lit(0)).cast("long").alias("records"))


# ------------------------------------------------------------------ names

def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def table_name_from_path(path: Column, prefixes: list[str]) -> Column:
    """Table name of a landed file: drop the last extension, lower-case,
    strip the first matching database prefix, map ``-``, space and ``.`` to ``_``."""
    name = file_name(path)
    stem = F.when(name.rlike(r"^.+\.[^.]*$"), F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)) \
        .otherwise(name)
    low = F.lower(stem)
    stripped = low
    for p in reversed(prefixes):
        stripped = F.when(low.startswith(p), F.substring(low, len(p) + 1, 1 << 30)) \
            .otherwise(stripped)
    return F.translate(stripped, "- .", "___")


def business_date_from_path(path: Column) -> Column:
    """``....DddMMyy`` file-name suffix -> date ``20yy-MM-dd`` (NULL if absent)."""
    m = r"\.D(\d{2})(\d{2})(\d{2})$"
    name = file_name(path)
    text = F.concat(F.lit("20"), F.regexp_extract(name, m, 3), F.lit("-"),
                    F.regexp_extract(name, m, 2), F.lit("-"), F.regexp_extract(name, m, 1))
    return F.when(name.rlike(m), F.try_to_date(text, "yyyy-MM-dd"))


def path_for_business_date(file: Column, day: Column) -> Column:
    """Reverse of ``business_date_from_path``: ``{file}.D{ddMMyy}``."""
    return F.concat(file, F.lit(".D"), F.date_format(day, "ddMMyy"))
