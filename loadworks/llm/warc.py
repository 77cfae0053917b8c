"""WARC archives: writing pages as records and reading archives back by boundary chains.

Writing: a record a page, uncompressed, through Spark's text writer, whose line
separator is the blank line that ends a record.  Pages with equal payloads of
``MIN_REVISIT`` bytes or more are stored once; the others are revisit records.

Reading: archives are split anywhere.  Each task takes the pieces between
occurrences of ``WARC/`` at a line's start as candidate records and works out,
from the candidate's own headers, where its successor must start.  Candidates
are followed inside a block; from block to block pointer jumping from each
file's start finds the reachable ones.  Magic strings inside payloads are
never reached, and their bytes stay part of the payload around them.

Defined results: a null payload is an empty one; a null url gives no target
header; equal payloads with the same largest id are all responses; an empty
table gives no records; candidates that the chain does not reach are dropped.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadworks.llm.components import small, stored

MIN_REVISIT = 1000
OWNER_BYTES = 32 << 20  # bytes of a file whose pieces are given to their records in one task
MAGIC = b"\nWARC/"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_revisit: int = MIN_REVISIT,
          date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record a row below ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn(
        "digest", F.sha1(F.col("payload").cast("binary")))
    repeated = stored(rows.where(F.col("bytes") >= min_revisit).groupBy("digest")
                       .agg(F.max("page").alias("original"), F.count("*").alias("n"))
                       .where("n > 1").select("digest", "original"), "warc-repeated")
    typed = rows.join(small(repeated), "digest", "left")
    revisit: Column = F.coalesce((F.col("original") != F.col("page")) | F.col("page").isNull(), F.lit(False)) \
        & F.col("original").isNotNull()

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))

    block = F.concat(F.lit(HTTP), F.when(revisit, "").otherwise(F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", urn(F.col("page"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        header("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, header("WARC-Refers-To", urn(F.col("original")))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block)
    typed.select(record.alias("value")).write.option("lineSep", END).text(path)


_CANDIDATES = ("file string, block long, idx long, at long, succ long, exit long, size long, page long, "
               "type string, digest string, payload_bytes long, refers long, checked boolean, last boolean")


def parse(piece: bytes) -> dict | None:
    """Header facts of a candidate record (from ``WARC/`` on), or None if it is not one."""
    end = piece.find(b"\r\n\r\n")
    if not re.match(rb"WARC/\d\.\d\r\n", piece) or end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,15}", length):
        return None

    def number(name: str, pattern: str) -> int | None:
        found = re.fullmatch(pattern, fields.get(name, ""))
        return int(found[1]) if found else None

    return {"body": end + 4, "length": int(length), "type": fields.get("warc-type"),
            "page": number("warc-record-id", r"<urn:page:(-?[0-9]{1,19})>"),
            "refers": number("warc-refers-to", r"<urn:page:(-?[0-9]{1,19})>"),
            "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "payload_bytes": number("warc-payload-length", r"([0-9]{1,15})")}


def check(facts: dict, block: bytes) -> bool:
    """Does a response's payload have the length and digest that its header states?"""
    if facts["type"] != "response":
        return True
    payload = block[block.find(b"\r\n\r\n") + 4:]
    return (len(payload) == facts["payload_bytes"]
            and hashlib.sha1(payload).hexdigest() == facts["digest"])


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value) of the pieces between magic strings, in file order within a block."""
    return (spark.read.option("lineSep", MAGIC.decode()).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("value")))


def _numbered(batches):
    """(file, block, idx, at, piece with its magic) where ``at`` counts bytes from the block's first piece."""
    key, idx, at = None, 0, 0
    for batch in batches:
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for file, block, value in zip(files, blocks, batch.column(2)):
            if (file, block) != key:
                key, idx, at = (file, block), 0, 0
            value = value.as_py()
            # the first piece of a file has its magic inside; all others lost it to the separator
            yield file, block, idx, at, (value if block == 0 and idx == 0 else MAGIC[1:] + value)
            at += len(value) + (1 if block == 0 and idx == 0 else len(MAGIC))
            idx += 1


def _candidate_task(batches):
    """Candidates of a task's blocks, each with the first successor outside its block.

    Positions are relative to the block: its first piece's ``WARC/`` is at 0.
    """
    names = [c.split()[0] for c in _CANDIDATES.split(", ")]

    def out(rows):
        known = {r["at"]: r for r in rows}
        for r in reversed(rows):  # successors lie after their record
            after = known.get(r["succ"]) if r["succ"] is not None else None
            r["exit"] = after["exit"] if after is not None else r["succ"]
        if rows:
            rows[-1]["last"] = True
        for i in range(0, len(rows), 20000):
            part = rows[i:i + 20000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in part], _ARROW[n]) for n in names], names=names)

    rows, key = [], None
    for file, block, idx, at, piece in _numbered(batches):
        if (file, block) != key:
            yield from out(rows)
            rows, key = [], (file, block)
        row = {"file": file, "block": block, "idx": idx, "at": at, "size": len(piece), "succ": None,
               "exit": None, "checked": None, "last": False}
        facts = parse(piece)
        if facts:
            end = facts["body"] + facts["length"]
            row |= {"succ": at + end + 4, "page": facts["page"], "type": facts["type"],
                    "digest": facts["digest"], "payload_bytes": facts["payload_bytes"],
                    "refers": facts["refers"]}
            if end <= len(piece):
                row["checked"] = check(facts, piece[facts["body"]:end])
        rows.append(row)
    yield from out(rows)


_ARROW = {c.split()[0]: {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]]
          for c in _CANDIDATES.split(", ")}


def _walk(block: pa.Table) -> pa.Table:
    """The candidates of one block on the chain from its entry."""
    block = block.sort_by("at")
    where = {p: k for k, p in enumerate(block["at"].to_pylist())}
    succ = block["succ"].to_pylist()
    k, kept = where.get(block["entry"][0].as_py()), []
    while k is not None:
        kept.append(k)
        k = where.get(succ[k])
    return block.take(pa.array(kept, pa.int64())).drop_columns(["entry"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, page, type, digest, payload_bytes, refers, checked) of every record of the archives.

    ``checked`` says whether a response's payload has the stated length and
    digest.  What is joined and grouped are short facts of records; payloads
    are moved only where one spans several pieces.
    """
    pieces = _pieces(spark, path)
    found = stored(pieces.mapInArrow(_candidate_task, _CANDIDATES), "warc-candidates")
    # a block's first piece starts where the pieces of the blocks before it end
    blocks = found.groupBy("file", "block").agg(
        F.max(F.col("at") + F.col("size") + 1).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = found.join(base, ["file", "block"]).select(
        "*", (F.col("base") + F.col("at")).alias("start"), (F.col("base") + F.col("exit")).alias("to"))
    # the chain enters blocks where some candidate leaves another: only these positions are jumped from
    entered = placed.where("to is not null").select("file", F.col("to").alias("start")).distinct()
    jump = stored(placed.where("to is not null").select("file", "start", "to").join(
        entered.unionByName(placed.where("start = 0").select("file", "start")), ["file", "start"], "left_semi"),
        "warc-jump")
    reach = stored(placed.where("start = 0").select("file", "start"), "warc-reach")
    while True:  # 2**k steps of the chain in round k
        step = jump.join(reach, ["file", "start"]).select("file", F.col("to").alias("start"))
        wider = stored(reach.unionByName(step).distinct(), "warc-reach")
        after = jump.select("file", F.col("start").alias("to"), F.col("to").alias("beyond"))
        jump = stored(jump.join(after, ["file", "to"]).select("file", "start", F.col("beyond").alias("to")),
                       "warc-jump")
        reach = wider
        if not jump.limit(1).count():
            break
    entry = (placed.join(reach, ["file", "start"], "left_semi")
             .select("file", "block", F.col("at").alias("entry")))
    schema = found.schema.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", ")
    chained = (found.where("succ is not null").join(entry, ["file", "block"])
               .groupBy("file", "block").applyInArrow(_walk, schema))
    chained = stored(chained.join(base, ["file", "block"])
                      .withColumn("start", F.col("base") + F.col("at"))
                      .withColumn("end", F.col("base") + F.col("succ")), "warc-chain")
    facts = ["file", F.col("start").alias("at"), "page", "type", "digest", "payload_bytes", "refers"]
    whole = chained.where("checked is not null").select(*facts, "checked")
    spanning = chained.where("checked is null")
    if not spanning.limit(1).count():
        return whole
    # records over several pieces: fetch those pieces, and no others
    owners = chained.select("file", "start", F.lit(True).alias("real"))
    part = F.floor(F.col("start") / OWNER_BYTES)
    # the record that reaches into a part of a file from before it; records do not overlap: one a part at most
    first, last = part + 1, F.floor((F.col("end") - 1) / OWNER_BYTES)
    carried = (spanning.where(last >= first)
               .select("file", F.col("start").alias("carry"), F.explode(F.sequence(first, last)).alias("part")))
    line = Window.partitionBy("file", "part").orderBy("start")
    owned = (placed.select("file", "block", "idx", "start", part.alias("part"))
             .join(owners, ["file", "start"], "left").join(carried, ["file", "part"], "left")
             .withColumn("owner", F.coalesce(F.last(F.when(F.col("real"), F.col("start")), True).over(line),
                                             F.col("carry"))))
    reaching = spanning.select("file", F.col("start").alias("owner"), "end")
    wanted = stored(owned.join(reaching, ["file", "owner"]).where("start < end")
                     .select("file", "block", "idx", "owner", F.col("start").alias("piece_start")), "warc-wanted")

    def fetch(batches):
        for file, block, idx, _, piece in _numbered(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([idx]), pa.array([piece], pa.binary())],
                names=["file", "block", "idx", "piece"])

    raw = pieces.mapInArrow(fetch, "file string, block long, idx long, piece binary")

    def verify(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("piece_start")
        text = b"\n".join(parts["piece"].to_pylist())
        f = parse(text)
        ok = f is not None and check(f, text[f["body"]:f["body"] + f["length"]])
        return pa.table({"file": parts["file"][:1], "owner": parts["owner"][:1], "ok": [ok]})

    verified = (raw.join(small(wanted), ["file", "block", "idx"])
                .groupBy("file", "owner").applyInArrow(verify, "file string, owner long, ok boolean"))
    joined = (spanning.join(verified.withColumnRenamed("owner", "start"), ["file", "start"], "left")
              .select(*facts, F.coalesce("ok", F.lit(False)).alias("checked")))
    return whole.unionByName(joined)
