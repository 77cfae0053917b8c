"""Arrow and numpy helpers shared by the operators of this package.

Text columns arrive in tasks as Arrow arrays; the helpers look at their UTF-8
bytes directly, in slices of bounded size, so that the numpy temporaries stay
small whatever the size of an Arrow batch.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INV = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))

# Blanks of the word rule [^\x20\x09-\x0D]+ as a table over byte values.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# Letters, digits and every non-ASCII byte: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z -> a-z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

# A-Z -> a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def ready(spark: SparkSession) -> None:
    """Session settings that the operators expect.

    Texts reach a task in batches of a few megabytes, so that its memory does not
    grow with their length; Python workers find this package where the driver
    does, also if it is not installed, and give the memory of large arrays back
    when they free it, so that idle workers do not hold what a task once needed.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))
    for name, value in (("MALLOC_MMAP_THRESHOLD_", "524288"), ("MALLOC_TRIM_THRESHOLD_", "524288"),
                        ("MALLOC_ARENA_MAX", "2"), ("ARROW_DEFAULT_MEMORY_POOL", "system")):
        environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string/binary array; a null is an empty text."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes (one longer text makes a range of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base (or of its inverse) modulo 2**64."""
    key = "inv" if inverse else "fwd"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 64)
        have = np.full(size, _BASE_INV if inverse else _BASE, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * SLICE_BYTES:
            _POWERS[key] = have
    return have[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for each range (values: any unsigned integers)."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n), out=total[1:])
    poly = (total[ends] - total[starts]) * powers(n + 1, True)[starts]
    return mix(poly ^ ((ends - starts).astype(np.uint64) * _MULT))


def word_ranges(data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
    """Words of texts: (starts, ends, first word of each text, with the count at the end).

    A word is a maximal run of member bytes inside one text.
    """
    flag = np.zeros(len(data) + 2, np.int8)
    flag[1:-1] = member[data]
    edge = np.diff(flag)
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
    inside = cuts[(flag[cuts] == 1) & (flag[cuts + 1] == 1)]  # a run over a border of texts
    if len(inside):
        starts = np.sort(np.concatenate([starts, inside]))
        ends = np.sort(np.concatenate([ends, inside]))
    return starts, ends, np.searchsorted(starts, offsets)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over consecutive ranges bounds[i]:bounds[i + 1] (empty ranges: 0)."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[bounds])


def with_columns(docs: DataFrame, inputs: list[str], fields: str, make: Callable,
                 drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with new columns, computed in place from Arrow arrays of the ``inputs``, and
    without the columns of ``drop``.

    ``make(*arrays)`` returns the arrays of ``fields``.  As with ``withColumn``, a
    new column takes the place of an input column of the same name.
    """
    names = docs.columns
    passed = [i for i, c in enumerate(names) if c not in drop]
    new = StructType.fromDDL(fields)
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = [names.index(c) for c in inputs]
    out = [f"n{i}" for i in range(len(new))]
    schema = StructType([flat.schema[i] for i in passed])
    for name, field in zip(out, new):
        schema = schema.add(name, field.dataType)

    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in passed],
                                              *make(*[batch.column(i) for i in at])], names=schema.names)

    made = flat.mapInArrow(task, schema)
    kept = [made[f"c{i}"].alias(names[i]) for i in passed if names[i] not in new.names]
    return made.select(*kept, *[made[n].alias(f.name) for n, f in zip(out, new)])
