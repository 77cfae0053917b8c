"""Legacy-dialect scalar functions mapped onto Spark SQL built-ins.

Notes on semantics that differ between engines:

* Spark 4 runs in ANSI mode: a plain ``cast`` or ``to_timestamp`` raises on
  bad text, so the conversions here use ``try_cast`` / ``try_to_timestamp``
  and return NULL for unparsable values (count them with ``reject_count``).
* ``^`` is XOR in Spark; the legacy power operator maps to ``pow``.
* ``concat`` is NULL when any argument is NULL, like the legacy ``||``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col", "trim_spaces", "trim_leading", "trim_trailing", "ereplace",
    "null_to_zero", "null_to_empty", "is_null", "is_not_null", "if_not_null",
    "iif", "hash_sha256", "card_mask", "date_text_to_timestamp", "md5_hex",
    "str_left", "str_right", "substrings", "current_ts", "current_dt",
    "decimal_to_string", "string_to_decimal", "translate_date_format",
    "date_to_string", "date_offset_by_components", "concat_op", "to_int",
    "to_decimal", "power", "null_of", "null_if_text_null",
    "timestamp_from_date_param", "reject_count",
]


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c) -> Column:
    """``Trim``: strip leading and trailing spaces."""
    return F.trim(as_col(c))


def trim_leading(c) -> Column:
    """``TrimLeading``."""
    return F.ltrim(as_col(c))


def trim_trailing(c) -> Column:
    """``TrimTrailing``."""
    return F.rtrim(as_col(c))


def ereplace(c, pattern: str, replacement: str) -> Column:
    """``Ereplace``: replace every match of a regular expression."""
    return F.regexp_replace(as_col(c), pattern, replacement)


def null_to_zero(c) -> Column:
    """``NullToZero``."""
    return F.coalesce(as_col(c), F.lit(0))


def null_to_empty(c) -> Column:
    """``NullToEmpty``."""
    return F.coalesce(as_col(c), F.lit(""))


def is_null(c) -> Column:
    return as_col(c).isNull()


def is_not_null(c) -> Column:
    return as_col(c).isNotNull()


def if_not_null(c, default) -> Column:
    """``IF(x IS NOT NULL, x, default)`` — the same as ``coalesce``."""
    x = as_col(c)
    d = default if isinstance(default, Column) else F.lit(default)
    return F.when(x.isNotNull(), x).otherwise(d)


def iif(cond: Column, then, otherwise) -> Column:
    """``IIF`` / ``IF ... THEN ... ELSE``."""
    t = then if isinstance(then, Column) else F.lit(then)
    o = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return F.when(cond, t).otherwise(o)


def hash_sha256(c) -> Column:
    """One-way hash replacing an encryption stage: hex SHA-256 of the text."""
    return F.sha2(as_col(c).cast("string"), 256)


def card_mask(c) -> Column:
    """Card mask for a 16-digit number: first six, six stars, last four."""
    x = as_col(c)
    return F.concat(F.substring(x, 1, 6), F.lit("******"), F.substring(x, 13, 4))


def date_text_to_timestamp(c) -> Column:
    """Blank or NULL -> NULL, else ``yyyy-MM-dd`` text at midnight.

    Unparsable text becomes NULL instead of failing the job.
    """
    x = as_col(c)
    parsed = F.try_to_timestamp(F.concat(x, F.lit(" 00:00:00")),
                                F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return F.when(x.isNull() | (F.trim(x) == ""), F.lit(None).cast("timestamp_ntz")) \
        .otherwise(parsed)


def timestamp_from_date_param(date_text: str) -> Column:
    """A run parameter ``yyyy-MM-dd`` as a timestamp at midnight."""
    return date_text_to_timestamp(F.lit(date_text))


def md5_hex(c) -> Column:
    return F.md5(as_col(c).cast("string"))


def str_left(c, n: int) -> Column:
    """``strleft``."""
    return F.left(as_col(c), F.lit(n))


def str_right(c, n: int) -> Column:
    """``strright``."""
    return F.right(as_col(c), F.lit(n))


def substrings(c, start: int, length: int) -> Column:
    """``Substrings``: 1-based start and length."""
    return F.substring(as_col(c), start, length)


def current_ts(run_ts: str | None = None) -> Column:
    """``CurrentTimestamp``.  Pass ``run_ts`` to make a job repeatable."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp_ntz")


def current_dt(run_date: str | None = None) -> Column:
    """``CurrentDate``.  Pass ``run_date`` to make a job repeatable."""
    if run_date is None:
        return F.current_date()
    return F.lit(run_date).cast("date")


def decimal_to_string(c) -> Column:
    return as_col(c).cast("string")


def string_to_decimal(c, precision: int = 38, scale: int = 10) -> Column:
    """``StringToDecimal``; unparsable text gives NULL."""
    return as_col(c).try_cast(f"decimal({precision},{scale})")


# Legacy date-format tokens and their Spark pattern letters,
# applied longest first.
_FORMAT_TOKENS = [
    ("%yyyy", "yyyy"), ("YYYY", "yyyy"), ("%yy", "yy"), ("%mm", "MM"),
    ("MM", "MM"), ("%dd", "dd"), ("DD", "dd"), ("%hh", "HH"), ("%nn", "mm"),
    ("%ss", "ss"),
]


def translate_date_format(fmt: str) -> str:
    """Translate a legacy format such as ``YYYY-MM-DD %hh:%nn:%ss``.

    Runs on the driver over the format text only.
    """
    out, i = [], 0
    while i < len(fmt):
        for token, spark_token in _FORMAT_TOKENS:
            if fmt.startswith(token, i):
                out.append(spark_token)
                i += len(token)
                break
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if re.match(r"[A-Za-z]", ch) else ch)
            i += 1
    return "".join(out)


def date_to_string(c, legacy_format: str) -> Column:
    """``DateToString(c, fmt)`` with a legacy format string."""
    return F.date_format(as_col(c), translate_date_format(legacy_format))


def date_offset_by_components(c, years: int, months: int, days: int) -> Column:
    """``DateOffsetByComponents``; month ends clamp (Jan 31 + 1 month = Feb 28/29)."""
    d = F.to_date(as_col(c))
    return F.date_add(F.add_months(d, 12 * years + months), days)


def concat_op(*cols) -> Column:
    """The ``||`` operator: NULL if any part is NULL."""
    return F.concat(*[as_col(c) for c in cols])


def to_int(c) -> Column:
    return as_col(c).try_cast("int")


def to_decimal(c, precision: int = 10, scale: int = 2) -> Column:
    return as_col(c).try_cast(f"decimal({precision},{scale})")


def power(base, exponent) -> Column:
    """The legacy ``^`` operator (Spark's ``^`` is bitwise XOR)."""
    b = as_col(base)
    e = exponent if isinstance(exponent, Column) else F.lit(exponent)
    return F.pow(b, e)


def null_of(dtype: str = "string") -> Column:
    """A typed NULL; an untyped NULL cannot be stored."""
    return F.lit(None).cast(dtype)


def null_if_text_null(c) -> Column:
    """Turn the text ``'NULL'`` into a real NULL (only when asked)."""
    return F.nullif(as_col(c), F.lit("NULL"))


def reject_count(raw, parsed) -> Column:
    """Aggregate: rows whose raw value is present but did not parse."""
    return F.count_if(as_col(raw).isNotNull() & (F.trim(as_col(raw)) != "")
                      & as_col(parsed).isNull())
