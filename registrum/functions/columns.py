"""Scalar column expressions used by the Silver, Gold and report jobs.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.spec import DATE_LOWER, DATE_UPPER

# Whitespace as Python's str.strip() sees it: Unicode White_Space plus the
# information separators U+001C..U+001F.
_EDGE_SPACE = r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$"


def strip_whitespace(c: Column) -> Column:
    """Trim leading and trailing Unicode whitespace (NULL stays NULL)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def exact_digits(c: Column, n: int) -> Column:
    """True when the whole string is exactly ``n`` ASCII digits; NULL -> False."""
    return F.coalesce(c.rlike(rf"\A[0-9]{{{n}}}\z"), F.lit(False))


def prefix_in(c: Column, prefixes: Iterable[str]) -> Column:
    """``substring(c, 1, k) IN prefixes`` written as an OR of ``startswith``.

    Same truth table (NULL and short strings included), but Parquet receives
    it as pushed ``StringStartsWith`` filters instead of a post-scan filter.
    """
    prefixes = list(prefixes)
    if len({len(p) for p in prefixes}) > 1:
        raise ValueError(f"prefixes of one length only: {prefixes}")
    preds = [c.startswith(p) for p in prefixes]
    return functools.reduce(operator.or_, preds)


def first_chars(c: Column, n: int = 2) -> Column:
    return F.substring(c, 1, n)


def clamp_date(c: Column) -> Column:
    """NULL outside [1678-01-01, 2261-12-31]; both bounds are kept. ``c`` is a date
    or a timestamp; text is parsed first (``lenient_timestamp``)."""
    lo, hi = F.lit(DATE_LOWER).cast("date"), F.lit(DATE_UPPER).cast("date")
    day = c.cast("date")
    return F.when(day < lo, F.lit(None)).when(day > hi, F.lit(None)).otherwise(c)


#: Spellings of a date other than ISO: name -> (pattern of the whole text, the same as ISO text). What
#: follows the day is a time of day, or nothing.
DATE_SPELLINGS = {
    "day first": (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})($|[ T].*$)", "$3-$2-$1$4"),
    "month first": (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})($|[ T].*$)", "$3-$1-$2$4"),
    "year first": (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})($|[ T].*$)", "$1-$2-$3$4"),
    "digits": (r"^(\d{4})(\d{2})(\d{2})($|[ T].*$)", "$1-$2-$3$4"),
}


def spelled_timestamp(text: Column, spelling: str) -> Column:
    """A text in that spelling as TIMESTAMP_NTZ, else NULL (no such day included)."""
    pattern, iso = DATE_SPELLINGS[spelling]
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, iso)).try_cast("timestamp_ntz")


def lenient_timestamp(c: Column, dtype: T.DataType, spellings: Iterable[str] = ()) -> Column:
    """Parse to TIMESTAMP_NTZ; anything unparseable becomes NULL (never raises). Text is
    read as ISO first, then in each of the ``spellings`` in their order."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.StringType):
        text = strip_whitespace(c)
        return F.coalesce(text.try_cast("timestamp_ntz"), *[spelled_timestamp(text, s) for s in spellings])
    return c.try_cast("timestamp_ntz")


def age_in_years(date_col: Column, as_of_year: int) -> Column:
    """as_of_year - year(date) as double; NULL date -> -1.0."""
    years = (F.lit(as_of_year) - F.year(date_col)).cast("double")
    return F.coalesce(years, F.lit(-1.0))


def ntz(ts: datetime) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so neither the Python
    process's nor the session's time zone can shift the wall-clock value."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def sample_key(seed: int, key: Column) -> Column:
    """Reproducible, partition-independent random order: md5('seed|key')."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
