"""Date helpers whose meaning differs from Spark's built-ins."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds per unit.
_MICROS = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}

# Warehouse date tokens and their Spark pattern letters.
FORMAT_TOKENS = [
    ("YYYY", "yyyy"),
    ("YY", "yy"),
    ("MON", "MMM"),
    ("MM", "MM"),
    ("DD", "dd"),
    ("HH24", "HH"),
    ("HH12", "hh"),
    ("MI", "mm"),
    ("SS", "ss"),
]


def ntz(at: datetime.datetime | str) -> Column:
    """Literal wall-clock time, independent of any time zone."""
    return F.lit(str(at)).cast("timestamp_ntz")


def _unit_number(unit: str, ts: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))
    size = F.lit(_MICROS[unit])
    return ((micros - F.pmod(micros, size)) / size).cast("long")


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries between two times (00:59 to 01:01 is one hour)."""
    if unit == "year":
        return (F.year(end) - F.year(start)).cast("long")
    if unit == "month":
        months = lambda c: F.year(c) * 12 + F.month(c)
        return (months(end) - months(start)).cast("long")
    return _unit_number(unit, end) - _unit_number(unit, start)


def spark_pattern(fmt: str) -> str:
    """Translate a warehouse date format such as ``MM-DD-YYYY HH24:MI``."""
    out, rest = "", fmt
    while rest:
        for token, pattern in FORMAT_TOKENS:
            if rest.upper().startswith(token):
                out, rest = out + pattern, rest[len(token):]
                break
        else:
            out, rest = out + rest[0], rest[1:]
    return out


# The date layouts providers send.
PROVIDER_DATE_FORMATS = ["MM-DD-YYYY", "YYYY-MM-DD", "MM/DD/YYYY"]


def parse_any_date(text: Column, formats: list[str] = PROVIDER_DATE_FORMATS) -> Column:
    """First layout that parses wins; nothing parses gives NULL."""
    return F.coalesce(
        *[F.try_to_date(text, spark_pattern(fmt)) for fmt in formats]
    )
