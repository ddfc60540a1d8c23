"""15-minute bucket arithmetic (OP-51) and UTC conversions.

Buckets are aligned to the Unix epoch.  ``floor15`` is ``date_bin``;
``ceil15`` maps a boundary instant to itself; ``next15`` maps a boundary to
the following bucket.  All work on microseconds so sub-second times are exact
and ``pmod`` keeps pre-1970 instants right.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_MICROS = 15 * 60 * 1_000_000


def BUCKET() -> Column:  # noqa: N802 - reads like the constant it stands for
    """The 15-minute bucket width as an interval column."""
    return F.expr("INTERVAL 15 MINUTES")


def interval(text: str) -> Column:
    """An interval literal column, e.g. ``interval('1 HOUR')``."""
    return F.expr(f"INTERVAL {text}")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor15(t: Column | str) -> Column:
    us = F.unix_micros(_c(t))
    return F.timestamp_micros(us - F.pmod(us, F.lit(BUCKET_MICROS)))


def ceil15(t: Column | str) -> Column:
    us = F.unix_micros(_c(t)) - F.lit(1)
    return F.timestamp_micros(us - F.pmod(us, F.lit(BUCKET_MICROS)) + F.lit(BUCKET_MICROS))


def next15(t: Column | str) -> Column:
    us = F.unix_micros(_c(t))
    return F.timestamp_micros(us - F.pmod(us, F.lit(BUCKET_MICROS)) + F.lit(BUCKET_MICROS))


def to_utc(t: Column | str) -> Column:
    """timestamp_ntz (driver parquet) -> timestamp; identity under a UTC session."""
    return _c(t).cast("timestamp")


def to_ntz(t: Column | str) -> Column:
    """timestamp -> timestamp_ntz for output (DuckDB TIMESTAMP is zone-less)."""
    return _c(t).cast("timestamp_ntz")


def iso_utc(t: Column | str, fraction: int = 6) -> Column:
    """ISO-8601 text with a ``Z`` suffix (``to_char(..., 'YYYY-MM-DD"T"HH24:MI:SS.MS"Z"')``)."""
    frac = "." + "S" * fraction if fraction else ""
    return F.date_format(_c(t), f"yyyy-MM-dd'T'HH:mm:ss{frac}'Z'")


def parse_utc(s: Column | str) -> Column:
    """ISO text (with ``Z`` or an offset) -> timestamp. ANSI: junk fails the job."""
    return _c(s).cast("timestamp")
