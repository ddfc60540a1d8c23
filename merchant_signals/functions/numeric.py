"""Numeric helpers shared by the scorers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_float(c: Column | str) -> Column:
    """OP-09: NULL, '' and 'null' exactly read as 0.0; anything else must parse
    (the ANSI cast raises on junk and on blanks, and ignores space around a number)."""
    s = _c(c).cast("string")
    return (F.when(s.isNull() | s.isin("", "null"), F.lit(0.0))
            .otherwise(s.cast("double")))


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` or ``default`` when ``den`` is 0 or NULL."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def sigmoid(x: Column) -> Column:
    """Two-branch logistic that never overflows ``exp``."""
    return (F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))
            .otherwise(F.exp(x) / (F.lit(1.0) + F.exp(x))))
