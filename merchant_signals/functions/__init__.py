"""Column-level helpers (pure built-in expressions, no UDFs)."""

from merchant_signals.functions.time import (
    BUCKET, ceil15, floor15, iso_utc, next15, parse_utc, to_ntz, to_utc,
)
from merchant_signals.functions.json import has_key, json_merge, json_text
from merchant_signals.functions.numeric import safe_ratio, sigmoid, tolerant_float

__all__ = [
    "BUCKET", "ceil15", "floor15", "iso_utc", "next15", "parse_utc", "to_ntz", "to_utc",
    "has_key", "json_merge", "json_text", "safe_ratio", "sigmoid", "tolerant_float",
]
