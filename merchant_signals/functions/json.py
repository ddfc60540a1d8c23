"""JSON payload helpers (the reference keeps payloads as JSONB).

``json_text`` is ``payload->>'k'``: NULL for a missing key and for JSON null,
text for numbers.  ``has_key`` is ``payload ? 'k'``: true even when the value
is JSON null.  ``json_merge`` is the top-level ``jsonb || jsonb`` (right wins).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(payload: Column | str, key: str) -> Column:
    return F.get_json_object(_c(payload), f"$.{key}")


def has_key(payload: Column | str, key: str) -> Column:
    keys = F.json_object_keys(_c(payload))
    return F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False))


def json_merge(payload: Column | str, overrides: Column) -> Column:
    """Shallow merge: keys of ``overrides`` (a map of strings, numbers, booleans or variants) replace the
    payload's; all other values keep their JSON type, whatever they hold.  NULL for a payload that is no object.
    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by the session helper)."""
    base = F.try_variant_get(F.try_parse_json(_c(payload)), "$", "map<string,variant>")
    return F.to_json(F.map_concat(base, F.transform_values(overrides, lambda _, v: v.cast("variant"))))


def json_reject(payload: Column | str) -> Column:
    """Why a payload can't be an event: 'null', 'not JSON' or 'not an object'; NULL for one that can."""
    text = _c(payload)
    opens = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    closes = F.rtrim(text, F.lit(" \t\r\n")).endswith("}")  # nothing after the object
    broken = F.try_parse_json(text).isNull() | (opens & ~closes)
    return F.when(text.isNull(), F.lit("null")).when(broken, F.lit("not JSON")).when(~opens, F.lit("not an object"))


def checked_json(c: Column | str) -> Column:
    """The text itself; a text that isn't JSON fails the job (a JSONB column cannot hold it)."""
    text = _c(c)
    broken = text.isNotNull() & F.try_parse_json(text).isNull()
    return F.when(broken, F.raise_error(F.concat(F.lit("not JSON: "), F.substring(text, 1, 200)))).otherwise(text)
