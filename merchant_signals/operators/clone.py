"""Event cloning for end-to-end and duplicate checks (OP-46 + OP-71).

The reference's scripts take a template payload, give it fresh ids
(``prefix || substr(md5(...), 1, 32)``) and fresh event / ingest times via a
top-level JSON merge, insert it, then insert the very same payload again
(shipped through base64) to prove that the duplicate adds no fact.  Here the
ids derive from ``md5`` of a seed column instead of ``random()`` so reruns
are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_signals.functions.json import has_key, json_merge
from merchant_signals.functions.time import iso_utc

# The id fields a clone renews, with their prefixes.
CLONE_ID_FIELDS = [
    ("event_id", "evt_"),
    ("order_id", "ord_"),
    ("trace_id", "tr_"),
    ("correlation_id", "cor_"),
    ("capture_id", "cap_"),
]


#: Keys that a payload needs to serve as a template.
TEMPLATE_KEYS = ("event_id", "event_type", "merchant_id")
#: Raw ids that the search for templates looks at first; each further range is twice as long.
FIRST_RANGE = 4096


def newest_templates(raw: DataFrame, first_range: int = FIRST_RANGE) -> DataFrame:
    """OP-46: each source's newest raw row whose payload has all TEMPLATE_KEYS.

    Searched from the newest end: ranges of raw ids, each twice as long as the one before, with literal bounds and only
    the sources that still lack a template, so that older files aren't read and no payload is parsed twice.  A source
    without any template is searched to its end.  The driver holds one raw id a source.  No rows for an empty table."""
    ends = raw.groupBy("source").agg(F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi")).collect()
    found, open_, span = [], {r["source"]: (r["lo"], r["hi"]) for r in ends}, first_range
    hi = max((r["hi"] for r in ends), default=0)
    ok = F.lit(True)
    for key in TEMPLATE_KEYS:
        ok = ok & has_key("payload", key)
    while open_:
        lo = hi - span
        got = (raw.filter((F.col("raw_id") > F.lit(lo)) & (F.col("raw_id") <= F.lit(hi)) & _is_in("source", open_)).filter(ok)
               .groupBy("source").agg(F.max("raw_id").alias("raw_id")).collect())
        found += [(r["source"], r["raw_id"]) for r in got]
        done = {r["source"] for r in got}
        open_ = {s: b for s, b in open_.items() if s not in done and b[0] <= lo}
        hi = min(lo, max((b[1] for b in open_.values()), default=lo))
        span *= 2
    ids = [i for _, i in found]
    rows = raw.filter(F.col("raw_id").isin(ids) if ids else F.lit(False))
    pair = F.lit(False)
    for source, i in found:
        pair = pair | (F.col("source").eqNullSafe(F.lit(source)) & (F.col("raw_id") == F.lit(i)))
    return rows.filter(pair)


def _is_in(name: str, values) -> Column:
    named = F.col(name).isin([v for v in values if v is not None])
    return (named | F.col(name).isNull()) if None in values else named


def new_id(prefix: str, seed: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat(F.lit(prefix), seed.cast("string"))), 1, 32))


def clone_payloads(raw: DataFrame, at: Column, seed: Column | None = None) -> DataFrame:
    """Raw rows -> cloned raw rows (same source, new ids, event and ingest
    time ``at``)."""
    s = seed if seed is not None else F.col("raw_id")
    kv = []
    for field, prefix in CLONE_ID_FIELDS:
        kv += [F.lit(field), new_id(prefix, s)]
    ts = iso_utc(at, 3)
    kv += [F.lit("event_time_utc"), ts, F.lit("ingested_at_utc"), ts]
    return raw.select(F.col("raw_id").alias("template_raw_id"), "source",
                      json_merge("payload", F.create_map(*kv)).alias("payload"),
                      at.alias("received_at"))


def via_base64(payload: Column) -> Column:
    """The transport the duplicate check uses: encode, strip line breaks, decode."""
    b64 = F.regexp_replace(F.base64(F.encode(payload, "UTF-8")), r"[\n\r]+", "")
    return F.decode(F.unbase64(b64), "UTF-8")


def recent_second(now: Column, seconds: int = 30) -> Column:
    """The event time that manual clones get: some seconds ago, in whole seconds."""
    return F.date_trunc("second", now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds)))


def clone_line(event_id: Column, merchant_id: Column) -> Column:
    """What the check scripts print for a clone; NULL parts are left out."""
    return F.concat_ws(" ", event_id, merchant_id)
