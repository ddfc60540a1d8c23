"""Merchant-risk signals as Spark DataFrame / Structured Streaming jobs.

Raw JSON payment events are loaded incrementally (first-wins, per-source
raw-id watermark) into a typed fact table, rolled up into point-in-time
merchant features over sliding 15-minute / 1-hour windows, scored by a
heuristic and by a class-mean model, labelled with the next 24 hours of
outcomes, exported as a training set and backtested.

Every operator is a ``DataFrame -> DataFrame`` function; nothing reaches
the driver except one-row control values.
"""

from merchant_signals.session import ensure_session, get_spark

__all__ = ["ensure_session", "get_spark"]
