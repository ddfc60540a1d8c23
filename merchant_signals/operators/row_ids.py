"""OP-04: dense, ordered row ids without an un-partitioned window.

``row_number() OVER (ORDER BY k)`` funnels every row into one task.  Instead:
range-partition and sort on ``k`` (distributed), tag rows with
``monotonically_increasing_id`` (partition index in the high bits, position
in the low 33 bits), count rows per partition (one tiny row per partition),
turn the counts into running offsets and add them back.  The offsets table
has exactly one row per partition, so broadcasting it is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchant_signals.session import temp_table

_LOW_BITS = 33


def dense_row_id(df: DataFrame, order_by: list[str], id_col: str = "row_id", start: int = 1) -> DataFrame:
    """Add ``id_col`` = 1-based position of each row in ``order_by`` order.

    ``order_by`` must be unique per row for a deterministic answer (the
    reference orders by (event_time_utc, event_id)).  The sorted rows are
    written once (``session.temp_table``): the counts and the ids then read the
    same partitions, whatever adaptive execution made of the shuffle."""
    ordered = (df.repartitionByRange(*[F.col(c) for c in order_by])
               .sortWithinPartitions(*order_by)
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = temp_table(ordered.select(
        "*",
        F.shiftright("_mid", _LOW_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).alias("_pos"),
    ).drop("_mid"), "row-ids")
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna({"_off": 0})
    # one row per shuffle partition
    out = (ordered.join(F.broadcast(offsets), "_pid")
           .withColumn(id_col, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
           .drop("_pid", "_pos", "_off"))
    out._temp_path = ordered._temp_path  # session.release_temp(spark, out) once what reads it is written
    return out
