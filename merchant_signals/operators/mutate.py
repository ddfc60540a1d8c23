"""Table mutation without MERGE (OP-03, 13, 24, 25, 26).

Plain Parquet has no in-place update, so every mutation returns the *new
state* of the table as a DataFrame; the caller writes it to a fresh version
(``sources.store``) and never reads and overwrites one path in a single plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from merchant_signals.schemas import MODEL_COLUMNS, SNAPSHOT_KEY


def insert_if_absent(target: DataFrame, rows: DataFrame, exists: Column | None = None,
                     key: list[str] | None = None) -> DataFrame:
    """OP-03: append ``rows`` only when no target row matches.

    With ``key``: per-key NOT EXISTS (a left-anti join).  With ``exists``: a
    predicate over the whole target; the seed goes in only if no target row
    satisfies it (one boolean aggregate)."""
    if key is not None:
        return target.unionByName(rows.join(target.select(*key), key, "left_anti"),
                                  allowMissingColumns=True)
    flag = target.agg(F.count_if(exists).alias("_n"))
    add = rows.crossJoin(F.broadcast(flag)).filter(F.col("_n") == 0).drop("_n")
    return target.unionByName(add, allowMissingColumns=True)


def assert_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """OP-24 precondition: a key that is repeated within one input or has a NULL
    aborts the load (one aggregate, returns the input unchanged)."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    dup = df.groupBy(*key).count().filter((F.col("count") > 1) | missing).limit(1).collect()
    if dup:
        raise ValueError(f"key {key} repeated or missing in input: {dup[0].asDict()}")
    return df


def upsert_last_state(target: DataFrame, src: DataFrame, key: list[str]) -> DataFrame:
    """OP-24: every column of ``src`` replaces that of a matched row (``DO UPDATE
    SET`` all), columns that only the target has stay; new keys are inserted,
    untouched rows stay."""
    assert_unique(src, key)
    kept = target.join(src.select(*key), key, "left_anti")
    own = [c for c in target.columns if c not in src.columns]
    new = src.join(target.select(*key, *own), key, "left") if own else src
    return kept.unionByName(new.select(*target.columns))


def upsert_snapshots(target: DataFrame, src: DataFrame,
                     carried: list[str] = MODEL_COLUMNS) -> DataFrame:
    """OP-25: recomputed snapshot rows replace features and heuristic, the
    model columns of an existing row are carried over (now stale), rows not
    recomputed stay as they are (no delete)."""
    new = src.select(F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in src.columns if c not in carried])
    on = [F.col(c) == F.col(f"_{c}") for c in SNAPSHOT_KEY]
    both = target.join(new, on, "full")  # src is computed once, each side moves once
    return both.select(*[F.col(c) if c in carried else F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
                         for c in target.columns])


def update_columns(target: DataFrame, updates: DataFrame, key: list[str],
                   columns: list[str]) -> DataFrame:
    """OP-26: keyed column update; unmatched target rows keep their values,
    update rows without a target row are ignored."""
    u = updates.select(*key, *[F.col(c).alias(f"_u_{c}") for c in columns]).withColumn("_hit", F.lit(True))
    j = target.join(u, key, "left")
    for c in columns:
        j = j.withColumn(c, F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)))
    return j.select(*target.columns)


def upgrade_schema(df: DataFrame, schema: StructType, defaults: dict | None = None,
                   backfill: dict[str, Column] | None = None) -> DataFrame:
    """OP-13: add missing columns (``ADD COLUMN IF NOT EXISTS`` with a default)
    and backfill NULLs (``UPDATE ... WHERE c IS NULL``)."""
    defaults = defaults or {}
    out = df
    for f in schema.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(defaults.get(f.name)).cast(f.dataType))
    for c, expr in (backfill or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), expr))
    return out.select(*[f.name for f in schema.fields],
                      *[c for c in out.columns if c not in schema.fieldNames()])
