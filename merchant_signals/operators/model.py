"""Class-conditional mean model (OP-36) as one combinable aggregation.

For each feature: positive_mean / negative_mean over rows with
label >= 1.0 / < 1.0 (0.0 for an empty class) and weight = their difference.
The model is a one-row DataFrame:
  model_type, target_column, feature_columns array<string>, training_rows,
  positive_rows, negative_rows, positive_rate,
  feature_stats map<string, struct<positive_mean, negative_mean, weight>>
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.functions.numeric import tolerant_float
from merchant_signals.schemas import FEATURE_COLUMNS, TARGET_COLUMN

MODEL_TYPE = "baseline_mean_difference"
REQUIRED_KEYS = ("feature_columns", "feature_stats", "positive_rate")


def train(rows: DataFrame, feature_columns: list[str] = FEATURE_COLUMNS,
          target: str = TARGET_COLUMN) -> DataFrame:
    """One pass, map-side combined.  Missing columns read as 0.0."""
    have = set(rows.columns)
    x = {f: tolerant_float(f) if f in have else F.lit(0.0) for f in feature_columns}
    y = tolerant_float(target) if target in have else F.lit(0.0)
    pos = y >= 1.0
    aggs = [F.count(F.lit(1)).alias("training_rows"),
            F.count_if(pos).alias("positive_rows"),
            F.count_if(~pos).alias("negative_rows")]
    for f in feature_columns:
        aggs += [F.coalesce(F.avg(F.when(pos, x[f])), F.lit(0.0)).alias(f"_pm_{f}"),
                 F.coalesce(F.avg(F.when(~pos, x[f])), F.lit(0.0)).alias(f"_nm_{f}")]
    a = rows.agg(*aggs)
    stats = F.create_map(*[
        item for f in feature_columns for item in (
            F.lit(f),
            F.struct(F.col(f"_pm_{f}").alias("positive_mean"), F.col(f"_nm_{f}").alias("negative_mean"),
                     (F.col(f"_pm_{f}") - F.col(f"_nm_{f}")).alias("weight")))])
    return a.select(
        F.lit(MODEL_TYPE).alias("model_type"),
        F.lit(target).alias("target_column"),
        F.array(*[F.lit(f) for f in feature_columns]).alias("feature_columns"),
        F.col("training_rows").cast("long"), F.col("positive_rows").cast("long"),
        F.col("negative_rows").cast("long"),
        F.coalesce(F.try_divide(F.col("positive_rows").cast("double"), F.col("training_rows").cast("double")),
                   F.lit(0.0)).alias("positive_rate"),
        stats.alias("feature_stats"),
    )


def require_rows(model: DataFrame) -> DataFrame:
    """The reference refuses an empty training set; one-row control check."""
    n = model.select("training_rows").first()
    if n is None or n[0] == 0:
        raise ValueError("no rows to train on")
    return model


def stats_long(model: DataFrame) -> DataFrame:
    """One row per feature (for reports and comparisons)."""
    e = model.select("training_rows", "positive_rows", "negative_rows", "positive_rate",
                     F.explode("feature_stats").alias("feature", "s"))
    return e.select("feature", "training_rows", "positive_rows", "negative_rows", "positive_rate",
                    F.col("s.positive_mean").alias("positive_mean"),
                    F.col("s.negative_mean").alias("negative_mean"),
                    F.col("s.weight").alias("weight"))


def save(model: DataFrame, path: str) -> str:
    """OP-12: the artifact is a one-row Parquet file (no pickle)."""
    model.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load(spark, path: str) -> DataFrame:
    """OP-12: load and check the contract keys."""
    m = spark.read.parquet(path)
    missing = sorted(set(REQUIRED_KEYS) - set(m.columns))
    if missing:
        raise ValueError(f"the stored model lacks {', '.join(missing)}")
    return m
