"""Heuristic risk score v1 (OP-55) and the class-mean model scorer (OP-56/57).

Both are plain column expressions: no Python UDF, everything stays inside
whole-stage codegen.  The model row is a one-row DataFrame, cross-joined
with a broadcast hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_signals.functions.numeric import safe_ratio, sigmoid, tolerant_float

# Fixed values of the heuristic (weights and band cut-offs).
W_COUNT_15M = 12.0
W_COUNT_1H = 3.0
W_LOG_GMV_15M = 15.0
W_LOG_GMV_1H = 5.0
W_BURST = 40.0
SCORE_CAP = 100.0
V1_HIGH = 80.0
V1_MEDIUM = 50.0
MODEL_HIGH = 0.80
MODEL_MEDIUM = 0.50
PRIOR_CLAMP = 1e-6
MODEL_VERSION = "risk_model_latest"


def v1_raw_score(c15: Column, g15: Column, c1h: Column, g1h: Column) -> Column:
    """Unrounded heuristic score (double)."""
    d = lambda c: c.cast("double")
    return F.least(
        F.lit(SCORE_CAP),
        F.lit(W_COUNT_15M) * d(c15)
        + F.lit(W_COUNT_1H) * d(c1h)
        + F.lit(W_LOG_GMV_15M) * F.ln(F.lit(1.0) + F.greatest(F.lit(0.0), d(g15)))
        + F.lit(W_LOG_GMV_1H) * F.ln(F.lit(1.0) + F.greatest(F.lit(0.0), d(g1h)))
        + F.lit(W_BURST) * F.least(F.lit(1.0), safe_ratio(c15, c1h)),
    )


def band(score: Column, high: float, medium: float) -> Column:
    return F.when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def risk_score_v1(features: DataFrame) -> DataFrame:
    """Add ``risk_score_v1`` (decimal(5,2)) and ``risk_band_v1``.  The band is
    taken from the *unrounded* score (79.996 stores 80.00 but is medium)."""
    s = v1_raw_score(F.col("txn_count_15m"), F.col("gmv_usd_15m"),
                     F.col("txn_count_1h"), F.col("gmv_usd_1h"))
    return (features.withColumn("_s", s)
            .withColumn("risk_score_v1", F.round(F.col("_s"), 2).cast("decimal(5,2)"))
            .withColumn("risk_band_v1", band(F.col("_s"), V1_HIGH, V1_MEDIUM))
            .drop("_s"))


def model_score(rows: DataFrame, model: DataFrame) -> DataFrame:
    """OP-56: add ``local_model_score_raw`` (unrounded, double) and
    ``local_model_band``.

    raw = sum_f (x_f - (pm_f + nm_f)/2) * w_f ; norm = raw / max(sum |w_f|, 1)
    score = sigmoid(norm + logit(clamp(positive_rate)))

    Features are those that the model lists (a one-row control value); a feature
    without statistics counts 0, a missing column reads as 0.0.  Values go through
    the tolerant reader (NULL, '' and 'null' -> 0.0)."""
    feature_columns = list(model.select("feature_columns").first()[0])
    # Flatten the one-row model into plain columns first, so the per-row work
    # is arithmetic on broadcast constants (no map lookups per row).
    flat = []
    for i, f in enumerate(feature_columns):
        st = F.col("feature_stats").getItem(f)
        flat += [F.coalesce(st.getField("positive_mean"), F.lit(0.0)).alias(f"_pm{i}"),
                 F.coalesce(st.getField("negative_mean"), F.lit(0.0)).alias(f"_nm{i}"),
                 F.coalesce(st.getField("weight"), F.lit(0.0)).alias(f"_w{i}")]
    m = model.select("positive_rate", *flat)
    j = rows.crossJoin(F.broadcast(m))
    raw = F.lit(0.0)
    scale = F.lit(0.0)
    for i, f in enumerate(feature_columns):
        x = tolerant_float(f) if f in rows.columns else F.lit(0.0)
        raw = raw + (x - (F.col(f"_pm{i}") + F.col(f"_nm{i}")) / F.lit(2.0)) * F.col(f"_w{i}")
        scale = scale + F.abs(F.col(f"_w{i}"))
    p = F.col("positive_rate").cast("double")
    prior = F.ln(F.greatest(p, F.lit(PRIOR_CLAMP)) / F.greatest(F.lit(1.0) - p, F.lit(PRIOR_CLAMP)))
    score = sigmoid(raw / F.greatest(scale, F.lit(1.0)) + prior)
    return (j.withColumn("local_model_score_raw", score)
            .withColumn("local_model_band", band(F.col("local_model_score_raw"), MODEL_HIGH, MODEL_MEDIUM))
            .drop("positive_rate", *[c for c in m.columns if c.startswith("_")]))


def persist_scores(rows: DataFrame, model: DataFrame, scored_at: Column,
                   version: str = MODEL_VERSION) -> DataFrame:
    """OP-57: keyed score rows ready to write back: score rounded to 5 places
    as decimal(6,5), band, version (artifact name), scored-at time."""
    s = model_score(rows, model)
    return s.select(
        "merchant_id", "snapshot_time_utc",
        F.round(F.col("local_model_score_raw"), 5).cast("decimal(6,5)").alias("local_model_score"),
        "local_model_band",
        F.lit(version).alias("local_model_version"),
        scored_at.cast("timestamp").alias("local_model_scored_at_utc"),
    )
