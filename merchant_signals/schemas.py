"""Table schemas: one superset per table (the reference has two DDL owners
that disagree; we keep the union, every column but the key nullable)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

RAW = T.StructType([
    T.StructField("raw_id", T.LongType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("payload", T.StringType(), False),
    T.StructField("received_at", T.TimestampType(), False),
])

WATERMARK = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("last_raw_id", T.LongType(), False),
])

# Minimal fact table plus the label and lineage columns.
FACT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time_utc", T.TimestampType()),
    T.StructField("ingested_at_utc", T.TimestampType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("amount_usd", MONEY),
    T.StructField("status", T.StringType()),
    T.StructField("label_bad_outcome", T.IntegerType()),
    T.StructField("label_anomaly", T.IntegerType()),
    T.StructField("label_dispute_lost", T.IntegerType()),
    T.StructField("raw_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("payload", T.StringType()),
    # further columns of the fact file; NULL for facts from raw events
    T.StructField("payer_id_hash", T.StringType()),
    T.StructField("merchant_country", T.StringType()),
    T.StructField("merchant_mcc", T.StringType()),
    T.StructField("drift_regime_id", T.IntegerType()),
])
FACT_COLUMNS = [f.name for f in FACT.fields]
FACT_FILE_COLUMNS = ["payer_id_hash", "merchant_country", "merchant_mcc", "drift_regime_id"]

# The contract's column names and order.
# 14 positional columns of the fact CSV (historical / object-store loads).
FACT_CSV14 = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_time_utc", T.TimestampType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("amount_usd", MONEY),
    T.StructField("payer_id_hash", T.StringType()),
    T.StructField("merchant_country", T.StringType()),
    T.StructField("merchant_mcc", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("ingested_at_utc", T.TimestampType()),
    T.StructField("label_bad_outcome", T.IntegerType()),
    T.StructField("drift_regime_id", T.IntegerType()),
])

# 22 positional columns of the merchant dimension CSV.
DIM_CSV22 = T.StructType([
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("onboarding_date", T.DateType()),
    T.StructField("merchant_segment", T.StringType()),
    T.StructField("mcc", T.StringType()),
    T.StructField("industry_name", T.StringType()),
    T.StructField("risk_tier", T.StringType()),
    T.StructField("kyc_status", T.StringType()),
    T.StructField("account_status", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("fee_plan_id", T.StringType()),
    T.StructField("processor_fee_rate", T.DecimalType(9, 4)),
    T.StructField("fixed_fee", MONEY),
    T.StructField("settlement_schedule", T.StringType()),
    T.StructField("payout_frequency", T.StringType()),
    T.StructField("payout_method", T.StringType()),
    T.StructField("reserve_rate", T.DecimalType(9, 4)),
    T.StructField("avg_order_value_usd_est", MONEY),
    T.StructField("avg_daily_txn_est", T.IntegerType()),
    T.StructField("created_at_utc", T.TimestampType()),
])
DIM_COLUMNS = [f.name for f in DIM_CSV22.fields]
# The dimension table: the file's 22 columns and the time of the first insert.
DIM = T.StructType([*DIM_CSV22.fields, T.StructField("created_at", T.TimestampType())])

FEATURE_COLUMNS = ["txn_count_15m", "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h", "risk_score_v1"]
TARGET_COLUMN = "label_bad_outcome_24h"

SNAPSHOT_KEY = ["merchant_id", "snapshot_time_utc"]
SNAPSHOT_FEATURES = ["txn_count_15m", "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h",
                     "risk_score_v1", "risk_band_v1"]
MODEL_COLUMNS = ["local_model_score", "local_model_band", "local_model_version",
                 "local_model_scored_at_utc"]
SNAPSHOT_COLUMNS = SNAPSHOT_KEY + ["computed_at_utc"] + SNAPSHOT_FEATURES + MODEL_COLUMNS

TRAINING_COLUMNS = ["merchant_id", "snapshot_time_utc", "computed_at_utc", "txn_count_15m",
                    "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h", "risk_score_v1", "risk_band_v1",
                    "label_bad_outcome_24h", "label_anomaly_24h", "label_dispute_lost_24h"]
