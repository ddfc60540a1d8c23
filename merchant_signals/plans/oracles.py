"""DuckDB oracle SQL for the registered queries.

The oracles restate the fixture mapping of ``sources/driver.py`` directly in
SQL (no JSON round trip) and compute every operator the literal way the
reference defines it: range joins instead of sliding windows, ROW_NUMBER
instead of partition offsets, and so on.  Output conventions match
``plans.views.for_compare``: decimals as DOUBLE, doubles rounded to 6 places,
timestamps as zone-less TIMESTAMP.
"""

from __future__ import annotations

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def floor15(x: str) -> str:
    return f"time_bucket(INTERVAL 15 MINUTE, {x}, {EPOCH})"


def next15(x: str) -> str:
    return f"({floor15(x)} + INTERVAL 15 MINUTE)"


def ceil15(x: str) -> str:
    return f"({floor15(f'{x} - INTERVAL 1 MICROSECOND')} + INTERVAL 15 MINUTE)"


AMOUNT = """CASE WHEN event_id % 53 = 0 THEN NULL
              WHEN event_type = 'error' AND event_id % 7 = 0 THEN -CAST(value AS DECIMAL(18,2))
              ELSE CAST(value AS DECIMAL(18,2)) END"""
STATUS = "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'captured' END"
MERCHANT = "'m_' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0')"

# Raw rows, before the JSON encoding: originals plus the duplicate copies.
RAW_ROWS = f"""
ev AS (
  SELECT event_id AS eid, ts, user_id, event_type, value, {AMOUNT} AS amt,
         ts + to_minutes(CAST(event_id % 90 AS BIGINT)) AS received_at
  FROM events
),
raw_rows AS (
  SELECT eid + 1 AS raw_id, eid, ts, user_id, event_type, value, amt AS amount_usd, received_at FROM ev
  UNION ALL
  SELECT eid + 1 + (SELECT max(event_id) + 1 FROM events), eid, ts, user_id, event_type, value,
         CAST(amt + 1 AS DECIMAL(18,2)), received_at + INTERVAL 31 DAY
  FROM ev WHERE eid % 10 = 0
)"""

# Facts loaded from raw: merchant filter, typed projection, first wins.
LIVE_FACTS = RAW_ROWS + f""",
live_typed AS (
  SELECT CASE WHEN eid % 101 = 0 THEN 'raw_' || CAST(raw_id AS VARCHAR)
              ELSE 'evt_' || CAST(eid AS VARCHAR) END AS event_id,
         event_type, ts AS event_time_utc, ts + to_minutes(CAST(eid % 90 AS BIGINT)) AS ingested_at_utc,
         {MERCHANT} AS merchant_id, 'ord_' || CAST(eid AS VARCHAR) AS order_id,
         amount_usd, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'captured' END AS status,
         raw_id, 'SYNTH_LIVE' AS source, received_at
  FROM raw_rows WHERE eid % 97 <> 0
),
live_facts AS (
  SELECT * FROM live_typed
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY raw_id) = 1
)"""

HIST_FACTS = f"""
hist_facts AS (
  SELECT 'evt_' || CAST(event_id AS VARCHAR) AS event_id, event_type,
         ts AS event_time_utc, ts AS ingested_at_utc, {MERCHANT} AS merchant_id,
         'ord_' || CAST(event_id AS VARCHAR) AS order_id, {AMOUNT} AS amount_usd, {STATUS} AS status,
         CAST(event_type = 'error' AS INTEGER) AS label_bad_outcome,
         CAST(value > 250 AS INTEGER) AS label_anomaly,
         CAST(event_type = 'error' AND event_id % 3 = 0 AS INTEGER) AS label_dispute_lost,
         event_id + 1 AS raw_id, 'SYNTHETIC_HISTORICAL' AS source, ts AS received_at
  FROM events
)"""


def features_cte(facts: str, name: str = "feat", guard: bool = True, where_t: str = "") -> str:
    """Brute-force OP-31: candidate (merchant, T) pairs, then the literal
    range join of the reference for every candidate."""
    g = "AND f.ingested_at_utc < c.T" if guard else ""
    wt = f"WHERE {where_t}" if where_t else ""
    return f"""
{name}_cand AS (
  SELECT * FROM (
    SELECT DISTINCT merchant_id,
           {floor15('event_time_utc')} + to_minutes(15 * k) AS T
    FROM {facts}, range(1, 5) r(k)) x {wt}
),
{name} AS (
  SELECT c.merchant_id, c.T AS snapshot_time_utc,
    CAST(count(*) FILTER (WHERE f.event_time_utc >= c.T - INTERVAL 15 MINUTE) AS INTEGER) AS txn_count_15m,
    CAST(COALESCE(sum(f.amount_usd) FILTER (WHERE f.event_time_utc >= c.T - INTERVAL 15 MINUTE), 0)
         AS DECIMAL(18,2)) AS gmv_usd_15m,
    CAST(count(*) AS INTEGER) AS txn_count_1h,
    CAST(COALESCE(sum(f.amount_usd), 0) AS DECIMAL(18,2)) AS gmv_usd_1h
  FROM {name}_cand c JOIN {facts} f
    ON f.merchant_id = c.merchant_id
   AND f.event_time_utc >= c.T - INTERVAL 1 HOUR AND f.event_time_utc < c.T {g}
  GROUP BY 1, 2
)"""


V1_SCORE = """least(100.0,
    12.0 * CAST(txn_count_15m AS DOUBLE) + 3.0 * CAST(txn_count_1h AS DOUBLE)
    + 15.0 * ln(1.0 + greatest(0.0, CAST(gmv_usd_15m AS DOUBLE)))
    + 5.0 * ln(1.0 + greatest(0.0, CAST(gmv_usd_1h AS DOUBLE)))
    + 40.0 * least(1.0, COALESCE(CAST(txn_count_15m AS DOUBLE) / NULLIF(CAST(txn_count_1h AS DOUBLE), 0.0), 0.0)))"""


def scored_cte(feat: str, name: str = "scored", computed_at: str = NOW) -> str:
    return f"""
{name}_raw AS (SELECT *, CAST({V1_SCORE} AS DOUBLE) AS _s FROM {feat}),
{name} AS (
  SELECT merchant_id, snapshot_time_utc, {computed_at} AS computed_at_utc,
         txn_count_15m, gmv_usd_15m, txn_count_1h, gmv_usd_1h,
         CAST(round(_s, 2) AS DECIMAL(5,2)) AS risk_score_v1,
         CASE WHEN _s >= 80 THEN 'high' WHEN _s >= 50 THEN 'medium' ELSE 'low' END AS risk_band_v1
  FROM {name}_raw
)"""


SNAP_OUT = """merchant_id, snapshot_time_utc, txn_count_15m, CAST(gmv_usd_15m AS DOUBLE) AS gmv_usd_15m,
       txn_count_1h, CAST(gmv_usd_1h AS DOUBLE) AS gmv_usd_1h"""
SCORED_OUT = SNAP_OUT + """, computed_at_utc, CAST(risk_score_v1 AS DOUBLE) AS risk_score_v1, risk_band_v1"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


ORACLES: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        ORACLES[name] = fn()
        return fn
    return deco


@oracle("merchant_features")
def _():
    return with_(LIVE_FACTS, features_cte("live_facts")) + f"\nSELECT {SNAP_OUT} FROM feat"


@oracle("risk_score_v1")
def _():
    return (with_(LIVE_FACTS, features_cte("live_facts"), scored_cte("feat"))
            + f"\nSELECT {SCORED_OUT} FROM scored")


# ---- buckets and snapshots -------------------------------------------------

@oracle("time_buckets")
def _():
    return (f"SELECT event_id, ts, {floor15('ts')} AS floor15, {ceil15('ts')} AS ceil15, "
            f"{next15('ts')} AS next15 FROM events")


@oracle("bucket_series")
def _():
    return with_(HIST_FACTS) + f"""
SELECT unnest(generate_series({next15('min(event_time_utc)')}, {next15('max(event_time_utc)')},
       INTERVAL 15 MINUTE)) AS snapshot_time_utc FROM hist_facts"""


@oracle("snapshot_backfill")
def _():
    return with_(HIST_FACTS, features_cte("hist_facts", "hfeat")) + f"""
, b AS (SELECT {next15('min(event_time_utc)')} AS lo, {next15('max(event_time_utc)')} AS hi FROM hist_facts)
SELECT CAST(date_diff('minute', lo, hi) / 15 + 1 AS BIGINT) AS bucket_count,
       (SELECT count(*) FROM hfeat WHERE snapshot_time_utc <= (SELECT hi FROM b)) AS snapshot_rows_upserted
FROM b"""


@oracle("latest_features")
def _():
    return (with_(LIVE_FACTS, features_cte("live_facts"), scored_cte("feat"))
            + f"\nSELECT {SCORED_OUT} FROM scored "
              "QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY snapshot_time_utc DESC) = 1")


ORACLES["latest_kept"] = ORACLES["latest_features"]

# The stored snapshots of the historical seed: buckets up to next15(max) only (OP-53).
HIST_SNAPS = features_cte("hist_facts", "hfall") + f""",
hfeat AS (SELECT * FROM hfall WHERE snapshot_time_utc <= (SELECT {next15('max(event_time_utc)')} FROM hist_facts))""" + (
    "," + scored_cte("hfeat", "hsnap").strip("\n"))


@oracle("backfill_rows")
def _():
    return with_(HIST_FACTS, HIST_SNAPS) + f"\nSELECT {SCORED_OUT} FROM hsnap"


# ---- labels, training set, model, backtest ---------------------------------

TRAINING_SET = with_(HIST_FACTS, HIST_SNAPS) + f""",
hbounds AS (
  SELECT greatest({next15('min(event_time_utc)')}, {NOW} - INTERVAL 30 DAY) AS s,
         least({next15('max(event_time_utc)')}, {NOW} - INTERVAL 24 HOUR) AS e
  FROM hist_facts
),
tset AS (
  SELECT s.merchant_id, s.snapshot_time_utc, s.computed_at_utc, s.txn_count_15m, s.gmv_usd_15m,
         s.txn_count_1h, s.gmv_usd_1h, s.risk_score_v1, s.risk_band_v1,
         CAST(COALESCE(MAX(COALESCE(f.label_bad_outcome, 0)), 0) AS INTEGER) AS label_bad_outcome_24h,
         CAST(COALESCE(MAX(COALESCE(f.label_anomaly, 0)), 0) AS INTEGER) AS label_anomaly_24h,
         CAST(COALESCE(MAX(COALESCE(f.label_dispute_lost, 0)), 0) AS INTEGER) AS label_dispute_lost_24h
  FROM hsnap s CROSS JOIN hbounds b
  LEFT JOIN hist_facts f
    ON f.merchant_id = s.merchant_id
   AND f.event_time_utc >= s.snapshot_time_utc
   AND f.event_time_utc < s.snapshot_time_utc + INTERVAL 24 HOUR
  WHERE s.snapshot_time_utc >= b.s AND s.snapshot_time_utc < b.e
    AND s.snapshot_time_utc + INTERVAL 24 HOUR <= {NOW}
  GROUP BY ALL
)"""

TSET_OUT = SCORED_OUT + ", label_bad_outcome_24h, label_anomaly_24h, label_dispute_lost_24h"
FEATURES = ["txn_count_15m", "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h", "risk_score_v1"]


def model_cte(rows: str, name: str = "mdl") -> str:
    """One row: n, pos, neg, p, and pm_/nm_/w_ per feature."""
    parts = []
    for f in FEATURES:
        parts.append(f"COALESCE(avg(CAST({f} AS DOUBLE)) FILTER (WHERE CAST(label_bad_outcome_24h AS DOUBLE) >= 1.0), 0.0) AS pm_{f}")
        parts.append(f"COALESCE(avg(CAST({f} AS DOUBLE)) FILTER (WHERE CAST(label_bad_outcome_24h AS DOUBLE) < 1.0), 0.0) AS nm_{f}")
    return f"""
{name}_a AS (
  SELECT count(*) AS n,
         count(*) FILTER (WHERE CAST(label_bad_outcome_24h AS DOUBLE) >= 1.0) AS pos,
         count(*) FILTER (WHERE CAST(label_bad_outcome_24h AS DOUBLE) < 1.0) AS neg,
         {', '.join(parts)}
  FROM {rows}
),
{name} AS (
  SELECT *, COALESCE(CAST(pos AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0.0), 0.0) AS p,
         {', '.join(f'pm_{f} - nm_{f} AS w_{f}' for f in FEATURES)}
  FROM {name}_a
)"""


def model_long(name: str = "mdl") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, n AS training_rows, pos AS positive_rows, neg AS negative_rows, "
        f"round(p, 6) AS positive_rate, round(pm_{f}, 6) AS positive_mean, round(nm_{f}, 6) AS negative_mean, "
        f"round(w_{f}, 6) AS weight FROM {name}" for f in FEATURES)


def model_score_expr(m: str = "m") -> str:
    raw = " + ".join(f"(COALESCE(CAST({f} AS DOUBLE), 0.0) - ({m}.pm_{f} + {m}.nm_{f}) / 2.0) * {m}.w_{f}"
                     for f in FEATURES)
    scale = " + ".join(f"abs({m}.w_{f})" for f in FEATURES)
    z = (f"(({raw}) / greatest({scale}, 1.0) + "
         f"ln(greatest({m}.p, 1e-6) / greatest(1.0 - {m}.p, 1e-6)))")
    return f"CASE WHEN {z} >= 0 THEN 1.0 / (1.0 + exp(-{z})) ELSE exp({z}) / (1.0 + exp({z})) END"


def band_sql(x: str, hi: float, med: float) -> str:
    return f"CASE WHEN {x} >= {hi} THEN 'high' WHEN {x} >= {med} THEN 'medium' ELSE 'low' END"


@oracle("label_24h")
def _():
    return TRAINING_SET + f"\nSELECT {TSET_OUT} FROM tset"


@oracle("training_window")
def _():
    return with_(HIST_FACTS) + f"""
SELECT greatest({next15('min(event_time_utc)')}, {NOW} - INTERVAL 30 DAY) AS snapshot_start_utc,
       least({next15('max(event_time_utc)')}, {NOW} - INTERVAL 24 HOUR) AS snapshot_end_utc,
       {NOW} - INTERVAL 8 DAY AS scheduled_start_utc,
       {NOW} - INTERVAL 24 HOUR AS scheduled_end_utc
FROM hist_facts"""


@oracle("training_export")
def _():
    return with_(HIST_FACTS, HIST_SNAPS) + f"""
SELECT s.merchant_id, s.snapshot_time_utc, CAST(s.txn_count_15m AS INTEGER) AS txn_count_15m,
       CAST(s.gmv_usd_15m AS DOUBLE) AS gmv_usd_15m, s.txn_count_1h, CAST(s.gmv_usd_1h AS DOUBLE) AS gmv_usd_1h,
       s.computed_at_utc, CAST(s.risk_score_v1 AS DOUBLE) AS risk_score_v1, s.risk_band_v1,
       CAST(COALESCE(MAX(COALESCE(f.label_bad_outcome, 0)), 0) AS INTEGER) AS label_bad_outcome_24h,
       CAST(COALESCE(MAX(COALESCE(f.label_anomaly, 0)), 0) AS INTEGER) AS label_anomaly_24h,
       CAST(COALESCE(MAX(COALESCE(f.label_dispute_lost, 0)), 0) AS INTEGER) AS label_dispute_lost_24h
FROM hsnap s LEFT JOIN hist_facts f
  ON f.merchant_id = s.merchant_id AND f.event_time_utc >= s.snapshot_time_utc
 AND f.event_time_utc < s.snapshot_time_utc + INTERVAL 24 HOUR
WHERE s.snapshot_time_utc >= {NOW} - INTERVAL 8 DAY AND s.snapshot_time_utc < {NOW} - INTERVAL 24 HOUR
  AND s.snapshot_time_utc + INTERVAL 24 HOUR <= {NOW}
GROUP BY ALL"""


@oracle("train_model")
def _():
    return TRAINING_SET + "," + model_cte("tset").strip("\n") + "\n" + model_long()


ORACLES["model_roundtrip"] = ORACLES["train_model"]


@oracle("score_model")
def _():
    return TRAINING_SET + "," + model_cte("tset").strip("\n") + f""",
sc AS (SELECT t.merchant_id, t.snapshot_time_utc, {model_score_expr('m')} AS s FROM tset t CROSS JOIN mdl m)
SELECT merchant_id, snapshot_time_utc, CAST(round(s, 5) AS DOUBLE) AS local_model_score,
       {band_sql('s', 0.8, 0.5)} AS local_model_band FROM sc"""


SPLIT = """,
times AS (SELECT DISTINCT snapshot_time_utc AS t FROM tset),
nt AS (SELECT count(*) AS n FROM times),
bnd AS (
  SELECT x.t AS boundary_snapshot_time, nt.n AS n_times
  FROM (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i FROM times) x, nt
  WHERE nt.n >= 2
    AND x.i = least(greatest(CAST(floor(nt.n * CAST(0.8 AS DOUBLE)) AS BIGINT), 1), nt.n - 1)
)"""


@oracle("time_split")
def _():
    return TRAINING_SET + SPLIT + """
SELECT b.boundary_snapshot_time, b.n_times,
       count(*) FILTER (WHERE t.snapshot_time_utc < b.boundary_snapshot_time) AS train_rows,
       count(*) FILTER (WHERE t.snapshot_time_utc >= b.boundary_snapshot_time) AS test_rows
FROM tset t CROSS JOIN bnd b GROUP BY ALL"""


@oracle("backtest")
def _():
    return TRAINING_SET + SPLIT + """,
train AS (SELECT t.* FROM tset t, bnd b WHERE t.snapshot_time_utc < b.boundary_snapshot_time),
test AS (SELECT t.* FROM tset t, bnd b WHERE t.snapshot_time_utc >= b.boundary_snapshot_time),""" + model_cte("train").strip("\n") + f""",
pred AS (
  SELECT CAST(CAST(label_bad_outcome_24h AS DOUBLE) >= 1.0 AS INTEGER) AS a,
         CAST({model_score_expr('m')} >= 0.5 AS INTEGER) AS pl,
         CASE WHEN lower(trim(COALESCE(risk_band_v1, ''))) <> ''
              THEN CAST(lower(trim(risk_band_v1)) IN ('medium', 'high') AS INTEGER)
              ELSE CAST(CAST(risk_score_v1 AS DOUBLE) >= 50.0 AS INTEGER) END AS pv
  FROM test t CROSS JOIN mdl m
),
cm AS (
  SELECT 'local_model' AS predictor,
         count(*) FILTER (WHERE a = 1 AND pl = 1) AS tp, count(*) FILTER (WHERE a = 0 AND pl = 1) AS fp,
         count(*) FILTER (WHERE a = 0 AND pl = 0) AS tn, count(*) FILTER (WHERE a = 1 AND pl = 0) AS fn,
         avg(CAST(a AS DOUBLE)) AS pr
  FROM pred
  UNION ALL
  SELECT 'risk_score_v1',
         count(*) FILTER (WHERE a = 1 AND pv = 1), count(*) FILTER (WHERE a = 0 AND pv = 1),
         count(*) FILTER (WHERE a = 0 AND pv = 0), count(*) FILTER (WHERE a = 1 AND pv = 0),
         avg(CAST(a AS DOUBLE))
  FROM pred
)
SELECT predictor, tp, fp, tn, fn,
       round(COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0), 6) AS precision,
       round(COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0), 6) AS recall,
       round(COALESCE(CAST(tp + tn AS DOUBLE) / NULLIF(tp + fp + tn + fn, 0), 0.0), 6) AS accuracy,
       round(COALESCE(pr, 0.0), 6) AS positive_rate,
       (SELECT count(*) FROM tset) AS rows,
       (SELECT count(*) FROM train) AS train_rows,
       (SELECT count(*) FROM test) AS test_rows,
       (SELECT boundary_snapshot_time FROM bnd) AS boundary_snapshot_time,
       (SELECT max(snapshot_time_utc) FROM train) AS train_end_snapshot_time,
       (SELECT min(snapshot_time_utc) FROM test) AS test_start_snapshot_time
FROM cm"""


@oracle("tolerant_features")
def _():
    return with_(RAW_ROWS) + "\nSELECT raw_id, COALESCE(CAST(amount_usd AS DOUBLE), 0.0) AS amount_f FROM raw_rows"


# ---- raw -> facts ------------------------------------------------------------
# Columns that are NULL on every row come back from Spark's pandas conversion
# as float64 NaN; the oracles type them DOUBLE so both sides carry the same
# dtype and null token.

SPLIT_TS = "TIMESTAMP '2024-01-16 00:00:00'"
WM = f"wm AS (SELECT 'SYNTH_LIVE' AS source, max(raw_id) AS w FROM raw_rows WHERE received_at < {SPLIT_TS})"


@oracle("raw_valid_split")
def _():
    return with_(RAW_ROWS) + f"""
SELECT raw_id, CASE WHEN eid % 97 = 0 THEN '' ELSE {MERCHANT} END AS merchant_id,
       eid % 97 <> 0 AS is_valid FROM raw_rows"""


FACT_OUT = """event_id, event_type, event_time_utc, ingested_at_utc, merchant_id, order_id,
       CAST(amount_usd AS DOUBLE) AS amount_usd, status,
       CAST(NULL AS DOUBLE) AS label_bad_outcome, CAST(NULL AS DOUBLE) AS label_anomaly,
       CAST(NULL AS DOUBLE) AS label_dispute_lost, raw_id, source, received_at"""


@oracle("facts_from_raw")
def _():
    return with_(LIVE_FACTS) + f"\nSELECT {FACT_OUT} FROM live_typed"


@oracle("dedup_first_wins")
def _():
    return with_(LIVE_FACTS) + f"\nSELECT {FACT_OUT} FROM live_facts"


@oracle("insert_ignore")
def _():
    return with_(LIVE_FACTS, HIST_FACTS) + f""",
existing AS (SELECT event_id, source, raw_id, amount_usd, event_time_utc FROM hist_facts
             WHERE event_time_utc < {SPLIT_TS})
SELECT event_id, source, raw_id, CAST(amount_usd AS DOUBLE) AS amount_usd, event_time_utc, 'existing' AS origin
FROM existing
UNION ALL
SELECT l.event_id, l.source, l.raw_id, CAST(l.amount_usd AS DOUBLE), l.event_time_utc, 'inserted'
FROM live_facts l WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.event_id = l.event_id)"""


@oracle("new_merchants")
def _():
    return with_(RAW_ROWS) + f"""
SELECT DISTINCT {MERCHANT} AS merchant_id, CAST(NULL AS VARCHAR) AS merchant_name, {NOW} AS created_at
FROM raw_rows WHERE eid % 97 <> 0 AND {MERCHANT} <> 'm_seed_0001'"""


@oracle("load_stats")
def _():
    return with_(LIVE_FACTS) + """,
numbered AS (SELECT raw_id, (row_number() OVER (ORDER BY raw_id) - 1) // 2000 AS batch_no FROM raw_rows),
firsts AS (SELECT min(raw_id) AS raw_id FROM live_typed GROUP BY event_id),
ins AS (SELECT n.batch_no, count(*) AS c FROM firsts f JOIN numbered n USING (raw_id) GROUP BY 1),
per AS (SELECT batch_no, count(*) AS processed_rows, max(raw_id) AS updated_watermark FROM numbered GROUP BY 1)
SELECT p.batch_no, CAST(p.processed_rows AS INTEGER) AS processed_rows,
       CAST(COALESCE(i.c, 0) AS INTEGER) AS inserted_fact,
       COALESCE(lag(p.updated_watermark) OVER (ORDER BY p.batch_no), 0) AS watermark_before,
       p.updated_watermark
FROM per p LEFT JOIN ins i USING (batch_no)"""


@oracle("incremental_batch")
def _():
    return with_(RAW_ROWS, WM) + """
SELECT raw_id, 'SYNTH_LIVE' AS source, received_at FROM raw_rows, wm
WHERE raw_id > wm.w ORDER BY raw_id LIMIT 2000"""


@oracle("watermark_advance")
def _():
    return with_(LIVE_FACTS, WM) + """,
batch AS (SELECT r.raw_id FROM raw_rows r, wm WHERE r.raw_id > wm.w ORDER BY r.raw_id LIMIT 2000),
loaded AS (SELECT DISTINCT t.event_id FROM live_typed t, wm WHERE t.raw_id <= wm.w),
batch_ids AS (SELECT DISTINCT t.event_id FROM live_typed t JOIN batch b USING (raw_id))
SELECT wm.source, wm.w AS last_raw_id_before,
       CAST((SELECT count(*) FROM batch) AS INTEGER) AS processed_rows,
       CAST((SELECT count(*) FROM batch_ids x WHERE NOT EXISTS
             (SELECT 1 FROM loaded l WHERE l.event_id = x.event_id)) AS INTEGER) AS inserted_fact,
       COALESCE((SELECT max(raw_id) FROM batch), wm.w) AS updated_watermark
FROM wm"""


@oracle("ingest_lag")
def _():
    return with_(RAW_ROWS, WM) + """
SELECT wm.source, wm.w AS last_raw_id, m.m AS max_raw_id, m.m - wm.w AS new_rows, m.m > wm.w AS has_new
FROM wm, (SELECT max(raw_id) AS m FROM raw_rows) m"""


@oracle("dense_row_id")
def _():
    return with_(HIST_FACTS) + """
SELECT event_id, event_time_utc, row_number() OVER (ORDER BY event_time_utc, event_id) AS raw_id
FROM hist_facts"""


COUNTRY_LIST = "['US', 'CA', 'GB', 'DE', 'FR', 'AU', 'IN', 'BR', 'MX', 'JP']"


@oracle("historical_fact_load")
def _():
    return f"""WITH stage AS (
  SELECT 'evt_' || CAST(e.event_id AS VARCHAR) AS event_id, e.event_type, e.ts AS event_time_utc,
         'm_' || lpad(CAST(e.user_id AS VARCHAR), greatest(6, length(CAST(e.user_id AS VARCHAR)))::INTEGER, '0') AS merchant_id,
         'ord_' || CAST(e.event_id AS VARCHAR) AS order_id,
         CASE WHEN e.event_type = 'error' THEN 'failed' ELSE 'captured' END AS status,
         CASE WHEN e.event_id % 53 = 0 THEN NULL
              WHEN e.event_type = 'error' AND e.event_id % 7 = 0 THEN -CAST(e.value AS DECIMAL(18,2))
              ELSE CAST(e.value AS DECIMAL(18,2)) END AS amount_usd,
         {COUNTRY_LIST}[c.c_nationkey % 10 + 1] AS merchant_country,
         CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.event_type = 'error' AS INTEGER) END
           AS label_bad_outcome
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
)
SELECT event_id, event_type, event_time_utc, event_time_utc AS ingested_at_utc, merchant_id, order_id,
       CAST(amount_usd AS DOUBLE) AS amount_usd, status,
       CAST(COALESCE(label_bad_outcome, 0) AS INTEGER) AS label_bad_outcome,
       0 AS label_anomaly, 0 AS label_dispute_lost,
       row_number() OVER (ORDER BY event_time_utc, event_id) AS raw_id,
       'SYNTHETIC_HISTORICAL' AS source, event_time_utc AS received_at,
       merchant_country AS payload_merchant_country
FROM stage"""


# ---- enrichment ----------------------------------------------------------------

def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _mcc_pool() -> list[str]:
    from merchant_signals.sources import driver as D

    return D.MCC_POOL


def _sql_case(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default} END"


def _enrich_ctes() -> str:
    from merchant_signals.operators import enrich as E
    from merchant_signals.sources import driver as D

    seg = _sql_case("c_mktsegment", {k: f"'{v}'" for k, v in D.SEGMENT_MAP.items()}, "'SMB'")
    status = _sql_case("event_type", {k: f"'{v}'" for k, v in E.STATUS_BY_TYPE.items()}, f"'{E.UNKNOWN_STATUS}'")
    fx = _sql_case("currency", E.FX_TO_USD, E.FX_OTHER)
    refund_types = ", ".join(f"'{t}'" for t in E.REFUND_TYPES)
    dispute_types = ", ".join(f"'{t}'" for t in E.DISPUTE_TYPES)
    return f"""
pay AS (
  SELECT event_id AS event_no, 'evt_' || CAST(event_id AS VARCHAR) AS event_id,
         {_sql_list(E.EVENT_TYPES)}[event_id % 9 + 1] AS event_type, ts AS event_time_utc, user_id,
         {MERCHANT} AS merchant_id, CAST(value AS DECIMAL(18,2)) AS amount,
         {_sql_list(E.CURRENCIES)}[event_id % 5 + 1] AS currency,
         CAST({_sql_list(D.REFUND_FRACTIONS)}[event_id % 3 + 1] AS DECIMAL(9,4)) AS refund_fraction,
         CAST({_sql_list(D.DISPUTE_FEES)}[event_id % 3 + 1] AS DECIMAL(18,2)) AS dispute_fee_pick,
         CAST(event_id % 71 + 1 AS INTEGER) AS settlement_lag_hours,
         CAST(event_id % 108 + 12 AS INTEGER) AS payout_lag_hours,
         {_sql_list(D.COUNTRIES)}[(event_id // 7) % 10 + 1] AS payer_country
  FROM events
),
dim AS (
  SELECT 'm_' || lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS merchant_id, c_name AS merchant_name,
         {seg} AS merchant_segment,
         CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 3000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
         {_sql_list(D.COUNTRIES)}[c_nationkey % 10 + 1] AS country,
         {_sql_list(D.MCC_POOL)}[c_custkey % 7 + 1] AS mcc, c_custkey
  FROM customer
),
fx1 AS (
  SELECT p.*, d.merchant_segment, d.risk_tier, d.mcc, d.country, {status} AS status,
         CAST({fx} AS DECIMAL(9,4)) AS fx_rate_to_usd
  FROM pay p LEFT JOIN dim d USING (merchant_id)
),
fx2 AS (SELECT *, amount * fx_rate_to_usd AS amount_usd_exact,
               CAST(round(amount * fx_rate_to_usd, 2) AS DECIMAL(18,2)) AS amount_usd FROM fx1),
priced AS (
  SELECT *,
         CAST(CASE WHEN event_type IN ({refund_types}) THEN round(amount_usd_exact * refund_fraction, 2) ELSE 0 END
              AS DECIMAL(18,2)) AS refund_amount,
         CAST(CASE WHEN event_type IN ({dispute_types}) THEN dispute_fee_pick ELSE 0 END AS DECIMAL(18,2))
           AS dispute_fee
  FROM fx2
)"""


ENRICH = _enrich_ctes()


@oracle("event_status")
def _():
    return with_(ENRICH) + "\nSELECT event_id, event_type, status FROM fx1"


@oracle("event_flags")
def _():
    return with_(ENRICH) + """
SELECT event_id, event_type = 'PAYMENT.CAPTURE.REFUNDED' AS is_refund,
       event_type IN ('CUSTOMER.DISPUTE.CREATED', 'CUSTOMER.DISPUTE.RESOLVED') AS is_dispute,
       event_type = 'PAYMENT.CAPTURE.DENIED' AS is_denied,
       CAST(event_type = 'PAYMENT.CAPTURE.DENIED'
            OR event_type IN ('CUSTOMER.DISPUTE.CREATED', 'CUSTOMER.DISPUTE.RESOLVED')
            OR COALESCE(refund_amount > 0, false) AS INTEGER) AS label_bad_outcome
FROM priced"""


@oracle("conditional_ids")
def _():
    from merchant_signals.operators.enrich import ID_TYPES

    cols = ", ".join(
        f"CASE WHEN event_type IN ({', '.join(repr(t) for t in types)}) "
        f"THEN '{prefix}' || CAST(event_no AS VARCHAR) END AS {name}"
        for name, (prefix, types) in ID_TYPES.items())
    return with_(ENRICH) + f"\nSELECT event_id, {cols} FROM pay"


@oracle("fx_normalise")
def _():
    return with_(ENRICH) + """
SELECT event_id, currency, CAST(amount AS DOUBLE) AS amount, CAST(fx_rate_to_usd AS DOUBLE) AS fx_rate_to_usd,
       CAST(amount_usd AS DOUBLE) AS amount_usd FROM fx2"""


@oracle("fees_net")
def _():
    return with_(ENRICH) + """,
rates AS (
  SELECT *, CAST(least(greatest(
           CAST(CASE merchant_segment WHEN 'ENTERPRISE' THEN 0.022 WHEN 'MID_MARKET' THEN 0.025 ELSE 0.029 END
                AS DECIMAL(9,4))
         + CAST(CASE risk_tier WHEN 'HIGH' THEN 0.006 WHEN 'MEDIUM' THEN 0.002 ELSE 0.0 END AS DECIMAL(9,4)),
           CAST(0.015 AS DECIMAL(9,4))), CAST(0.07 AS DECIMAL(9,4))) AS DECIMAL(9,4)) AS fee_rate,
         CAST(CASE WHEN currency = 'USD' THEN 0.30 ELSE 0.35 END AS DECIMAL(18,2)) AS fixed
  FROM priced
),
fees AS (SELECT *, CAST(round(amount_usd_exact * fee_rate + fixed, 2) AS DECIMAL(18,2)) AS fee_amount FROM rates)
SELECT event_id, CAST(fee_rate AS DOUBLE) AS fee_rate, CAST(fee_amount AS DOUBLE) AS fee_amount,
       CAST(CAST(round(amount_usd_exact - fee_amount - refund_amount - CAST(0.2 AS DECIMAL(9,4)) * dispute_fee, 2)
                 AS DECIMAL(18,2)) AS DOUBLE) AS net_amount
FROM fees"""


@oracle("settlement_times")
def _():
    return with_(ENRICH) + """
SELECT event_id, status,
       CASE WHEN status = 'COMPLETED' THEN CAST(settlement_lag_hours AS DOUBLE) END AS settlement_lag_hours,
       CASE WHEN status = 'COMPLETED' THEN CAST(payout_lag_hours AS DOUBLE) END AS payout_lag_hours,
       CASE WHEN status = 'COMPLETED' THEN event_time_utc + to_hours(settlement_lag_hours) END AS settlement_time_utc,
       CASE WHEN status = 'COMPLETED' THEN event_time_utc + to_hours(payout_lag_hours) END AS payout_time_utc
FROM priced"""


@oracle("cross_border")
def _():
    return with_(ENRICH) + """
SELECT event_id, payer_country, country AS merchant_country, payer_country <> country AS is_cross_border
FROM priced"""


@oracle("drift_regime")
def _():
    return with_(ENRICH) + f"""
SELECT event_id, CAST(event_time_utc >= {NOW} - INTERVAL 15 DAY AS INTEGER) AS drift_regime_id FROM pay"""


@oracle("hash_ids")
def _():
    return with_(ENRICH) + """
SELECT event_id, sha256('payer|' || CAST(event_no AS VARCHAR)) AS payer_id_hash,
       sha256('dev|' || CAST(user_id AS VARCHAR)) AS device_id_hash,
       sha256('ip|' || CAST(event_no % 65536 AS VARCHAR)) AS ip_hash
FROM pay"""


@oracle("merchant_policy")
def _():
    from merchant_signals.operators.enrich import MCC_INDUSTRY, US_STATES

    ind = _sql_case("mcc", {k: f"'{v}'" for k, v in MCC_INDUSTRY.items()}, "NULL")
    return with_(ENRICH) + f"""
SELECT merchant_id, merchant_segment, risk_tier, mcc, country,
       CAST(CASE merchant_segment WHEN 'ENTERPRISE' THEN 0.022 WHEN 'MID_MARKET' THEN 0.025 ELSE 0.029 END
            AS DOUBLE) AS processor_fee_rate,
       CAST(CASE risk_tier WHEN 'HIGH' THEN 0.07 WHEN 'MEDIUM' THEN 0.03 ELSE 0.0 END AS DOUBLE) AS reserve_rate,
       {ind} AS industry_name,
       CASE WHEN country = 'US' THEN {_sql_list(US_STATES)}[c_custkey % 15 + 1] END AS state
FROM dim"""


@oracle("enrich_merchant")
def _():
    return with_(LIVE_FACTS, ENRICH) + """
SELECT f.event_id, f.merchant_id, f.event_time_utc, d.merchant_segment, d.risk_tier, d.mcc, d.country
FROM live_facts f LEFT JOIN dim d USING (merchant_id)"""


@oracle("anomaly_p997")
def _():
    return with_(ENRICH) + f""",
q AS (SELECT quantile_cont(CAST(amount_usd AS DOUBLE), 0.997) AS p FROM priced
      WHERE event_time_utc >= {NOW} - INTERVAL 14 DAY)
SELECT event_id, CAST(amount_usd AS DOUBLE) AS amount_usd, round(q.p, 6) AS p,
       CAST(event_time_utc >= {NOW} - INTERVAL 14 DAY AND CAST(amount_usd AS DOUBLE) > q.p AS INTEGER)
         AS label_anomaly
FROM priced, q"""


# ---- snapshot table mutation, scoring write-back ------------------------------

SCORE_LO = "TIMESTAMP '2024-01-30 22:45:00'"
SCORE_HI = "TIMESTAMP '2024-01-31 00:00:00'"
MODEL_OUT = """CAST(local_model_score AS DOUBLE) AS local_model_score, local_model_band, local_model_version,
       local_model_scored_at_utc"""


@oracle("score_window")
def _():
    return with_(HIST_FACTS, HIST_SNAPS) + f"""
SELECT {SCORED_OUT} FROM hsnap WHERE snapshot_time_utc BETWEEN {SCORE_LO} AND {SCORE_HI}"""


WRITEBACK = TRAINING_SET + "," + model_cte("tset").strip("\n") + f""",
win AS (
  SELECT s.merchant_id, s.snapshot_time_utc, {model_score_expr('m')} AS sc
  FROM hsnap s CROSS JOIN mdl m WHERE s.snapshot_time_utc BETWEEN {SCORE_LO} AND {SCORE_HI}
),
wb AS (
  SELECT s.*, CAST(round(w.sc, 5) AS DECIMAL(6,5)) AS local_model_score,
         CASE WHEN w.sc IS NOT NULL THEN {band_sql('w.sc', 0.8, 0.5)} END AS local_model_band,
         CASE WHEN w.sc IS NOT NULL THEN 'risk_model_latest' END AS local_model_version,
         CASE WHEN w.sc IS NOT NULL THEN {NOW} END AS local_model_scored_at_utc
  FROM hsnap s LEFT JOIN win w USING (merchant_id, snapshot_time_utc)
)"""


@oracle("score_writeback")
def _():
    return WRITEBACK + f"\nSELECT {SCORED_OUT}, {MODEL_OUT} FROM wb"


@oracle("snapshot_upsert")
def _():
    lf = LIVE_FACTS.replace("\nev AS", "\nev AS", 1)
    return (WRITEBACK + "," + lf.strip("\n") + ","
            + features_cte("live_facts", "lfeat", where_t=f"T BETWEEN {SCORE_LO} AND {SCORE_HI}").strip("\n") + ","
            + scored_cte("lfeat", "lsnap", f"{NOW} + INTERVAL 15 MINUTE").strip("\n") + f"""
SELECT {SCORED_OUT}, {MODEL_OUT} FROM wb
WHERE NOT EXISTS (SELECT 1 FROM lsnap l WHERE l.merchant_id = wb.merchant_id
                  AND l.snapshot_time_utc = wb.snapshot_time_utc)
UNION ALL
SELECT l.merchant_id, l.snapshot_time_utc, l.txn_count_15m, CAST(l.gmv_usd_15m AS DOUBLE), l.txn_count_1h,
       CAST(l.gmv_usd_1h AS DOUBLE), l.computed_at_utc, CAST(l.risk_score_v1 AS DOUBLE), l.risk_band_v1,
       CAST(w.local_model_score AS DOUBLE), w.local_model_band, w.local_model_version, w.local_model_scored_at_utc
FROM lsnap l LEFT JOIN wb w USING (merchant_id, snapshot_time_utc)""")


@oracle("schema_upgrade")
def _():
    return with_(LIVE_FACTS) + """
SELECT event_id, event_type,
       CASE WHEN event_type <> 'view' THEN event_time_utc ELSE ingested_at_utc END AS event_time_utc,
       ingested_at_utc, CAST(NULL AS DOUBLE) AS label_bad_outcome, CAST(NULL AS DOUBLE) AS label_anomaly,
       CAST(NULL AS DOUBLE) AS label_dispute_lost
FROM live_facts"""


@oracle("insert_if_absent")
def _():
    return """
SELECT 'm_' || lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS merchant_id, c_name AS merchant_name FROM customer
UNION ALL
SELECT 'm_seed_0001', 'Seed Merchant'
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE 'm_' || lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') = 'm_seed_0001')"""


@oracle("dim_upsert")
def _():
    return with_(ENRICH, HIST_FACTS) + """,
rev AS (SELECT DISTINCT merchant_id FROM hist_facts WHERE amount_usd < 0)
SELECT d.merchant_id,
       CASE WHEN r.merchant_id IS NOT NULL THEN d.merchant_name || ' (reviewed)' ELSE d.merchant_name END
         AS merchant_name,
       d.merchant_segment,
       CASE WHEN r.merchant_id IS NOT NULL THEN 'HIGH' ELSE d.risk_tier END AS risk_tier,
       d.country, d.mcc
FROM dim d LEFT JOIN rev r USING (merchant_id)"""


def _dim22_sql() -> str:
    from merchant_signals.operators.enrich import MCC_INDUSTRY, US_STATES

    ind = _sql_case("mcc", {k: f"'{v}'" for k, v in MCC_INDUSTRY.items()}, "NULL")
    return f"""
d22 AS (
  SELECT merchant_id, merchant_name, CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR)
           AS onboarding_date,
         merchant_segment, mcc, {ind} AS industry_name, risk_tier, CAST(NULL AS VARCHAR) AS kyc_status,
         'ACTIVE' AS account_status, country,
         CASE WHEN country = 'US' THEN {_sql_list(US_STATES)}[c_custkey % 15 + 1] END AS state,
         CAST(NULL AS VARCHAR) AS timezone, CAST(NULL AS VARCHAR) AS fee_plan_id,
         CAST(CASE merchant_segment WHEN 'ENTERPRISE' THEN 0.022 WHEN 'MID_MARKET' THEN 0.025 ELSE 0.029 END
              AS DOUBLE) AS processor_fee_rate,
         CAST(0.30 AS DOUBLE) AS fixed_fee, CAST(NULL AS VARCHAR) AS settlement_schedule,
         CAST(NULL AS VARCHAR) AS payout_frequency, CAST(NULL AS VARCHAR) AS payout_method,
         CAST(CASE risk_tier WHEN 'HIGH' THEN 0.07 WHEN 'MEDIUM' THEN 0.03 ELSE 0.0 END AS DOUBLE) AS reserve_rate,
         CAST(NULL AS DOUBLE) AS avg_order_value_usd_est, CAST(NULL AS DOUBLE) AS avg_daily_txn_est,
         {NOW} AS created_at_utc
  FROM dim
)"""


@oracle("dim_csv_upsert")
def _():
    return with_(ENRICH, _dim22_sql()) + """
SELECT * FROM d22
UNION ALL
SELECT 'm_seed_0001', 'Seed Merchant', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
WHERE NOT EXISTS (SELECT 1 FROM d22 WHERE merchant_id = 'm_seed_0001')"""


# ---- monitoring ------------------------------------------------------------------

@oracle("bucket_coverage")
def _():
    return with_(LIVE_FACTS, features_cte("live_facts")) + """,
b AS (SELECT TIMESTAMP '2024-01-30 23:45:00' + to_minutes(15 * i) AS snapshot_time_utc FROM range(0, 6) r(i))
SELECT b.snapshot_time_utc, count(f.merchant_id) AS snapshot_rows
FROM b LEFT JOIN feat f USING (snapshot_time_utc) GROUP BY 1"""


@oracle("recent_buckets")
def _():
    return with_(LIVE_FACTS, features_cte("live_facts")) + """
SELECT snapshot_time_utc, count(*) AS snapshot_rows FROM feat GROUP BY 1 ORDER BY 1 DESC LIMIT 5"""


@oracle("coverage_counts")
def _():
    return with_(HIST_FACTS, HIST_SNAPS) + f"""
SELECT 'fact_rows' AS metric, count(*) AS value FROM hist_facts
UNION ALL SELECT 'snapshot_rows', count(*) FROM hfeat
UNION ALL SELECT 'exported_rows', count(*) FROM hfeat
  WHERE snapshot_time_utc >= {NOW} - INTERVAL 30 DAY AND snapshot_time_utc < {NOW} - INTERVAL 24 HOUR
    AND snapshot_time_utc + INTERVAL 24 HOUR <= {NOW}"""


@oracle("merchant_lookup")
def _():
    return with_(ENRICH, HIST_FACTS, features_cte("hist_facts", "hfeat")) + f"""
SELECT merchant_id, merchant_name, merchant_segment, risk_tier, country, mcc FROM dim
WHERE merchant_id IN (SELECT merchant_id FROM hfeat WHERE snapshot_time_utc BETWEEN {SCORE_LO} AND {SCORE_HI})"""


@oracle("newest_raw")
def _():
    return with_(RAW_ROWS) + """
SELECT 'SYNTH_LIVE' AS source, raw_id,
       CASE WHEN eid % 101 = 0 THEN '' ELSE 'evt_' || CAST(eid AS VARCHAR) END AS event_id
FROM raw_rows ORDER BY raw_id DESC LIMIT 1"""


# ---- late data, horizons, arbitrary times, reruns ------------------------------------

@oracle("late_events_excluded")
def _():
    return with_(LIVE_FACTS) + f""",
x AS (SELECT merchant_id, event_time_utc, ingested_at_utc,
             {floor15('event_time_utc')} + to_minutes(15 * k) AS T FROM live_facts, range(1, 5) r(k))
SELECT merchant_id, T AS snapshot_time_utc, CAST(count(*) AS INTEGER) AS late_events_1h,
       CAST(count(*) FILTER (WHERE event_time_utc >= T - INTERVAL 15 MINUTE) AS INTEGER) AS late_events_15m
FROM x WHERE ingested_at_utc >= T GROUP BY 1, 2"""


@oracle("recompute_horizon")
def _():
    return with_(LIVE_FACTS, features_cte(
        "live_facts", where_t="T BETWEEN TIMESTAMP '2024-01-30 23:00:00' AND TIMESTAMP '2024-01-31 00:15:00'")) + \
        f"\nSELECT {SNAP_OUT} FROM feat"


@oracle("snapshot_at_times")
def _():
    return with_(LIVE_FACTS) + """,
tm AS (SELECT unnest(generate_series(max(event_time_utc) - INTERVAL 75 MINUTE, max(event_time_utc),
                                      INTERVAL 15 MINUTE)) AS T FROM live_facts)
SELECT f.merchant_id, tm.T AS snapshot_time_utc,
  CAST(count(*) FILTER (WHERE f.event_time_utc >= tm.T - INTERVAL 15 MINUTE) AS INTEGER) AS txn_count_15m,
  CAST(COALESCE(sum(f.amount_usd) FILTER (WHERE f.event_time_utc >= tm.T - INTERVAL 15 MINUTE), 0) AS DOUBLE)
    AS gmv_usd_15m,
  CAST(count(*) AS INTEGER) AS txn_count_1h, CAST(COALESCE(sum(f.amount_usd), 0) AS DOUBLE) AS gmv_usd_1h
FROM tm JOIN live_facts f ON f.event_time_utc >= tm.T - INTERVAL 1 HOUR AND f.event_time_utc < tm.T
 AND f.ingested_at_utc < tm.T
GROUP BY 1, 2"""


ORACLES["rerun_noop"] = ORACLES["merchant_features"]


@oracle("realtime_tail")
def _():
    return with_(LIVE_FACTS) + """
SELECT event_id, event_time_utc, merchant_id, CAST(amount_usd AS DOUBLE) AS amount_usd FROM live_facts
WHERE event_time_utc >= (SELECT max(event_time_utc) FROM live_facts) - INTERVAL 60 MINUTE"""


@oracle("table_export")
def _():
    return with_(ENRICH, _dim22_sql()) + """
SELECT merchant_id, merchant_name, country, state, processor_fee_rate, reserve_rate, onboarding_date,
       created_at_utc FROM d22"""


@oracle("json_merge")
def _():
    return with_(RAW_ROWS) + """
SELECT raw_id, 'evt_clone_' || CAST(raw_id AS VARCHAR) AS event_id,
       strftime(received_at + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time_utc,
       CASE WHEN eid % 97 = 0 THEN '' ELSE 'm_' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') END AS merchant_id,
       CAST(amount_usd AS DOUBLE) AS amount_usd,
       CASE WHEN amount_usd IS NULL THEN 7 ELSE 8 END AS n_keys
FROM raw_rows"""


# ---- increments and streams ---------------------------------------------------------

@oracle("increment_run")
def _():
    # the training window is computed while only the originals are loaded
    window = f"T BETWEEN {NOW} - INTERVAL 8 DAY AND {NOW} - INTERVAL 24 HOUR"
    return with_(LIVE_FACTS, """originals AS (SELECT * FROM live_facts WHERE raw_id <= (SELECT max(event_id) + 1 FROM events))""",
                 features_cte("originals", "ofeat", where_t=window), scored_cte("ofeat", "osnap"),
                 features_cte("live_facts", where_t=f"T BETWEEN {SCORE_LO} AND {SCORE_HI}"), scored_cte("feat"), f"""
trainset AS (SELECT *, 0 AS label_bad_outcome_24h FROM osnap
             WHERE snapshot_time_utc < {NOW} - INTERVAL 24 HOUR AND snapshot_time_utc + INTERVAL 24 HOUR <= {NOW})""",
                 model_cte("trainset")) + f""",
sc AS (SELECT f.*, {model_score_expr('m')} AS s FROM scored f CROSS JOIN mdl m)
SELECT merchant_id, snapshot_time_utc, txn_count_15m, CAST(gmv_usd_15m AS DOUBLE) AS gmv_usd_15m, txn_count_1h,
       CAST(gmv_usd_1h AS DOUBLE) AS gmv_usd_1h, CAST(risk_score_v1 AS DOUBLE) AS risk_score_v1, risk_band_v1,
       CAST(round(s, 5) AS DOUBLE) AS local_model_score, {band_sql('s', 0.8, 0.5)} AS local_model_band,
       {NOW} AS local_model_scored_at_utc
FROM sc
UNION ALL
SELECT merchant_id, snapshot_time_utc, txn_count_15m, CAST(gmv_usd_15m AS DOUBLE), txn_count_1h,
       CAST(gmv_usd_1h AS DOUBLE), CAST(risk_score_v1 AS DOUBLE), risk_band_v1, NULL, NULL, NULL
FROM osnap"""


@oracle("stream_features")
def _():
    return with_(LIVE_FACTS, features_cte("live_facts"), scored_cte("feat")) + """
SELECT merchant_id, snapshot_time_utc, txn_count_15m, CAST(gmv_usd_15m AS DOUBLE) AS gmv_usd_15m, txn_count_1h,
       CAST(gmv_usd_1h AS DOUBLE) AS gmv_usd_1h, CAST(risk_score_v1 AS DOUBLE) AS risk_score_v1, risk_band_v1,
       CAST(NULL AS DOUBLE) AS local_model_score
FROM scored"""


@oracle("source_allow_list")
def _():
    return with_(RAW_ROWS) + """
SELECT 'SYNTH_LIVE' AS source, count(*) AS raw_rows, true AS loaded FROM raw_rows"""


@oracle("raw_append")
def _():
    return with_(RAW_ROWS) + """
SELECT CASE WHEN raw_id % 2 = 1 THEN 'API' ELSE 'HTTP' END AS source,
       CASE WHEN eid % 101 = 0 THEN '' ELSE 'evt_' || CAST(eid AS VARCHAR) END AS event_id,
       CASE WHEN eid % 97 = 0 THEN '' ELSE 'm_' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') END AS merchant_id,
       CAST(amount_usd AS DOUBLE) AS amount_usd
FROM raw_rows"""


@oracle("jsonl_replay")
def _():
    return with_(RAW_ROWS) + """
SELECT 'SYNTH_STREAM' AS source,
       CASE WHEN eid % 101 = 0 THEN '' ELSE 'evt_' || CAST(eid AS VARCHAR) END AS event_id,
       'm_' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS merchant_id
FROM raw_rows WHERE eid % 97 <> 0"""


@oracle("raw_events_view")
def _():
    return with_(RAW_ROWS) + """
SELECT 'SYNTH_LIVE' AS source, count(*) AS raw_rows, min(raw_id) AS min_raw_id, max(raw_id) AS max_raw_id,
       count(*) FILTER (WHERE eid % 97 <> 0) AS with_merchant
FROM raw_rows"""


@oracle("clone_events")
def _():
    return with_(RAW_ROWS) + """
SELECT 'm_' || lpad(CAST(user_id AS VARCHAR), greatest(6, length(CAST(user_id AS VARCHAR)))::INTEGER, '0') AS merchant_id, count(*) AS clones, count(*) AS facts
FROM raw_rows WHERE eid % 97 <> 0 GROUP BY 1"""


@oracle("clone_lines")
def _():
    return with_(RAW_ROWS) + f"""
SELECT raw_id, concat_ws(' ', CASE WHEN eid % 101 = 0 THEN '' ELSE 'evt_' || CAST(eid AS VARCHAR) END,
                         CASE WHEN eid % 97 <> 0 THEN {MERCHANT} END) AS line,
       date_trunc('second', received_at - INTERVAL 30 SECOND) AS event_time_utc
FROM raw_rows"""


ORACLES["stream_window_features"] = ORACLES["merchant_features"]
ORACLES["stream_state_features"] = ORACLES["merchant_features"]


@oracle("fact_csv_load")
def _():
    return with_(LIVE_FACTS) + f""",
stage AS (
  SELECT 'evt_' || CAST(e.event_id AS VARCHAR) AS event_id, e.event_id AS eid, e.event_type, e.ts AS event_time_utc,
         {MERCHANT} AS merchant_id, {AMOUNT.replace('event_id', 'e.event_id')} AS amount_usd,
         CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.event_type = 'error' AS INTEGER) END AS label_bad_outcome,
         sha256('payer|' || CAST(e.event_id AS VARCHAR)) AS payer_id_hash,
         {COUNTRY_LIST}[c.c_nationkey % 10 + 1] AS merchant_country,
         {_sql_list(_mcc_pool())}[c.c_custkey % 7 + 1] AS merchant_mcc,
         CAST(e.ts >= {NOW} - INTERVAL 15 DAY AS INTEGER) AS drift_regime_id
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
),
fresh AS (SELECT * FROM stage s WHERE NOT EXISTS (SELECT 1 FROM live_facts l WHERE l.event_id = s.event_id))
SELECT s.event_id, s.event_type, s.event_time_utc, s.merchant_id, CAST(s.amount_usd AS DOUBLE) AS amount_usd,
       CAST(s.label_bad_outcome AS DOUBLE) AS label_bad_outcome, 'SYNTHETIC' AS source,
       payer_id_hash, merchant_country, merchant_mcc, drift_regime_id,
       (SELECT count(*) + count(*) FILTER (WHERE eid % 7 = 0) FROM stage) AS staged_rows,
       (SELECT count(*) FROM live_facts) + (SELECT count(*) FROM fresh) AS fact_total_rows
FROM fresh s"""


ORACLES["merchant_features_sql"] = ORACLES["merchant_features"]
