import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchant_signals.functions.json import has_key, json_text
from merchant_signals.operators import facts as FO
from merchant_signals.operators.mutate import (
    assert_unique, insert_if_absent, update_columns, upsert_last_state, upsert_snapshots)
from merchant_signals.operators.row_ids import dense_row_id
from merchant_signals.schemas import RAW


def _raw(spark, rows):
    data = [(i, s, json.dumps(p) if isinstance(p, dict) else p, dt.datetime(2024, 1, 1, 10, 0)) for i, s, p in rows]
    return spark.createDataFrame(data, RAW)


P = {"event_id": "e1", "event_type": "payment", "merchant_id": "m1", "amount_usd": 42.505,
     "event_time_utc": "2024-01-01T09:00:00.000Z", "ingested_at_utc": "2024-01-01T09:01:00.000Z"}


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"a": null, "b": 1.50}',), ('{}',)], "p string")
    r = df.select(has_key("p", "a").alias("ha"), json_text("p", "a").alias("a"), json_text("p", "b").alias("b")).collect()
    assert (r[0].ha, r[0].a, r[0].b) == (True, None, "1.50") or (r[0].ha, r[0].a) == (True, None)
    assert (r[1].ha, r[1].a) == (False, None)


def test_projection_defaults_and_rejects(spark):
    raw = _raw(spark, [
        (1, "SYNTH_LIVE", P),
        (2, "SYNTH_LIVE", {**P, "event_id": "", "event_time_utc": "", "amount_usd": ""}),
        (3, "SYNTH_LIVE", {**P, "merchant_id": None}),
        (4, "SYNTH_LIVE", {k: v for k, v in P.items() if k != "merchant_id"}),
        (5, "SYNTH_LIVE", {**P, "merchant_id": ""}),
    ])
    f = {r.raw_id: r for r in FO.facts_from_raw(raw).collect()}
    assert sorted(f) == [1, 2]
    assert f[1].amount_usd == Decimal("42.51")  # half away from zero
    assert f[1].label_bad_outcome is None       # labels are not read from payloads
    assert f[2].event_id == "raw_2" and f[2].amount_usd is None
    assert f[2].event_time_utc == dt.datetime(2024, 1, 1, 10, 0)  # falls back to received_at


def test_dedup_first_wins_and_insert_ignore(spark):
    raw = _raw(spark, [(1, "S", P), (2, "S", {**P, "amount_usd": 1}), (3, "S", {**P, "event_id": "e2"})])
    f = FO.dedup_first_wins(FO.facts_from_raw(raw))
    assert {r.event_id: r.raw_id for r in f.collect()} == {"e1": 1, "e2": 3}
    existing = f.filter(F.col("event_id") == "e1")
    assert [r.event_id for r in FO.insert_ignore(f, existing, "event_id").collect()] == ["e2"]


def test_batches_watermark_and_rejects(spark):
    rows = [(i, "SYNTH_LIVE", {**P, "event_id": f"e{i}"} if i % 3 else {**P, "merchant_id": ""}) for i in range(1, 11)]
    raw = _raw(spark, rows)
    stats = {r.batch_no: r for r in FO.all_increments_stats(raw, "SYNTH_LIVE", batch_size=4).collect()}
    assert [(s.processed_rows, s.inserted_fact, s.watermark_before, s.updated_watermark)
            for _, s in sorted(stats.items())] == [(4, 3, 0, 4), (4, 3, 4, 8), (2, 1, 8, 10)]
    # one increment by hand: an all-rejected batch still advances the watermark
    rejected = _raw(spark, [(20, "SYNTH_LIVE", {**P, "merchant_id": ""})])
    batch = FO.incremental_batch(rejected, "SYNTH_LIVE", 10)
    ins = FO.load_batch(batch, FO.facts_from_raw(raw))
    s = FO.batch_stats(batch, ins, 10).first()
    assert (s.processed_rows, s.inserted_fact, s.updated_watermark) == (1, 0, 20)
    empty = FO.incremental_batch(rejected, "SYNTH_LIVE", 20)
    s = FO.batch_stats(empty, FO.load_batch(empty, FO.facts_from_raw(raw)), 20).first()
    assert (s.processed_rows, s.inserted_fact, s.updated_watermark) == (0, 0, 20)


def test_source_allow_list():
    assert FO.resolve_source(None) == "SYNTH_LIVE"
    with pytest.raises(ValueError):
        FO.resolve_source("OTHER")


def test_ingest_lag_defaults(spark):
    raw = _raw(spark, [(5, "SYNTH_LIVE", P)])
    wm = spark.createDataFrame([], "source string, last_raw_id long")
    r = FO.ingest_lag(raw, wm).first()
    assert (r.last_raw_id, r.max_raw_id, r.new_rows, r.has_new) == (0, 5, 5, True)


def test_dense_row_id_matches_row_number(spark):
    import random

    random.seed(3)
    data = [(random.randint(0, 50), f"k{i}") for i in range(2000)]
    df = spark.createDataFrame(data, "a int, b string").repartition(7)
    got = {r.b: r.rid for r in dense_row_id(df, ["a", "b"], "rid").collect()}
    exp = {b: i + 1 for i, (a, b) in enumerate(sorted(data))}
    assert got == exp


def test_upserts(spark):
    dim = spark.createDataFrame([("m1", "a"), ("m2", "b")], "merchant_id string, merchant_name string")
    src = spark.createDataFrame([("m2", "B"), ("m3", "C")], "merchant_id string, merchant_name string")
    assert sorted(tuple(r) for r in upsert_last_state(dim, src, ["merchant_id"]).collect()) == [
        ("m1", "a"), ("m2", "B"), ("m3", "C")]
    with pytest.raises(ValueError):
        assert_unique(src.unionByName(src), ["merchant_id"])
    seed = spark.createDataFrame([("m1", "x"), ("m9", "z")], "merchant_id string, merchant_name string")
    assert insert_if_absent(dim, seed, key=["merchant_id"]).count() == 3
    assert insert_if_absent(dim, seed, exists=F.col("merchant_id") == "m1").count() == 2
    assert insert_if_absent(dim, seed, exists=F.col("merchant_id") == "zz").count() == 4


def test_snapshot_upsert_keeps_model_columns(spark):
    ddl = ("merchant_id string, snapshot_time_utc timestamp, computed_at_utc timestamp, txn_count_15m int, "
           "gmv_usd_15m decimal(18,2), txn_count_1h int, gmv_usd_1h decimal(18,2), risk_score_v1 decimal(5,2), "
           "risk_band_v1 string, local_model_score decimal(6,5), local_model_band string, local_model_version string, "
           "local_model_scored_at_utc timestamp")
    t0 = dt.datetime(2024, 1, 1, 11)
    target = spark.createDataFrame([("m1", t0, t0, 1, Decimal(1), 1, Decimal(1), Decimal(10), "low",
                                     Decimal("0.5"), "medium", "v", t0),
                                    ("m2", t0, t0, 1, Decimal(1), 1, Decimal(1), Decimal(10), "low",
                                     None, None, None, None)], ddl)
    src = target.filter("merchant_id = 'm1'").withColumn("txn_count_15m", F.lit(7)).drop(
        "local_model_score", "local_model_band", "local_model_version", "local_model_scored_at_utc")
    out = {r.merchant_id: r for r in upsert_snapshots(target, src).collect()}
    assert out["m1"].txn_count_15m == 7 and out["m1"].local_model_score == Decimal("0.5")
    assert out["m2"].txn_count_15m == 1
    upd = spark.createDataFrame([("m2", t0, Decimal("0.9")), ("m7", t0, Decimal("0.1"))],
                                "merchant_id string, snapshot_time_utc timestamp, local_model_score decimal(6,5)")
    u = {r.merchant_id: r for r in update_columns(target, upd, ["merchant_id", "snapshot_time_utc"],
                                                  ["local_model_score"]).collect()}
    assert set(u) == {"m1", "m2"} and u["m2"].local_model_score == Decimal("0.9")
    assert u["m1"].local_model_score == Decimal("0.5")


def test_clone_ids_and_base64_transport(spark):
    import hashlib

    from merchant_signals.operators.clone import clone_payloads, via_base64

    raw = _raw(spark, [(7, "SYNTH_LIVE", P)])
    at = F.lit(dt.datetime(2024, 2, 1, 12, 0, 0)).cast("timestamp")
    c = clone_payloads(raw, at).first()
    p = json.loads(c.payload)
    assert p["event_id"] == "evt_" + hashlib.md5(b"evt_7").hexdigest()[:32]
    assert p["order_id"] == "ord_" + hashlib.md5(b"ord_7").hexdigest()[:32]
    assert p["event_time_utc"] == "2024-02-01T12:00:00.000Z" and p["merchant_id"] == "m1"
    back = clone_payloads(raw, at).select(via_base64(F.col("payload")).alias("b"), "payload").first()
    assert back.b == back.payload


def test_broken_json_fails_the_load(spark):
    raw = spark.createDataFrame([(1, "SYNTH_LIVE", '{"event_id": "a", "merch', dt.datetime(2024, 1, 1))], RAW)
    with pytest.raises(Exception, match="(?i)malformed|json"):
        FO.facts_from_raw(raw).collect()


def test_historical_load_refuses_repeated_and_missing_ids(spark):
    from merchant_signals.schemas import FACT_CSV14

    t = dt.datetime(2024, 1, 1)
    row = ("e1", "payment", t, "m1", "o1", "captured", None, "h", "US", "5411", "S", t, None, 1)
    ok = FO.historical_load(spark.createDataFrame([row], FACT_CSV14)).first()
    assert (ok.merchant_mcc, ok.drift_regime_id, ok.label_bad_outcome) == ("5411", 1, 0)
    for rows in ([row, row], [(None, *row[1:])]):
        with pytest.raises(ValueError):
            FO.historical_load(spark.createDataFrame(rows, FACT_CSV14))


def test_large_ids_stay_apart(spark, tmp_dir):
    """User ids beyond six digits are whole; originals and copies never share a raw id."""
    from merchant_signals.plans import views as V
    from merchant_signals.sources import driver

    rows = [(i, dt.datetime(2024, 1, 1), u, "view", 1.0, "{}") for i, u in
            [(0, 7), (9_999_999, 100_000), (10_000_000, 1_000_000), (20_000_000, 1_000_009)]]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(tmp_dir + "/events.parquet")
    raw = driver.raw_events(spark, tmp_dir)
    assert raw.select("raw_id").distinct().count() == raw.count() == 7
    merchants = {r.merchant_id for r in V.hist_facts(spark, tmp_dir).collect()}
    assert merchants == {"m_000007", "m_100000", "m_1000000", "m_1000009"}


def test_upsert_moves_each_side_once(spark):
    """Repeated and null keys, on either side, as by a left join and an anti join."""
    cols = "merchant_id string, snapshot_time_utc int, txn int, local int"
    target = spark.createDataFrame([("a", 1, 10, 7), ("a", 2, 20, 8), ("b", 1, 30, 9), ("b", 1, 31, 10), (None, 1, 40, 11)], cols)
    src = spark.createDataFrame([("a", 1, None), ("b", 1, 50), ("c", 1, 60), ("c", 1, 61), (None, 1, 70)], "merchant_id string, snapshot_time_utc int, txn int")
    out = upsert_snapshots(target, src, ["local"])
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [
        ("a", 1, None, 7), ("a", 2, 20, 8), ("b", 1, 50, 9), ("b", 1, 50, 10), (None, 1, 40, 11),
        ("c", 1, 60, None), ("c", 1, 61, None), (None, 1, 70, None)]))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_first_facts_move_raw_rows_only(spark):
    """As the dedup of typed rows; raw ids may repeat, rows without a merchant go first."""
    def p(e, m, a):
        return f'{{"event_id": "{e}", "merchant_id": "{m}", "amount_usd": "{a}"}}'
    rows = [(1, p("e1", "", 1)), (2, p("e1", "m", 2)), (3, p("e1", "m", 3)), (2, p("e2", "m", 4)), (2, p("e3", "", 5)), (None, p("e4", "m", 6)),
            (7, p("", "m", 7)), (8, "[1]")]
    raw = spark.createDataFrame([(i, "S", t, dt.datetime(2024, 1, 1)) for i, t in rows], "raw_id long, source string, payload string, received_at timestamp")
    got = FO.first_facts(raw)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, FO.dedup_first_wins(FO.facts_from_raw(raw)).collect()))
    assert {r.event_id for r in got.collect()} == {"e1", "e2", "raw_7"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    left = plan[plan.index("LeftSemi"):plan.index("Aggregate")]
    assert "AS _p" not in left and "AS event_type" not in left
