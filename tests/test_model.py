import math

import pytest

from merchant_signals.operators import model as M
from merchant_signals.operators.scoring import model_score

TWO_ROWS = [("m_train_0001", "2024-01-01 00:00:00", 2, "40.00", 4, "90.00", "15.00", "low", 0),
            ("m_train_0002", "2024-01-01 00:15:00", 9, "600.00", 18, "1400.00", "92.00", "high", 1)]
DDL = ("merchant_id string, snapshot_time_utc string, txn_count_15m int, gmv_usd_15m string, txn_count_1h int, "
       "gmv_usd_1h string, risk_score_v1 string, risk_band_v1 string, label_bad_outcome_24h int")


def test_two_row_golden(spark):
    rows = spark.createDataFrame(TWO_ROWS, DDL)
    model = M.train(rows)
    st = {r.feature: r for r in M.stats_long(model).collect()}
    assert [st[f].weight for f in ["txn_count_15m", "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h", "risk_score_v1"]] \
        == [7.0, 560.0, 14.0, 1310.0, 77.0]
    m = model.first()
    assert (m.training_rows, m.positive_rows, m.negative_rows, m.positive_rate) == (2, 1, 1, 0.5)
    s = {r.merchant_id: r for r in model_score(rows, model).collect()}
    assert s["m_train_0002"].local_model_score_raw == pytest.approx(1.0) and s["m_train_0002"].local_model_band == "high"
    assert s["m_train_0001"].local_model_score_raw == pytest.approx(0.0, abs=1e-12)
    assert s["m_train_0001"].local_model_band == "low"
    # raw = sum w^2 / 2 = 1,017,937 ; normalised = raw / 1968
    assert 1017937 / 1968 == pytest.approx(517.2444, rel=1e-6)


def test_tolerant_reader_and_missing_columns(spark):
    rows = spark.createDataFrame([("", "null", "1"), (None, "2.5", "0")],
                                 "txn_count_15m string, gmv_usd_15m string, label_bad_outcome_24h string")
    st = {r.feature: r for r in M.stats_long(M.train(rows)).collect()}
    assert st["gmv_usd_15m"].positive_mean == 0.0 and st["gmv_usd_15m"].negative_mean == 2.5
    assert st["risk_score_v1"].weight == 0.0  # missing column reads as 0.0


def test_empty_training_set_fails(spark):
    rows = spark.createDataFrame([], DDL)
    with pytest.raises(ValueError):
        M.require_rows(M.train(rows))


def test_all_negative_prior_is_clamped(spark):
    rows = spark.createDataFrame([r[:-1] + (0,) for r in TWO_ROWS], DDL)
    got = {r.merchant_id: r.local_model_score_raw for r in model_score(rows, M.train(rows)).collect()}
    feats = [[float(v) for v in (r[2], r[3], r[4], r[5], r[6])] for r in TWO_ROWS]
    nm = [sum(col) / 2 for col in zip(*feats)]
    w = [0.0 - m for m in nm]  # empty positive class -> mean 0.0
    for r, x in zip(TWO_ROWS, feats):
        raw = sum((xi - (0.0 + m) / 2) * wi for xi, m, wi in zip(x, nm, w))
        z = raw / max(sum(abs(v) for v in w), 1.0) + math.log(1e-6 / 1.0)
        exp = 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))
        assert got[r[0]] == pytest.approx(exp, rel=1e-9, abs=1e-300)


def test_save_load_contract(spark, tmp_dir):
    rows = spark.createDataFrame(TWO_ROWS, DDL)
    M.save(M.train(rows), tmp_dir + "/m")
    assert M.load(spark, tmp_dir + "/m").first().positive_rate == 0.5
    spark.createDataFrame([(1,)], "x int").write.parquet(tmp_dir + "/bad")
    with pytest.raises(ValueError):
        M.load(spark, tmp_dir + "/bad")
