from decimal import Decimal

from pyspark.sql import functions as F

from merchant_signals.operators.features import merchant_features
from merchant_signals.operators.scoring import risk_score_v1
from tests.helpers import facts, ts


def _score(spark, amount, event_time, T="2024-01-01 11:00:00"):
    f = facts(spark, [("a", "m1", event_time, event_time, amount)])
    r = (risk_score_v1(merchant_features(f)).filter(F.col("snapshot_time_utc") == ts(T)).collect())
    assert len(r) == 1
    return r[0].risk_score_v1, r[0].risk_band_v1


def test_heuristic_goldens(spark):
    assert _score(spark, Decimal("42.50"), "2024-01-01 10:50:00") == (Decimal("100.00"), "high")
    assert _score(spark, Decimal("0.00"), "2024-01-01 10:50:00") == (Decimal("55.00"), "medium")
    assert _score(spark, Decimal("50.00"), "2024-01-01 10:30:00") == (Decimal("22.66"), "low")
    assert _score(spark, Decimal("-10.00"), "2024-01-01 10:30:00") == (Decimal("3.00"), "low")


def test_band_uses_unrounded_score(spark):
    df = spark.createDataFrame([(0, Decimal("0"), 1, Decimal("0"))],
                               "txn_count_15m int, gmv_usd_15m decimal(18,2), txn_count_1h int, gmv_usd_1h decimal(18,2)")
    # 3 + 5 ln(1+g) = 79.996 -> g = exp(76.996/5) - 1
    import math
    g = Decimal(str(round(math.exp(76.996 / 5) - 1, 2)))
    r = risk_score_v1(df.withColumn("gmv_usd_1h", F.lit(g).cast("decimal(18,2)"))).first()
    raw = 3 + 5 * math.log(1 + float(g))
    assert 79.995 <= raw < 80
    assert r.risk_score_v1 == Decimal("80.00") and r.risk_band_v1 == "medium"


def test_model_scores_on_its_own_feature_list(spark):
    from merchant_signals.operators import model as M
    from merchant_signals.operators.scoring import model_score

    rows = spark.createDataFrame([("m1", 1, 9.0, 1), ("m1", 3, 9.0, 0)], "merchant_id string, txn_count_15m int, gmv_usd_15m double, label_bad_outcome_24h int")
    model = M.train(rows, ["txn_count_15m"])
    a = model_score(rows, model).orderBy("txn_count_15m").collect()
    b = model_score(rows.withColumn("gmv_usd_15m", F.lit(-1e6)), model).orderBy("txn_count_15m").collect()
    assert [r.local_model_score_raw for r in a] == [r.local_model_score_raw for r in b]
    text = rows.withColumn("txn_count_15m", F.lit("null"))
    assert model_score(text, model).first().local_model_score_raw is not None


def test_tolerant_numbers_are_not_trimmed(spark):
    import pytest

    from merchant_signals.functions.numeric import tolerant_float

    ok = spark.createDataFrame([("",), ("null",), (None,), (" 1.5",)], "x string")
    assert [r[0] for r in ok.select(tolerant_float("x")).collect()] == [0.0, 0.0, 0.0, 1.5]
    for bad in ("  ", " null ", "x"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "x string").select(tolerant_float("x")).collect()
